"""Regime, portfolio, performance and quality queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeloom.operators import gates, market, portfolio, regime
from tapeloom.plans.fixtures import BD, BW, daily_bars, weekly_bars
from tapeloom.plans.sqltext import W, div, flag, full, lag, r6
from tapeloom.session import table

RULES = [
    ("trend_up", "r20", "gt", 0.0), ("trend_up", "r5", "gt", -0.02), ("trend_up", "gap", "lte", 2.0),
    ("stress", "atr_share", "gt", 1.2), ("stress", "r5", "lt", -0.2),
    ("quiet", "atr_share", "lt", 0.9), ("quiet", "gap", "lt", 0.5),
]


def _metrics(spark: SparkSession, d: str) -> DataFrame:
    f = market.market_features(weekly_bars(spark, d))
    return f.select("symbol", "date", F.col("return_5d").alias("r5"), F.col("return_20d").alias("r20"), F.col("gap_atr").alias("gap"), (F.col("atr_14d") / F.col("close")).alias("atr_share"), "volume")


_METRICS = f"""
{BW}, t AS (SELECT *, greatest(high - low, abs(high - {lag('close')}), abs(low - {lag('close')})) AS tr, {lag('close')} AS pc FROM bars),
u AS (SELECT *, {full('avg', 'tr', 14)} AS atr FROM t),
m AS (SELECT symbol, date, volume, close / nullif({lag('close', 5)}, 0) - 1 AS r5, close / nullif({lag('close', 20)}, 0) - 1 AS r20, {r6(div('abs(open - pc)', 'atr'))} AS gap, {r6('atr')} / close AS atr_share FROM u)"""

_OPS = {"gt": ">", "gte": ">=", "lt": "<", "lte": "<="}


def _signals_sql() -> str:
    parts = []
    for code in sorted({c for c, _, _, _ in RULES}):
        mine = [r for r in RULES if r[0] == code]
        held = " + ".join(f"({m} {_OPS[o]} {t})::INTEGER" for _, m, o, t in mine)
        parts.append(f"SELECT symbol, date, '{code}' AS code, ({held}) / {len(mine)}::DOUBLE AS score FROM m")
    return f"""{_METRICS}, s AS ({' UNION ALL '.join(parts)}), g AS (
  SELECT *, CASE WHEN score IS NULL THEN 'insufficient_data' WHEN score >= 0.6 THEN 'active' ELSE 'inactive' END AS status, {flag('score >= 0.6')} AS is_active FROM s)"""


def _signals(spark: SparkSession, d: str) -> DataFrame:
    return regime.classify(_metrics(spark, d), RULES, ["symbol", "date"])


def regimes(spark: SparkSession, d: str) -> DataFrame:
    """D9, D10, Q5."""
    return _signals(spark, d)


def regime_transitions(spark: SparkSession, d: str) -> DataFrame:
    """W30."""
    return regime.transitions(_signals(spark, d), ["symbol", "code"], "date").select("symbol", "code", "date", "transition")


TRANSITIONS = f"""
WITH {_signals_sql()}, b AS (SELECT *, coalesce(lag(is_active) OVER (PARTITION BY symbol, code ORDER BY date), 0) AS p FROM g)
SELECT symbol, code, date, CASE WHEN is_active = 1 THEN 'entered' ELSE 'exited' END AS transition FROM b WHERE is_active <> p"""


def regime_snapshot(spark: SparkSession, d: str) -> DataFrame:
    """Active codes of one nation per week."""
    s = _signals(spark, d).withColumn("key", F.concat_ws("/", "symbol", F.col("date").cast("string")))
    return regime.snapshot(s, "key").select("key", "label")


SNAP = f"""
WITH {_signals_sql()} SELECT symbol || '/' || date::VARCHAR AS key, coalesce(string_agg(CASE WHEN is_active = 1 THEN code END, ',' ORDER BY code), 'unclassified') AS label FROM g GROUP BY symbol, date"""


def streaks(spark: SparkSession, d: str) -> DataFrame:
    """Weeks in a row with a wide range."""
    m = _metrics(spark, d)
    return m.withColumn("streak", regime.streak(F.col("atr_share") > 1.0, "symbol", "date")).select("symbol", "date", "streak")


STREAKS = f"""
WITH {_METRICS}, a AS (SELECT symbol, date, coalesce(atr_share > 1.0, false) AS h, row_number() OVER ({W}) AS rn FROM m)
SELECT symbol, date, CASE WHEN h THEN (rn - coalesce(max(CASE WHEN NOT h THEN rn END) OVER ({W} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0))::INTEGER ELSE 0 END AS streak FROM a"""


def ready_window(spark: SparkSession, d: str) -> DataFrame:
    """Weeks of enough volume, up to the first that falls short."""
    m = _metrics(spark, d).withColumn("ready", F.col("volume") > 20)
    return regime.ready_through(m, "symbol", "date", "ready")


READY = f"""
WITH {_METRICS}, a AS (SELECT symbol, date, min((volume > 20)::INTEGER) OVER ({W} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) = 1 AS ok FROM m)
SELECT symbol, max(CASE WHEN ok THEN date END) AS ready_through, count_if(ok)::BIGINT AS ready_dates FROM a GROUP BY 1"""


def nav_metrics(spark: SparkSession, d: str) -> DataFrame:
    """Closes of a region read as its nav, with rolling risk."""
    b = daily_bars(spark, d).select("symbol", "date", F.col("close").alias("nav"))
    out = portfolio.rolling_metrics(portfolio.nav_path(b, "symbol", "date"), "symbol", "date", 63, 252.0)
    return out.withColumns({c: F.round(c, 4) for c in ("rolling_vol", "rolling_sharpe")}).withColumn("rolling_return", F.round("rolling_return", 4))


_NAV = f"""n AS (SELECT symbol, date, close AS nav FROM bars), p AS (
  SELECT *, nav - {lag('nav')} AS period_pnl, nav / nullif({lag('nav')}, 0) - 1 AS period_return, max(nav) OVER w AS peak, nav / nullif(first_value(nav) OVER w, 0) - 1 AS cumulative_return
  FROM n WINDOW w AS ({W} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)), q AS (SELECT *, nav / nullif(peak, 0) - 1 AS drawdown FROM p)"""
NAV = f"""
WITH {BD}, {_NAV}, r AS (SELECT *, {full('stddev_pop', 'period_return', 63)} * sqrt(252.0::DOUBLE) AS v, {full('avg', 'period_return', 63)} AS m,
  CASE WHEN count(period_return) OVER ({W} ROWS BETWEEN 62 PRECEDING AND CURRENT ROW) = 63 THEN product(1 + period_return) OVER ({W} ROWS BETWEEN 62 PRECEDING AND CURRENT ROW) - 1 END AS rr,
  CASE WHEN count(period_return) OVER ({W} ROWS BETWEEN 62 PRECEDING AND CURRENT ROW) = 63 THEN min(drawdown) OVER ({W} ROWS BETWEEN 62 PRECEDING AND CURRENT ROW) END AS md FROM q)
SELECT symbol, date, nav, period_pnl, period_return, peak, cumulative_return, drawdown, round(rr, 4) AS rolling_return, round(v, 4) AS rolling_vol, md AS rolling_max_drawdown,
  round(m * 252.0::DOUBLE / nullif(v, 0), 4) AS rolling_sharpe FROM r"""


def performance(spark: SparkSession, d: str) -> DataFrame:
    """A12."""
    b = daily_bars(spark, d).select("symbol", "date", F.col("close").alias("nav"))
    out = portfolio.performance(portfolio.nav_path(b, "symbol", "date"), "symbol", "date", 252.0)
    return out.select("symbol", *[F.round(c, 6).alias(c) for c in out.columns[1:]])


PERFORMANCE = f"""
WITH {BD}, {_NAV}, g AS (
  SELECT symbol, arg_max(nav, date) / nullif(arg_min(nav, date), 0) - 1 AS t, count(period_return) AS n, avg(period_return) AS m, stddev_pop(period_return) AS s,
    sqrt(avg(CASE WHEN period_return < 0 THEN period_return * period_return WHEN period_return IS NOT NULL THEN 0.0 END)) AS dn, min(drawdown) AS md, count_if(period_return > 0) AS ups,
    sum(CASE WHEN period_return > 0 THEN period_return END) AS gain, sum(CASE WHEN period_return < 0 THEN -period_return END) AS loss FROM q GROUP BY 1
), h AS (SELECT *, pow(1 + t, 252.0::DOUBLE / n) - 1 AS y FROM g)
SELECT symbol, round(t, 6) AS total_return, round(y, 6) AS annualized_return, round(s * sqrt(252.0::DOUBLE), 6) AS volatility, round(m * sqrt(252.0::DOUBLE) / nullif(s, 0), 6) AS sharpe,
  round(m * sqrt(252.0::DOUBLE) / nullif(dn, 0), 6) AS sortino, round(y / nullif(abs(md), 0), 6) AS calmar, round(md, 6) AS max_drawdown, round(ups / n::DOUBLE, 6) AS hit_rate, round(gain / nullif(loss, 0), 6) AS profit_factor FROM h"""


def position_fold(spark: SparkSession, d: str) -> DataFrame:
    """Positions per supplier from signed trades."""
    li = table(spark, d, "lineitem")
    t = li.select("l_suppkey", "l_partkey", "l_shipdate", "l_orderkey", "l_linenumber", F.when(F.col("l_returnflag") == "R", -F.col("l_quantity")).otherwise(F.col("l_quantity")).alias("quantity"),
                  (F.col("l_extendedprice") / F.col("l_quantity")).alias("price"))
    out = portfolio.fold_positions(t, ["l_suppkey"], ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey"])
    return out.withColumns({c: F.round(c, 4) for c in ("average_cost", "realized_pnl")})


FOLD = """
SELECT l_suppkey, s.q AS quantity, round(s.c, 4) AS average_cost, round(s.r, 4) AS realized_pnl, s.n AS closed_positions FROM (SELECT l_suppkey, list_reduce(
  list({'q': CASE WHEN l_returnflag = 'R' THEN -l_quantity ELSE l_quantity END::DOUBLE, 'p': (l_extendedprice / l_quantity)::DOUBLE, 'c': 0.0::DOUBLE, 'r': 0.0::DOUBLE, 'n': 0}
    ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, CASE WHEN l_returnflag = 'R' THEN -l_quantity ELSE l_quantity END, l_extendedprice / l_quantity),
  lambda a, t: CASE WHEN t.q > 0 THEN {'q': a.q + t.q, 'p': 0.0::DOUBLE, 'c': (a.q * a.c + t.q * t.p) / (a.q + t.q), 'r': a.r, 'n': a.n}
    ELSE {'q': a.q - least(-t.q, a.q), 'p': 0.0::DOUBLE, 'c': CASE WHEN a.q - least(-t.q, a.q) > 0 THEN a.c ELSE 0.0::DOUBLE END,
      'r': a.r + least(-t.q, a.q) * (t.p - a.c), 'n': a.n + CASE WHEN a.q - least(-t.q, a.q) = 0 AND least(-t.q, a.q) > 0 THEN 1 ELSE 0 END} END,
  {'q': 0.0::DOUBLE, 'p': 0.0::DOUBLE, 'c': 0.0::DOUBLE, 'r': 0.0::DOUBLE, 'n': 0}) AS s FROM lineitem GROUP BY 1)"""


def exits(spark: SparkSession, d: str) -> DataFrame:
    """A position opened at every week of a nation."""
    b = weekly_bars(spark, d)
    from pyspark.sql import Window

    n = b.withColumn("rn", F.row_number().over(Window.partitionBy("symbol").orderBy("date")))
    p = n.select(F.concat_ws("/", "symbol", F.col("rn").cast("string")).alias("position_id"), "symbol", F.col("date").alias("entry_date"), F.col("close").alias("entry_price"))
    return portfolio.first_exits(p, b, stop=0.9, profit=8.0, trail=0.98, max_bars=30)


EXITS = f"""
WITH {BW}, n AS (SELECT *, row_number() OVER ({W}) AS rn FROM bars), p AS (SELECT symbol || '/' || rn AS position_id, symbol, date AS entry_date, close AS e FROM n),
j AS (SELECT p.*, b.date, high, low, close, greatest(max(high) OVER (PARTITION BY position_id ORDER BY b.date), e) AS anchor, row_number() OVER (PARTITION BY position_id ORDER BY b.date) AS held
  FROM p JOIN bars b ON b.symbol = p.symbol AND b.date > entry_date),
f AS (SELECT *, low <= e * (1 - 0.9::DOUBLE) AS s, high >= e * (1 + 8.0) AS g, low <= anchor * (1 - 0.98::DOUBLE) AS t, held >= 30 AS x FROM j),
k AS (SELECT *, row_number() OVER (PARTITION BY position_id ORDER BY date) AS r FROM f WHERE s OR g OR t OR x)
SELECT position_id, date AS exit_date, held::INTEGER AS bars_held, CASE WHEN s THEN 'stop' WHEN g THEN 'profit' WHEN t THEN 'trail' ELSE 'time' END AS rule,
  CASE WHEN s THEN e * (1 - 0.9::DOUBLE) WHEN g THEN e * (1 + 8.0) WHEN t THEN anchor * (1 - 0.98::DOUBLE) ELSE close END AS price, (s::INTEGER + g::INTEGER + t::INTEGER + x::INTEGER - 1)::INTEGER AS conflicts FROM k WHERE r = 1"""


def quality_gates(spark: SparkSession, d: str) -> DataFrame:
    """Q1, Q2, Q15, Q19: rules on order lines, and all-null columns."""
    li = table(spark, d, "lineitem")
    v = gates.violations(li, {"no_ship_date": F.col("l_shipdate").isNull(), "no_quantity": F.col("l_quantity") <= 0, "large_discount": F.col("l_discount") > 0.09}, ["l_orderkey", "l_linenumber"])
    n = gates.null_columns(table(spark, d, "customer").select("c_custkey", "c_mktsegment", F.lit(None).cast("int").alias("nothing")))
    return v.unionByName(n.select(F.concat(F.lit("values_of_"), "column").alias("rule"), F.col("n_values").alias("rows")))


GATES = """
SELECT 'no_ship_date' AS rule, count_if(l_shipdate IS NULL)::BIGINT AS rows FROM lineitem UNION ALL SELECT 'no_quantity', count_if(l_quantity <= 0)::BIGINT FROM lineitem
UNION ALL SELECT 'large_discount', count_if(l_discount > 0.09)::BIGINT FROM lineitem UNION ALL SELECT 'duplicate_key', (count(*) - count(DISTINCT (l_orderkey, l_linenumber)))::BIGINT FROM lineitem
UNION ALL SELECT 'values_of_c_custkey', count(c_custkey) FROM customer UNION ALL SELECT 'values_of_c_mktsegment', count(c_mktsegment) FROM customer UNION ALL SELECT 'values_of_nothing', 0"""


def freshness(spark: SparkSession, d: str) -> DataFrame:
    """Days since each user's last event."""
    e = table(spark, d, "events").select("user_id", F.to_date("ts").alias("day"))
    return gates.freshness(e, "user_id", "day", F.lit("2024-01-31").cast("date"), 1, 3)


FRESH = """
SELECT user_id, max(ts::DATE) AS last_at, (DATE '2024-01-31' - max(ts::DATE))::INTEGER AS age_days,
  CASE WHEN DATE '2024-01-31' - max(ts::DATE) > 3 THEN 'error' WHEN DATE '2024-01-31' - max(ts::DATE) > 1 THEN 'stale' ELSE 'healthy' END AS status FROM events GROUP BY 1"""


def count_jumps(spark: SparkSession, d: str) -> DataFrame:
    """Q9: days with many more events of a type than the day before."""
    e = table(spark, d, "events").select("event_type", F.to_date("ts").alias("day"))
    return gates.count_jumps(e, "event_type", "day", 1.2, 1.5, 10)


JUMPS = """
WITH g AS (SELECT event_type, ts::DATE AS day, count(*) AS n FROM events GROUP BY 1, 2), l AS (SELECT *, CASE WHEN day - lag(day) OVER (PARTITION BY event_type ORDER BY day) = 1 THEN n / lag(n) OVER (PARTITION BY event_type ORDER BY day) END AS ratio FROM g)
SELECT event_type, day, n, ratio, CASE WHEN ratio >= 1.5 THEN 'error' ELSE 'warning' END AS level FROM l WHERE n >= 10 AND ratio >= 1.2"""


def promotions(spark: SparkSession, d: str) -> DataFrame:
    """Q16, Q18: users whose events of one kind follow each other without a purchase between."""
    e = table(spark, d, "events").select("user_id", "ts", F.when(F.col("event_type") != "purchase", F.col("event_type")).alias("reason"))
    return gates.promotions(e, "user_id", "ts", "reason", 4)


PROMOTIONS = """
WITH a AS (SELECT user_id, ts, CASE WHEN event_type <> 'purchase' THEN event_type END AS reason FROM events),
b AS (SELECT *, (reason IS DISTINCT FROM lag(reason) OVER (PARTITION BY user_id ORDER BY ts))::INTEGER AS c FROM a),
g AS (SELECT *, sum(c) OVER (PARTITION BY user_id ORDER BY ts) AS k FROM b), s AS (SELECT user_id, k, reason, count(*) AS runs FROM g WHERE reason IS NOT NULL GROUP BY ALL)
SELECT user_id, max(runs) AS longest, arg_max(reason, row(runs, reason)) AS reason, max(runs) >= 4 AS promoted FROM s GROUP BY 1"""


def summaries(spark: SparkSession, d: str) -> DataFrame:
    """Order summary per status and overall, in one pass of grouping sets."""
    o = table(spark, d, "orders")
    return o.groupingSets([["o_orderstatus"], []], "o_orderstatus").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("o_custkey").alias("customers"), F.min(F.to_date("o_orderdate")).alias("first_day"), F.max(F.to_date("o_orderdate")).alias("last_day"),
        F.grouping("o_orderstatus").cast("int").alias("overall"))


SUMMARIES = """
SELECT o_orderstatus, count(*) AS n, count(DISTINCT o_custkey) AS customers, min(o_orderdate)::DATE AS first_day, max(o_orderdate)::DATE AS last_day, grouping(o_orderstatus)::INTEGER AS overall
FROM orders GROUP BY GROUPING SETS ((o_orderstatus), ())"""


def attribution(spark: SparkSession, d: str) -> DataFrame:
    """Value and weight per region and month, drift from an equal share, alerts."""
    b = daily_bars(spark, d)
    from pyspark.sql import Window

    m = b.groupBy(F.to_date(F.date_trunc("month", "date")).alias("month"), "symbol").agg(F.max_by("close", "date").alias("value"))
    w = Window.partitionBy("month")
    weight = F.col("value") / F.sum("value").over(w)
    m = m.withColumns({"actual_weight": F.round(weight, 6), "target_weight": F.lit(0.2), "rank": F.row_number().over(w.orderBy(F.desc("value"), "symbol"))})
    return m.withColumn("alert", F.when(F.abs(F.col("actual_weight") - 0.2) >= 0.1, "drift").otherwise("ok"))


ATTRIBUTION = f"""
WITH {BD}, m AS (SELECT date_trunc('month', date)::DATE AS month, symbol, arg_max(close, date) AS value FROM bars GROUP BY 1, 2),
a AS (SELECT *, round(value / sum(value) OVER (PARTITION BY month), 6) AS actual_weight, 0.2::DOUBLE AS target_weight, row_number() OVER (PARTITION BY month ORDER BY value DESC, symbol)::INTEGER AS rank FROM m)
SELECT *, CASE WHEN abs(actual_weight - 0.2::DOUBLE) >= 0.1 THEN 'drift' ELSE 'ok' END AS alert FROM a"""


def five_minutes(spark: SparkSession, d: str) -> DataFrame:
    """The streaming job over the events as they are, run twice to the end (the second finds nothing new), read back from its sink alone."""
    import uuid

    from tapeloom.session import shared_folder
    from tapeloom.streaming import jobs

    base = f"{shared_folder(spark)}/five-minutes-{uuid.uuid4().hex}"
    schema = table(spark, d, "events").schema
    for _ in range(2):
        stream = jobs.event_stream(spark, f"{d}/event[s].parquet", schema)
        jobs.keep_totals(stream, f"{base}/totals", f"{base}/state")
    return jobs.kept_totals(spark, f"{base}/totals")


FIVE = """SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS start, event_type, count(*) AS n, round(sum(value), 6) AS total FROM events GROUP BY 1, 2"""


def register_all(register) -> None:
    for name, fn, sql in (
        ("regime_signals", regimes, f"WITH {_signals_sql()} SELECT symbol, date, code, score, status, is_active FROM g"), ("regime_transitions", regime_transitions, TRANSITIONS),
        ("regime_snapshot", regime_snapshot, SNAP), ("streaks", streaks, STREAKS), ("ready_window", ready_window, READY), ("nav_metrics", nav_metrics, NAV), ("performance_summary", performance, PERFORMANCE),
        ("position_fold", position_fold, FOLD), ("first_exits", exits, EXITS), ("quality_gates", quality_gates, GATES), ("freshness", freshness, FRESH), ("count_jumps", count_jumps, JUMPS),
        ("failure_promotions", promotions, PROMOTIONS), ("summaries", summaries, SUMMARIES), ("attribution", attribution, ATTRIBUTION), ("five_minute_stream", five_minutes, FIVE),
    ):
        register(name, fn, sql)
