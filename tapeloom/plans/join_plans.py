"""As-of joins, spines and merges on orders, events and bars."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeloom.operators import asof, fundamentals
from tapeloom.plans.fixtures import BD, BW, EO, ST, daily_bars, orders_as_earnings, statements, weekly_bars
from tapeloom.plans.sqltext import W, div, filled, flag, full, lag, r6
from tapeloom.session import table


def asof_backward(spark: SparkSession, d: str) -> DataFrame:
    """J1, J2 (timestamp form): each event with its user's latest purchase at or before it."""
    e = table(spark, d, "events").select("event_id", "user_id", "ts", "event_type")
    p = table(spark, d, "events").where("event_type = 'purchase'").select("user_id", F.col("ts").alias("bought_at"), F.col("value").alias("paid"))
    return asof.asof_backward(e, p, ["user_id"], "ts", "bought_at", ["bought_at", "paid"])


ASOF_BACK = """
SELECT e.event_id, e.user_id, e.ts, e.event_type, p.ts AS bought_at, p.value AS paid
FROM events e ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'purchase') p ON e.user_id = p.user_id AND e.ts >= p.ts"""


def asof_strict(spark: SparkSession, d: str) -> DataFrame:
    """J2 (date form): strictly earlier days only; each weekly bar with the nation's last one before it."""
    b = weekly_bars(spark, d).select("symbol", "date", "close")
    p = b.select("symbol", F.col("date").alias("known_on"), F.col("close").alias("known_close"))
    return asof.asof_backward(b, p, ["symbol"], "date", "known_on", ["known_on", "known_close"], strict=True)


ASOF_STRICT = f"""
WITH {BW} SELECT b.symbol, b.date, b.close, p.date AS known_on, p.close AS known_close FROM bars b ASOF LEFT JOIN bars p ON b.symbol = p.symbol AND b.date > p.date"""


def asof_forward(spark: SparkSession, d: str) -> DataFrame:
    """Each event with its user's next error at or after it."""
    e = table(spark, d, "events").select("event_id", "user_id", "ts")
    p = table(spark, d, "events").where("event_type = 'error'").select("user_id", F.col("ts").alias("next_error"))
    return asof.asof_forward(e, p, ["user_id"], "ts", "next_error", ["next_error"])


ASOF_FWD = """
SELECT e.event_id, e.user_id, e.ts, p.ts AS next_error
FROM events e ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'error') p ON e.user_id = p.user_id AND e.ts <= p.ts"""


def last_price(spark: SparkSession, d: str) -> DataFrame:
    """Last close on or before a day."""
    return asof.latest_at(daily_bars(spark, d), "symbol", "date", F.lit("1998-06-30").cast("date"), ["date", "close"])


LAST_PRICE = f"WITH {BD} SELECT symbol, max(date) AS date, arg_max(close, date) AS close FROM bars WHERE date <= DATE '1998-06-30' GROUP BY 1"


def enrich_ffill(spark: SparkSession, d: str) -> DataFrame:
    """Quarterly revenue on the days it is known for, then carried forward; newer values win."""
    days = orders_as_earnings(spark, d).agg(F.collect_set("date").alias("days"))  # one row, a date per calendar day at most
    seg = statements(spark, d).select("symbol", "date", "revenue")
    spine = seg.select("symbol").distinct().crossJoin(F.broadcast(days)).select("symbol", F.explode("days").alias("date"))
    return asof.fill_forward(asof.enrich(spine, seg, ["symbol", "date"], ["revenue"]), ["revenue"]).select("symbol", "date", "revenue")


ENRICH = f"""
WITH {EO}, {ST}, sp AS (SELECT DISTINCT date FROM eo), g AS (SELECT sp.date, s.symbol FROM sp, (SELECT DISTINCT symbol FROM st) s),
j AS (SELECT g.symbol, g.date, st.revenue AS r FROM g LEFT JOIN st ON st.symbol = g.symbol AND st.date = g.date)
SELECT symbol, date, {filled('r')} AS revenue FROM j"""


def spine_join(spark: SparkSession, d: str) -> DataFrame:
    """All (customer, day) of orders and of actual reports, with both sides' values."""
    o = table(spark, d, "orders").groupBy(F.concat(F.lit("C"), "o_custkey").alias("symbol"), F.to_date("o_orderdate").alias("date")).agg(F.count(F.lit(1)).alias("n_orders"))
    a = orders_as_earnings(spark, d).where("record_type = 'actual'").select("symbol", "date", "reported_eps")
    spine = o.select("symbol", "date").unionByName(a.select("symbol", "date")).distinct()
    return spine.join(o, ["symbol", "date"], "left").join(a, ["symbol", "date"], "left")


SPINE = f"""
WITH {EO}, o AS (SELECT 'C' || o_custkey AS symbol, o_orderdate::DATE AS date, count(*) AS n_orders FROM orders GROUP BY 1, 2),
a AS (SELECT symbol, date, reported_eps FROM eo WHERE record_type = 'actual'), s AS (SELECT symbol, date FROM o UNION SELECT symbol, date FROM a)
SELECT s.symbol, s.date, n_orders, reported_eps FROM s LEFT JOIN o USING (symbol, date) LEFT JOIN a USING (symbol, date)"""


def pivot_join(spark: SparkSession, d: str) -> DataFrame:
    """One row per day with every region's close beside it (a pivot, not one join per region)."""
    b = daily_bars(spark, d)
    # a column per region: their names, a listing, come to the driver
    names = [r["symbol"] for r in table(spark, d, "region").select(F.col("r_name").alias("symbol")).distinct().orderBy("symbol").collect()]
    wide = b.groupBy("date").pivot("symbol", names).agg(F.first("close"))
    busy = table(spark, d, "events").groupBy(F.to_date("ts").alias("date")).agg(F.bool_or(F.col("event_type") == "error").alias("had_error"))
    return wide.select("date", *[F.col(f"`{n}`").alias(f"close_{i}") for i, n in enumerate(names)]).join(busy, "date", "full_outer").withColumn(
        "had_error", F.coalesce("had_error", F.lit(False)))


PIVOT = f"""
WITH {BD}, n AS (SELECT symbol, row_number() OVER (ORDER BY symbol) - 1 AS i FROM (SELECT DISTINCT symbol FROM bars)),
w AS (SELECT date, {', '.join(f'max(close) FILTER (WHERE i = {i}) AS close_{i}' for i in range(5))} FROM bars JOIN n USING (symbol) GROUP BY date),
e AS (SELECT ts::DATE AS date, bool_or(event_type = 'error') AS h FROM events GROUP BY 1)
SELECT coalesce(w.date, e.date) AS date, close_0, close_1, close_2, close_3, close_4, coalesce(h, false) AS had_error FROM w FULL JOIN e ON w.date = e.date"""


def snapshot_merge(spark: SparkSession, d: str) -> DataFrame:
    """Latest purchase, error and click of every user, merged on the user."""
    e = table(spark, d, "events")
    parts = [
        e.where(F.col("event_type") == t).groupBy("user_id").agg(F.max_by("value", F.struct("ts", "event_id")).alias(f"{t}_value"), F.max("ts").alias(f"{t}_ts"))
        for t in ("purchase", "error", "click")
    ]
    return asof.outer_snapshots(parts, "user_id")


SNAPSHOT = "WITH " + ", ".join(
    f"{t} AS (SELECT user_id, arg_max(value, row(ts, event_id)) AS {t}_value, max(ts) AS {t}_ts FROM events WHERE event_type = '{t}' GROUP BY 1)" for t in ("purchase", "error", "click")
) + " SELECT * FROM purchase FULL JOIN error USING (user_id) FULL JOIN click USING (user_id)"


def anti_semi(spark: SparkSession, d: str) -> DataFrame:
    """Customers by whether they order, and suppliers' parts nobody bought."""
    c, o = table(spark, d, "customer").select("c_custkey"), table(spark, d, "orders").select("o_custkey")
    on = F.col("c_custkey") == F.col("o_custkey")
    none = c.join(o, on, "left_anti").select(F.lit("no_orders").alias("kind"), F.col("c_custkey").alias("id"))
    some = c.join(o, on, "left_semi").select(F.lit("orders").alias("kind"), F.col("c_custkey").alias("id"))
    parts = table(spark, d, "part").select("p_partkey").subtract(table(spark, d, "lineitem").select("l_partkey"))
    return none.unionByName(some).unionByName(parts.select(F.lit("unsold_part").alias("kind"), F.col("p_partkey").alias("id")))


ANTI = """
SELECT CASE WHEN EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey) THEN 'orders' ELSE 'no_orders' END AS kind, c_custkey AS id FROM customer
UNION ALL SELECT 'unsold_part', p_partkey FROM (SELECT p_partkey FROM part EXCEPT SELECT l_partkey FROM lineitem)"""


def targets_vs_positions(spark: SparkSession, d: str) -> DataFrame:
    """Shares to trade per part and supplier side, both sides' absences as zero, small trades skipped with a reason."""
    li = table(spark, d, "lineitem")
    held = li.where("l_returnflag = 'N'").groupBy(F.col("l_partkey").alias("part")).agg(F.sum("l_quantity").alias("held"))
    want = li.where("l_returnflag = 'A'").groupBy(F.col("l_partkey").alias("part")).agg(F.sum("l_quantity").alias("target"))
    j = held.join(want, "part", "full_outer").withColumns({c: F.coalesce(c, F.lit(0.0)) for c in ("held", "target")})
    return j.select(
        "part", "held", "target", (F.col("target") - F.col("held")).alias("delta"), F.floor((F.col("target") - F.col("held")) / 10).cast("long").alias("lots"),
        F.when(F.col("target") == F.col("held"), "unchanged").when(F.col("target") == 0, "close")
        .when(F.abs(F.col("target") - F.col("held")) < 10, "below_minimum").otherwise("trade").alias("decision"),
    )


TARGETS = """
WITH h AS (SELECT l_partkey AS part, sum(l_quantity) AS held FROM lineitem WHERE l_returnflag = 'N' GROUP BY 1),
w AS (SELECT l_partkey AS part, sum(l_quantity) AS target FROM lineitem WHERE l_returnflag = 'A' GROUP BY 1),
j AS (SELECT part, coalesce(held, 0.0) AS held, coalesce(target, 0.0) AS target FROM h FULL JOIN w USING (part))
SELECT part, held, target, target - held AS delta, floor((target - held) / 10)::BIGINT AS lots,
  CASE WHEN target = held THEN 'unchanged' WHEN target = 0 THEN 'close' WHEN abs(target - held) < 10 THEN 'below_minimum' ELSE 'trade' END AS decision FROM j"""


def three_source_merge(spark: SparkSession, d: str) -> DataFrame:
    """Names of nations from three tables, first non-blank by precedence, with presence flags."""
    a = table(spark, d, "supplier").groupBy(F.col("s_nationkey").alias("k")).agg(F.max("s_name").alias("a"))
    b = table(spark, d, "customer").groupBy(F.col("c_nationkey").alias("k")).agg(F.max("c_name").alias("b"))
    c = table(spark, d, "nation").where("n_nationkey % 2 = 0").select(F.col("n_nationkey").alias("k"), F.col("n_name").alias("c"))
    j = a.join(b, "k", "full_outer").join(c, "k", "full_outer")
    name = F.coalesce(*[F.nullif(F.trim(x), F.lit("")) for x in ("c", "a", "b")])
    return j.select("k", name.alias("name"), *[F.col(x).isNotNull().alias(f"in_{x}") for x in "abc"])


MERGE3 = """
WITH a AS (SELECT s_nationkey AS k, max(s_name) AS a FROM supplier GROUP BY 1), b AS (SELECT c_nationkey AS k, max(c_name) AS b FROM customer GROUP BY 1),
c AS (SELECT n_nationkey AS k, n_name AS c FROM nation WHERE n_nationkey % 2 = 0)
SELECT k, coalesce(nullif(trim(c), ''), nullif(trim(a), ''), nullif(trim(b), '')) AS name, a IS NOT NULL AS in_a, b IS NOT NULL AS in_b, c IS NOT NULL AS in_c
FROM a FULL JOIN b USING (k) FULL JOIN c USING (k)"""


def daily_resample(spark: SparkSession, d: str) -> DataFrame:
    """Segment statements on every calendar day, carried forward."""
    return asof.daily_spine(statements(spark, d).select("symbol", "date", "revenue", "shares_outstanding"), ["revenue", "shares_outstanding"])


RESAMPLE = f"""
WITH {ST}, s AS (SELECT symbol, unnest(generate_series(min(date), max(date), INTERVAL 1 DAY))::DATE AS date FROM st GROUP BY 1),
j AS (SELECT s.symbol, s.date, revenue, shares_outstanding FROM s LEFT JOIN st USING (symbol, date))
SELECT symbol, date, {filled('revenue')} AS revenue, {filled('shares_outstanding')} AS shares_outstanding FROM j"""


def statement_features(spark: SparkSession, d: str) -> DataFrame:
    """W15-W18, D4."""
    out = fundamentals.statement_features(statements(spark, d))
    return out.withColumns({c: F.round(c, 4) for c in ("revenue_ttm", "gross_profit_ttm", "net_income_ttm", "operating_cash_flow_ttm")}).withColumns(
        {c: F.round(c, 9) for c in ("roa_ttm", "gross_margin_ttm", "asset_turnover_ttm")})


def _statements_sql() -> str:
    def yoy(x: str, n: int) -> str:
        return f"{div(x, lag(x, n))} - 1"

    def year(x: str, op: str) -> str:
        return flag(f"{x} {op} {lag(x, 4)}")

    marks = {
        "piotroski_roa_pos": flag("roa > 0"), "piotroski_cfo_pos": flag("ocf > 0"), "piotroski_delta_roa_pos": year("roa", ">"), "piotroski_accruals_pos": flag("ocf > ni"),
        "piotroski_leverage_decrease": year("ltda", "<"), "piotroski_liquidity_increase": year("cr", ">"), "piotroski_no_new_shares": year("shares_outstanding", "<="),
        "piotroski_gross_margin_increase": year("gmt", ">"), "piotroski_asset_turnover_increase": year("ato", ">"),
    }
    return f"""
WITH {ST}, a AS (
  SELECT *, {yoy('revenue', 1)} AS rev_qoq, {yoy('revenue', 4)} AS rev_yoy, {yoy('net_income', 4)} AS net_inc_yoy, {yoy('shares_outstanding', 4)} AS shares_change_yoy,
    {div('gross_profit', 'revenue')} AS gm, {div('current_assets', 'current_liabilities')} AS cr, {full('sum', 'revenue', 4)} AS rv, {full('sum', 'gross_profit', 4)} AS gp,
    {full('sum', 'net_income', 4)} AS ni, {full('sum', 'operating_cash_flow', 4)} AS ocf, {div('long_term_debt', 'total_assets')} AS ltda FROM st
), b AS (SELECT *, {div('ni', 'total_assets')} AS roa, {div('gp', 'rv')} AS gmt, {div('rv', 'total_assets')} AS ato FROM a
), m AS (SELECT *, {', '.join(f'{v} AS {k}' for k, v in marks.items())}, gm - {lag('gm')} AS md FROM b)
SELECT symbol, date, revenue, gross_profit, operating_cash_flow, shares_outstanding, net_income, total_assets, long_term_debt, current_assets, current_liabilities,
  rev_qoq, rev_yoy, net_inc_yoy, shares_change_yoy, gm AS gross_margin, cr AS current_ratio_stmt, round(rv, 4) AS revenue_ttm, round(gp, 4) AS gross_profit_ttm,
  round(ni, 4) AS net_income_ttm, round(ocf, 4) AS operating_cash_flow_ttm, ltda AS long_term_debt_to_assets, md AS margin_delta_qoq, round(roa, 9) AS roa_ttm,
  round(gmt, 9) AS gross_margin_ttm, round(ato, 9) AS asset_turnover_ttm, {', '.join(marks)}, ({' + '.join(marks)})::INTEGER AS piotroski_f_score FROM m"""


def earnings_features(spark: SparkSession, d: str) -> DataFrame:
    """W19, U18."""
    return fundamentals.surprise_features(orders_as_earnings(spark, d).where("record_type = 'actual'")).drop("record_type")


EARNINGS = f"""
WITH {EO}, a AS (SELECT *, (reported_eps - eps_estimate) / nullif(abs(eps_estimate), 0.0) AS s FROM eo WHERE record_type = 'actual'),
b AS (SELECT *, CASE WHEN s IS NOT NULL THEN (s > 0)::INTEGER::DOUBLE END AS beat FROM a)
SELECT symbol, date, reported_eps, eps_estimate, report_date, s AS surprise_pct, {r6(full('avg', 's', 4))} AS surprise_mean_4q, {r6(full('stddev_samp', 's', 8))} AS surprise_std_8q,
  {r6(full('avg', 'beat', 8))} AS beat_rate_8q FROM b"""


def earnings_calendar(spark: SparkSession, d: str) -> DataFrame:
    """Every customer's order days with the last actual and the next scheduled report."""
    e = orders_as_earnings(spark, d, today="1998-01-01")
    return fundamentals.earnings_calendar(e.select("symbol", "date"), e)


CALENDAR = f"""
WITH {EO.replace("2001-06-30", "1998-01-01")}, a AS (
  SELECT symbol, date, record_type = 'actual' AS act, max(CASE WHEN record_type = 'actual' THEN date END) OVER w AS le FROM eo WINDOW w AS ({W} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
), s AS (SELECT symbol, date AS nd FROM eo WHERE record_type = 'scheduled'), j AS (SELECT a.*, s.nd FROM a ASOF LEFT JOIN s ON a.symbol = s.symbol AND a.date <= s.nd)
SELECT symbol, date, act::INTEGER AS is_earnings_day, le AS last_earnings_date, (date - le)::INTEGER AS days_since_earnings, nd AS next_earnings_date,
  (nd - date)::INTEGER AS days_until_next_earnings, (nd IS NOT NULL)::INTEGER AS has_upcoming_earnings, {flag('nd = date')} AS is_scheduled_earnings_day FROM j"""


def target_features(spark: SparkSession, d: str) -> DataFrame:
    """Region-weekly dispersion of prices read as price targets."""
    b = daily_bars(spark, d)
    t = b.groupBy("symbol", F.to_date(F.date_trunc("week", "date")).alias("obs_date")).agg(
        F.round(F.avg("close"), 6).alias("tp_mean_est"), F.round(F.stddev_samp("close"), 6).alias("tp_std_dev_est"), F.max("high").alias("tp_high_est"),
        F.min("low").alias("tp_low_est"), F.count(F.lit(1)).cast("int").alias("tp_cnt_est"), F.count_if(F.col("close") > F.col("open")).cast("int").alias("tp_cnt_est_rev_up"),
        F.count_if(F.col("close") < F.col("open")).cast("int").alias("tp_cnt_est_rev_down"),
    )
    return fundamentals.target_features(t)


_PW = "PARTITION BY symbol ORDER BY obs_date"
TARGET_FEATURES = f"""
WITH {BD}, t AS (
  SELECT symbol, date_trunc('week', date)::DATE AS obs_date, round(avg(close), 6) AS tp_mean_est, round(stddev_samp(close), 6) AS tp_std_dev_est, max(high) AS tp_high_est, min(low) AS tp_low_est,
    count(*)::INTEGER AS tp_cnt_est, count_if(close > open)::INTEGER AS tp_cnt_est_rev_up, count_if(close < open)::INTEGER AS tp_cnt_est_rev_down FROM bars GROUP BY 1, 2
), a AS (
  SELECT *, tp_high_est - tp_low_est AS disp_abs, {div('tp_std_dev_est', 'tp_mean_est')} AS disp_std_norm, tp_cnt_est_rev_up - tp_cnt_est_rev_down AS rev_net,
    (tp_cnt_est_rev_up + 1) / (tp_cnt_est_rev_down + 1) AS rev_ratio, {div('tp_cnt_est_rev_up + tp_cnt_est_rev_down', 'tp_cnt_est')} AS rev_intensity,
    row_number() OVER ({_PW})::DOUBLE AS n FROM t
), b AS (SELECT *, {div('disp_abs', 'tp_mean_est')} AS disp_norm FROM a)
SELECT symbol, obs_date, tp_mean_est, tp_std_dev_est, tp_high_est, tp_low_est, tp_cnt_est, tp_cnt_est_rev_up, tp_cnt_est_rev_down, disp_abs, disp_std_norm, rev_net, rev_ratio, rev_intensity, disp_norm,
  disp_norm - {lag('disp_norm', 30, w=_PW)} AS disp_norm_change_30d, tp_mean_est - {lag('tp_mean_est', 30, w=_PW)} AS tp_mean_change_30d,
  {r6(f"(disp_norm - ({full('avg', 'disp_norm', 252, w=_PW)})) / nullif({full('stddev_samp', 'disp_norm', 252, w=_PW)}, 0.0)")} AS disp_z,
  {r6(f"CASE WHEN count(tp_mean_est) OVER ({_PW} ROWS BETWEEN 89 PRECEDING AND CURRENT ROW) = 90 THEN regr_slope(tp_mean_est, n) OVER ({_PW} ROWS BETWEEN 89 PRECEDING AND CURRENT ROW) END")} AS tp_mean_slope_90d
FROM b"""


def altdata(spark: SparkSession, d: str) -> DataFrame:
    """Purchases as buys and errors as sells per user and day, with 30- and 90-day sums."""
    e = table(spark, d, "events").where("event_type in ('purchase', 'error')").select(
        F.to_date("ts").alias("as_of_date"), F.concat(F.lit("U"), "user_id").alias("symbol"), F.col("value").alias("amount"),
        F.when(F.col("event_type") == "purchase", "buy").otherwise("sell").alias("side"),
    )
    out = fundamentals.calendar_sums(fundamentals.daily_trades(e), ["buy_amount", "buy_count", "net_amount"])
    return out.withColumns({c: F.round(c, 6) + 0.0 for c in out.columns if "amount" in c})


_DAY = "PARTITION BY symbol ORDER BY as_of_date RANGE BETWEEN INTERVAL {n} DAY PRECEDING AND CURRENT ROW"
ALTDATA = f"""
WITH e AS (
  SELECT ts::DATE AS as_of_date, 'U' || user_id AS symbol, value AS amount, event_type = 'purchase' AS buy FROM events WHERE event_type IN ('purchase', 'error')
), g AS (
  SELECT as_of_date, symbol, count_if(buy) AS buy_count, count_if(NOT buy) AS sell_count, sum(CASE WHEN buy THEN amount ELSE 0.0 END) AS ba, sum(CASE WHEN NOT buy THEN amount ELSE 0.0 END) AS sa,
    max((amount >= 100)::INTEGER) AS has_large FROM e GROUP BY 1, 2
)
SELECT as_of_date, symbol, buy_count::BIGINT AS buy_count, sell_count::BIGINT AS sell_count, {r6('ba')} AS buy_amount, {r6('sa')} AS sell_amount, has_large, {r6('ba - sa')} AS net_amount,
  {', '.join(f"{r6(f'sum({x}) OVER ({_DAY.format(n=n - 1)})')} AS {y}_{n}d" for n in (30, 90) for x, y in (('ba', 'buy_amount'), ('ba - sa', 'net_amount')))},
  {', '.join(f"(sum(buy_count) OVER ({_DAY.format(n=n - 1)}))::BIGINT AS buy_count_{n}d" for n in (30, 90))} FROM g"""


def register_all(register) -> None:
    register("asof_backward", asof_backward, ASOF_BACK)
    register("asof_strict", asof_strict, ASOF_STRICT)
    register("asof_forward", asof_forward, ASOF_FWD)
    register("last_price", last_price, LAST_PRICE)
    register("enrich_ffill", enrich_ffill, ENRICH)
    register("spine_join", spine_join, SPINE)
    register("pivot_join", pivot_join, PIVOT)
    register("snapshot_merge", snapshot_merge, SNAPSHOT)
    register("anti_semi", anti_semi, ANTI)
    register("targets_vs_positions", targets_vs_positions, TARGETS)
    register("three_source_merge", three_source_merge, MERGE3)
    register("daily_resample", daily_resample, RESAMPLE)
    register("statement_features", statement_features, _statements_sql())
    register("earnings_features", earnings_features, EARNINGS)
    register("earnings_calendar", earnings_calendar, CALENDAR)
    register("target_features", target_features, TARGET_FEATURES)
    register("altdata_daily", altdata, ALTDATA)
