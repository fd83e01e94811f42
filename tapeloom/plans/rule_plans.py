"""Event rules, symbol clean-up, skips, alerts and column repair."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tapeloom.functions import macro
from tapeloom.operators import asof, clean, gates, maintain, reference
from tapeloom.plans.fixtures import BD, ST, daily_bars, statements
from tapeloom.plans.sqltext import filled, full
from tapeloom.session import table
from tapeloom.sources import payloads

_TITLES = (
    "US  CPI release", "FOMC minutes", "Nonfarm Payroll", "Housing starts in Japan", "ECB Governing Council", "Treasury auction result", "Loan survey of Britain", "UK trade balance",
    "Consumer sentiment", "Bank Rate decision", "PMI flash euro area", "Regulatory note", "Quarterly bulletin", "Monetary policy account",
)
_SOURCES = ("fred_releases", "ecb_policy_calendar", "boe_mpc_calendar", "boj_release_schedule", "vendor", "headline_feed")


def _events(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    title = F.element_at(F.array(*map(F.lit, _TITLES)), (F.pmod("event_id", F.lit(len(_TITLES))) + 1).cast("int"))
    source = F.element_at(F.array(*map(F.lit, _SOURCES)), (F.pmod("user_id", F.lit(len(_SOURCES))) + 1).cast("int"))
    return e.select("event_id", "ts", "user_id", "event_type", "value", title.alias("title"), source.alias("source"))


def _case(words: dict, text: str, other: str) -> str:
    return "CASE " + " ".join("WHEN " + " OR ".join(f"{text} LIKE '%{w}%'" for w in ws) + f" THEN '{k}'" for k, ws in words.items()) + f" ELSE '{other}' END"


def _place(i: int) -> str:
    by_source = " ".join(f"WHEN source = '{k}' THEN '{v[i]}'" for k, v in macro.SOURCE_PLACES.items())
    by_text = " ".join("WHEN " + " OR ".join(f"t LIKE '%{w}%'" for w in ws) + f" THEN '{v[i]}'" for ws, v in macro.TEXT_PLACES)
    return f"CASE {by_source} {by_text} END"


_EVENTS_SQL = f"""
e AS (SELECT event_id, ts, user_id, event_type, value, ({list(_TITLES)!r})[event_id % {len(_TITLES)} + 1] AS title, ({list(_SOURCES)!r})[user_id % {len(_SOURCES)} + 1] AS source FROM events),
l AS (SELECT *, lower(trim(regexp_replace(title, '\\s+', ' ', 'g'))) AS t FROM e), g AS (SELECT *, {_case(macro.EVENT_WORDS, 't', macro.OTHER_GROUP)} AS event_group, {_place(0)} AS country FROM l)"""


def event_groups(spark: SparkSession, d: str) -> DataFrame:
    """Group, importance, place, factors and identity of events titled like releases."""
    e = _events(spark, d).withColumn("event_group", macro.event_group(F.col("title")))
    where = macro.place(F.col("source"), F.col("title"))
    e = e.withColumns({"country": where["country"], "region": where["region"], "currency": where["currency"]})
    return e.select("event_id", "event_group", macro.importance(F.col("title"), F.col("event_group")).alias("importance"), "country", "region", "currency",
                    F.array_join(macro.factor_tags(F.col("event_group")), ",").alias("factors"),
                    macro.event_key(F.col("country"), F.col("event_group"), F.col("event_type"), F.lit(None).cast("string"), F.date_trunc("day", "ts"), F.col("event_id").cast("string")).alias("event_key"))


GROUPS = f"""
WITH {_EVENTS_SQL}
SELECT event_id, event_group, CASE WHEN event_group = 'CentralBankPolicy' THEN CASE WHEN t LIKE '%minutes%' OR t LIKE '%account%' THEN 'medium' ELSE 'high' END
    WHEN {' OR '.join(f"t LIKE '%{w}%'" for w in macro.HIGH_WORDS)} OR event_group IN ('Inflation', 'Labor') THEN 'high' WHEN event_group IN ('GrowthActivity', 'RatesFiscal') THEN 'medium' ELSE 'low' END AS importance,
  country, {_place(1)} AS region, {_place(2)} AS currency, CASE event_group {' '.join(f"WHEN '{k}' THEN '{','.join(v)}'" for k, v in macro.FACTORS.items())} ELSE '' END AS factors,
  sha256(coalesce(country, '') || '|' || event_group || '|' || event_type || '||' || strftime(date_trunc('day', ts), '%Y-%m-%dT%H:%M:%S')) AS event_key FROM g"""


def catalyst_chain(spark: SparkSession, d: str) -> DataFrame:
    """Batches of titled events and headlines split by kind, bad ones kept apart, one row per natural key, then per day and group."""
    e = _events(spark, d).withColumn("event_group", macro.event_group(F.col("title")))
    good, bad = payloads.split_rejects(e, {"no_value": F.col("value") < 5, "too_large": F.col("value") > 95}, F.col("event_id"), F.col("title"))
    where = macro.place(F.col("source"), F.col("title"))
    headline = F.col("source") == "headline_feed"
    key = F.when(headline, macro.headline_key(F.lit(None).cast("string"), F.col("title"), F.date_trunc("day", "ts"), F.col("event_type"))).otherwise(
        macro.event_key(where["country"], F.col("event_group"), F.col("event_type"), F.lit(None).cast("string"), F.date_trunc("day", "ts"), F.col("event_id").cast("string")))
    items = good.select(F.when(headline, "headline").otherwise("event").alias("kind"), key.alias("key"), F.to_date("ts").alias("day"), "event_group", "value", "event_id", "ts")
    quarantined = bad.select(F.lit("quarantine").alias("kind"), F.sha2(F.concat_ws("|", "reason", "identifier"), 256).alias("key"), F.lit(None).cast("date").alias("day"), F.col("reason").alias("event_group"),
                             F.lit(None).cast("double").alias("value"), F.col("identifier").cast("long").alias("event_id"), F.lit(None).cast("timestamp").alias("ts"))
    last = clean.last_per_key(items.unionByName(quarantined), ["kind", "key"], F.desc("ts"), F.desc("event_id"))
    return last.groupBy("kind", "day", "event_group").agg(F.count(F.lit(1)).alias("n"), F.max("value").alias("highest"), F.max("event_id").alias("newest"))


CATALYST = f"""
WITH {_EVENTS_SQL}, i AS (
  SELECT CASE WHEN value < 5 OR value > 95 THEN 'quarantine' WHEN source = 'headline_feed' THEN 'headline' ELSE 'event' END AS kind, *, ts::DATE AS d FROM g
), k AS (SELECT *, CASE kind WHEN 'quarantine' THEN event_id::VARCHAR WHEN 'headline' THEN title || '|' || d || '|' || event_type
    ELSE coalesce(country, '') || '|' || event_group || '|' || event_type || '|' || d END AS key FROM i),
u AS (SELECT * FROM k QUALIFY row_number() OVER (PARTITION BY kind, key ORDER BY ts DESC, event_id DESC) = 1)
SELECT kind, CASE WHEN kind <> 'quarantine' THEN d END AS day, CASE WHEN kind <> 'quarantine' THEN event_group WHEN value < 5 THEN 'no_value' ELSE 'too_large' END AS event_group,
  count(*) AS n, max(CASE WHEN kind <> 'quarantine' THEN value END) AS highest, max(event_id) AS newest FROM u GROUP BY 1, 2, 3"""


def symbol_cleanup(spark: SparkSession, d: str) -> DataFrame:
    """What parts' texts tell about a security, into profiles that lack it; locked fields stay, what remains is listed."""
    p = table(spark, d, "part")
    k = F.col("p_partkey")

    def pick(*xs) -> F.Column:
        return F.element_at(F.array(*[F.lit(x) for x in xs]), (F.pmod(k, F.lit(len(xs))) + 1).cast("int"))

    symbol = F.concat(F.lit("P"), k.cast("string"), pick("", "", ".B", "-C", ""))
    facts = p.select(symbol.alias("symbol"), F.concat_ws(" ", "p_name", pick("", "Class A", "ETF", "preferred", "closed-end", "American Depositary Receipt", "")).alias("name"), F.lit(None).cast("string").alias("description"),
                     pick("Common Stock", None, "Units", "warrant", "mutual fund", "bond").alias("asset_type"), pick("NYSE", " nasdaq  global market", "OTC", "LSE", None, "PINK", "cboe bzx").alias("exchange"),
                     F.col("p_type").alias("sector"), F.col("p_brand").alias("industry"), F.lit(None).cast("string").alias("industry2"), pick("US", " ", None).alias("country"), pick("Active", "Inactive", "Halted", "merged", None).alias("status"), pick("", "", "2020-01-01", None).alias("delisting_date"))
    profiles = p.select(symbol.alias("symbol"), F.when(k % 7 == 0, F.array(F.lit("share_class"), F.lit("is_etf"))).otherwise(F.array().cast("array<string>")).alias("locked_fields"),
                        pick("XNYS", "n/a", None).alias("exchange_mic"), pick("GB", " Unknown ").alias("country_of_risk"), F.lit(None).cast("string").alias("listing_status_norm"),
                        pick("Class B", "tbd", "", "not provided").alias("share_class"), pick("other", None).alias("security_type_norm"), *[F.lit(None).cast("string").alias(n) for n in reference.FLAG_WORDS])
    out = reference.clean_symbols(facts, profiles)
    return out.select("symbol", *[F.col("updates")[n].alias(n) for n in reference.FIELDS], F.array_join("remaining", ",").alias("remaining"))


def _cleanup_sql() -> str:
    def pick(*xs) -> str:
        return "([" + ", ".join("NULL" if x is None else f"'{x}'" for x in xs) + f"])[p_partkey % {len(xs)} + 1]"

    flags = {n: " OR ".join(f"corpus LIKE '%{w}%'" for w in ws) for n, ws in reference.FLAG_WORDS.items()}
    from tapeloom.functions.scalars import MARKET_CODES

    mic = "CASE upper(trim(regexp_replace(exchange, '\\s+', ' ', 'g'))) " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in MARKET_CODES.items()) + " END"
    state = "CASE WHEN delisting <> '' THEN 'delisted' " + " ".join(f"WHEN regexp_matches(lower(status), '\\b{k}\\b') THEN '{v}'" for k, v in reference.LISTING_STATES.items()) + " END"
    kind = "CASE " + " ".join(f"WHEN {flags[n]} THEN '{v}'" for n, v in reference.FLAG_KINDS.items()) + " " + " ".join(f"WHEN lower(asset_type) LIKE '%{k}%' THEN '{v}'" for k, v in reference.ASSET_KINDS.items()) + " END"
    told = {"exchange_mic": mic, "country_of_risk": "nullif(trim(country), '')", "listing_status_norm": state, "share_class": """CASE WHEN regexp_matches(name, '(?i)\\bclass\\s+[a-z0-9]+\\b') THEN 'Class ' || upper(regexp_extract(name, '(?i)\\bclass\\s+([a-z0-9]+)\\b', 1))
      WHEN regexp_matches(symbol, '[.\\-][A-Z]$') THEN 'Class ' || right(symbol, 1) END""", "security_type_norm": kind, **{n: f"CASE WHEN {c} THEN 'true' END" for n, c in flags.items()}}
    open_ = {"exchange_mic": "p_partkey % 3 <> 0", "country_of_risk": "p_partkey % 2 = 1", "listing_status_norm": "true", "share_class": "p_partkey % 4 <> 0 AND p_partkey % 7 <> 0", "security_type_norm": "p_partkey % 2 = 1",
             **{n: "p_partkey % 7 <> 0" if n == "is_etf" else "true" for n in reference.FLAG_WORDS}}
    return f"""
WITH f AS (SELECT *, 'P' || p_partkey || {pick("", "", ".B", "-C", "")} AS symbol, concat_ws(' ', p_name, {pick("", "Class A", "ETF", "preferred", "closed-end", "American Depositary Receipt", "")}) AS name,
  {pick("Common Stock", None, "Units", "warrant", "mutual fund", "bond")} AS asset_type, {pick("NYSE", " nasdaq  global market", "OTC", "LSE", None, "PINK", "cboe bzx")} AS exchange, {pick("US", " ", None)} AS country,
  {pick("Active", "Inactive", "Halted", "merged", None)} AS status, {pick("", "", "2020-01-01", None)} AS delisting FROM part),
c AS (SELECT *, concat_ws(' ', lower(symbol), lower(trim(name)), lower(asset_type), lower(trim(exchange)), lower(p_type), lower(p_brand)) AS corpus FROM f),
t AS (SELECT p_partkey, symbol, {', '.join(f'{v} AS {n}' for n, v in told.items())} FROM c)
SELECT symbol, {', '.join(f'CASE WHEN {open_[n]} THEN {n} END AS {n}' for n in told)},
  array_to_string(list_filter([{', '.join(f"CASE WHEN {open_[n]} AND {n} IS NULL THEN '{n}' END" for n in told)}], lambda x: x IS NOT NULL), ',') AS remaining FROM t"""


def reprocess_changed(spark: SparkSession, d: str) -> DataFrame:
    """customers' order folders that are new, have another signature, or changed after the last success."""
    o = table(spark, d, "orders")
    blobs = o.groupBy(F.col("o_custkey").alias("path")).agg(F.count(F.lit(1)).cast("string").alias("etag"), F.max("o_orderdate").alias("modified_at"))
    prior = o.where("o_orderdate < timestamp '2000-01-01' and o_custkey % 10 <> 0").groupBy(F.col("o_custkey").alias("path")).agg(F.count(F.lit(1)).cast("string").alias("prior_etag"))
    return gates.to_reprocess(blobs, prior, "path", "1998-06-01 00:00:00").select("path", "reason")


REPROCESS = """
WITH b AS (SELECT o_custkey AS path, count(*) AS n, max(o_orderdate) AS m FROM orders GROUP BY 1), p AS (SELECT o_custkey AS path, count(*) AS n FROM orders WHERE o_orderdate < TIMESTAMP '2000-01-01' AND o_custkey % 10 <> 0 GROUP BY 1)
SELECT * FROM (SELECT b.path, CASE WHEN p.n IS NULL THEN 'new' WHEN p.n <> b.n THEN 'changed' WHEN b.m > TIMESTAMP '1998-06-01' THEN 'modified' END AS reason FROM b LEFT JOIN p USING (path)) WHERE reason IS NOT NULL"""


def sync_skips(spark: SparkSession, d: str) -> DataFrame:
    """Segments whose last sync succeeded at the source's commit or a later one are skipped."""
    c = table(spark, d, "customer")
    source = c.groupBy(F.col("c_mktsegment").alias("bucket"), (F.col("c_nationkey") % 5).alias("part")).agg(F.when(F.max("c_custkey") % 7 != 0, F.max("c_custkey").cast("double")).alias("source_commit"))
    state = c.where("c_acctbal > 0").groupBy(F.col("c_mktsegment").alias("bucket"), (F.col("c_nationkey") % 5).alias("part")).agg(
        F.max("c_custkey").cast("string").alias("prior_commit"), F.when(F.min("c_custkey") % 3 == 0, "Failed").otherwise(" Success").alias("status"))
    return gates.sync_current(source, state, ["bucket", "part"])


SYNC = """
WITH s AS (SELECT c_mktsegment AS bucket, c_nationkey % 5 AS part, CASE WHEN max(c_custkey) % 7 <> 0 THEN max(c_custkey)::DOUBLE END AS source_commit FROM customer GROUP BY 1, 2),
p AS (SELECT c_mktsegment AS bucket, c_nationkey % 5 AS part, max(c_custkey) AS pc, min(c_custkey) % 3 = 0 AS bad FROM customer WHERE c_acctbal > 0 GROUP BY 1, 2)
SELECT bucket, part, source_commit, coalesce(NOT bad AND pc >= source_commit, false) AS is_current FROM s LEFT JOIN p USING (bucket, part)"""


def zero_writes(spark: SparkSession, d: str) -> DataFrame:
    """Q10: orders as runs: those whose lines (processed) hold none that was returned (written)."""
    li = table(spark, d, "lineitem")
    runs = li.groupBy(F.col("l_orderkey").alias("job")).agg(F.count(F.lit(1)).alias("processed"), F.count_if(F.col("l_returnflag") == "R").alias("written"))
    return gates.zero_write(runs)


ZERO = """SELECT l_orderkey AS job, count(*) AS processed, count_if(l_returnflag = 'R')::BIGINT AS written FROM lineitem GROUP BY 1 HAVING count_if(l_returnflag = 'R') = 0"""


def source_failures(spark: SparkSession, d: str) -> DataFrame:
    """Q20: per nation, suppliers as sources: whether a run fails, and why."""
    s = table(spark, d, "supplier").select(F.col("s_nationkey").alias("run"), (F.col("s_acctbal") < 4000).alias("failed"), (F.col("s_suppkey") % 3 == 0).alias("official"))
    return gates.source_decision(s, "run")


FAILURES = """
SELECT s_nationkey AS run, bool_and(s_acctbal < 4000) OR coalesce(bool_and(s_acctbal < 4000) FILTER (WHERE s_suppkey % 3 = 0), false) AS fails,
  CASE WHEN bool_and(s_acctbal < 4000) THEN 'all_selected_sources_failed' WHEN coalesce(bool_and(s_acctbal < 4000) FILTER (WHERE s_suppkey % 3 = 0), false) THEN 'all_required_sources_failed' ELSE 'partial_source_outage' END AS reason,
  count_if(s_acctbal < 4000)::BIGINT AS failed, count_if(s_acctbal >= 4000)::BIGINT AS succeeded FROM supplier GROUP BY 1"""


def excluded_types(spark: SparkSession, d: str) -> DataFrame:
    """How many parts a universe rule leaves out, by type; blank types count as unknown, required parts do not count."""
    p = table(spark, d, "part").withColumn("asset_type", F.when(F.col("p_size") % 9 != 0, F.upper(F.trim("p_type"))).otherwise(""))
    return p.where(~(F.col("p_retailprice") > 950) & ~F.col("p_partkey").isin(1, 2, 3)).groupBy(F.coalesce(F.nullif("asset_type", F.lit("")), F.lit("UNKNOWN")).alias("asset_type")).agg(F.count(F.lit(1)).alias("n"))


EXCLUDED = """
SELECT CASE WHEN p_size % 9 = 0 OR trim(p_type) = '' THEN 'UNKNOWN' ELSE upper(trim(p_type)) END AS asset_type, count(*) AS n FROM part WHERE NOT p_retailprice > 950 AND p_partkey NOT IN (1, 2, 3) GROUP BY 1"""


def macro_inputs(spark: SparkSession, d: str) -> DataFrame:
    """Rate and credit inputs of every region; a missing curve is the difference of its rates, a z-score is derived only where a region has none at all."""
    b = daily_bars(spark, d)
    m = b.select("symbol", "date", (F.col("open") / 1000).alias("rate_2y"), (F.col("close") / 1000).alias("rate_10y"), F.when(F.col("volume") > 100, F.lit(0.5)).alias("curve_2s10s"), F.col("high").alias("hy_oas"),
                 F.when((F.length("symbol") % 2 == 0) & (F.dayofmonth("date") == 1), F.lit(0.25)).alias("hy_oas_z_20d"))
    w = Window.partitionBy("symbol")
    rows = w.orderBy("date").rowsBetween(-19, 0)
    z = (F.col("hy_oas") - F.avg("hy_oas").over(rows)) / F.nullif(F.stddev("hy_oas").over(rows), F.lit(0.0))
    z = F.when((F.count("hy_oas_z_20d").over(w) == 0) & (F.count("hy_oas").over(rows) == 20), F.round(z, 6)).otherwise(F.col("hy_oas_z_20d"))
    return m.withColumns({"curve_2s10s": F.coalesce("curve_2s10s", F.round(F.col("rate_10y") - F.col("rate_2y"), 9)), "z": z}).select("symbol", "date", "curve_2s10s", F.col("z").alias("hy_oas_z_20d"))


_Z = f"(high - {full('avg', 'high', 20)}) / nullif({full('stddev_samp', 'high', 20)}, 0.0)"
MACRO = f"""
WITH {BD}, m AS (SELECT *, CASE WHEN length(symbol) % 2 = 0 AND day(date) = 1 THEN 0.25::DOUBLE END AS z FROM bars)
SELECT symbol, date, CASE WHEN volume > 100 THEN 0.5::DOUBLE ELSE round(close / 1000 - open / 1000, 9) END AS curve_2s10s,
  CASE WHEN count(z) OVER (PARTITION BY symbol) = 0 THEN round({_Z}, 6) ELSE z END AS hy_oas_z_20d FROM m"""


def column_repair(spark: SparkSession, d: str) -> DataFrame:
    """Residue of indexes, future and source columns dropped, repeated symbol columns made one, rows without a metric dropped."""
    c = table(spark, d, "customer")
    k = F.col("c_custkey")
    raw = c.select(k.alias("Unnamed: 0"), k.alias("index_level_0"), F.when(k % 3 != 0, F.concat(F.lit("C"), k)).alias("Symbol"), F.when(k % 2 == 0, F.concat(F.lit("C"), k + (k % 5))).otherwise(F.concat(F.lit("C"), k)).alias("symbol"),
                   F.col("c_acctbal").alias("ExcessReturn"), k.alias("source_hash"), F.when(k % 4 != 0, F.col("c_acctbal")).alias("Net Income"), F.when(k % 6 == 0, F.col("c_nationkey")).alias("TotalAssets"))
    out = clean.one_symbol(clean.without_residue(clean.snake_names(raw)))
    return clean.with_any(out, ["net_income", "total_assets"])


REPAIR = """
WITH r AS (SELECT c_custkey AS k, CASE WHEN c_custkey % 3 <> 0 THEN 'C' || c_custkey END AS a, CASE WHEN c_custkey % 2 = 0 THEN 'C' || (c_custkey + c_custkey % 5) ELSE 'C' || c_custkey END AS b,
  CASE WHEN c_custkey % 4 <> 0 THEN c_acctbal END AS net_income, CASE WHEN c_custkey % 6 = 0 THEN c_nationkey END AS total_assets FROM customer)
SELECT coalesce(a, b) AS symbol, net_income, total_assets, a IS NOT NULL AND a <> b AS conflict FROM r WHERE net_income IS NOT NULL OR total_assets IS NOT NULL"""


def seed_capital(spark: SparkSession, d: str) -> DataFrame:
    """A10: per supplier the cash-like lines of its ledger; where they cancel out, the weighted seeds of its parts."""
    li = table(spark, d, "lineitem")
    cash = F.when(F.col("l_returnflag").isin("A", "N"), F.when(F.col("l_linestatus") == "O", F.lit(0.0)).otherwise(F.round(F.col("l_extendedprice"), 2)))
    g = li.groupBy(F.col("l_suppkey").alias("book")).agg(F.round(F.coalesce(F.sum(cash), F.lit(0.0)), 2).alias("net_cash"), F.round(F.sum(F.col("l_tax") * F.col("l_extendedprice")), 2).alias("weighted"))
    return g.select("book", F.when(F.abs("net_cash") > 1e-9, F.col("net_cash")).otherwise(F.col("weighted")).alias("seed"))


SEED = """
WITH g AS (SELECT l_suppkey AS book, round(coalesce(sum(CASE WHEN l_returnflag IN ('A', 'N') AND l_linestatus <> 'O' THEN round(l_extendedprice, 2) END), 0.0), 2) AS c, round(sum(l_tax * l_extendedprice), 2) AS w FROM lineitem GROUP BY 1)
SELECT book, CASE WHEN abs(c) > 1e-9 THEN c ELSE w END AS seed FROM g"""


def silver_finance(spark: SparkSession, d: str) -> DataFrame:
    """D3: segments' statements as payloads, parsed, on every calendar day, carried forward, rounded half up."""
    row = F.struct(F.date_format("date", "yyyy-MM-dd").alias("period_end"), F.lit("quarterly").alias("timeframe"), F.col("revenue").cast("string").alias("revenue"), F.col("gross_profit").cast("string").alias("GrossProfit"))
    lists = statements(spark, d).groupBy("symbol").agg(F.to_json(F.struct(F.array_sort(F.collect_list(row)).alias("results"))).alias("payload"))
    rows = payloads.report_rows(lists, "payload", ["symbol"], "results", ["date", "period_end"], {"revenue": ["revenue"], "gross_profit": ["gross_profit"]}).drop("timeframe")
    days = asof.daily_spine(rows, ["revenue", "gross_profit"])
    return days.select("symbol", "date", *[F.round(c, 2).alias(c) for c in ("revenue", "gross_profit")])


FINANCE = f"""
WITH {ST}, s AS (SELECT symbol, unnest(generate_series(min(date), max(date), INTERVAL 1 DAY))::DATE AS date FROM st GROUP BY 1), j AS (SELECT s.symbol, s.date, revenue, gross_profit FROM s LEFT JOIN st USING (symbol, date))
SELECT symbol, date, {filled('revenue')} AS revenue, {filled('gross_profit')} AS gross_profit FROM j"""


def silver_targets(spark: SparkSession, d: str) -> DataFrame:
    """Monthly price targets of regions on every day up to a stated today, carried forward, rounded half up."""
    b = daily_bars(spark, d).withColumn("date", F.trunc("date", "month"))
    t = b.groupBy("symbol", "date").agg(F.max("high").alias("tp_high"), F.min("low").alias("tp_low"), F.count(F.lit(1)).alias("tp_cnt"))
    days = asof.daily_spine(t, ["tp_high", "tp_low", "tp_cnt"], until="2002-03-31")
    return days.select("symbol", "date", F.round("tp_high", 9).alias("tp_high"), F.round("tp_low", 9).alias("tp_low"), "tp_cnt")


TARGETS = f"""
WITH {BD}, t AS (SELECT symbol, date_trunc('month', date)::DATE AS date, max(high) AS tp_high, min(low) AS tp_low, count(*) AS tp_cnt FROM bars GROUP BY 1, 2),
s AS (SELECT symbol, unnest(generate_series(min(date), DATE '2002-03-31', INTERVAL 1 DAY))::DATE AS date FROM t GROUP BY 1), j AS (SELECT s.symbol, s.date, tp_high, tp_low, tp_cnt FROM s LEFT JOIN t USING (symbol, date))
SELECT symbol, date, round({filled('tp_high')}, 9) AS tp_high, round({filled('tp_low')}, 9) AS tp_low, {filled('tp_cnt')} AS tp_cnt FROM j"""


def register_all(register) -> None:
    for name, fn, sql in (
        ("event_groups", event_groups, GROUPS), ("catalyst_chain", catalyst_chain, CATALYST), ("symbol_cleanup", symbol_cleanup, _cleanup_sql()), ("reprocess_changed", reprocess_changed, REPROCESS), ("sync_skips", sync_skips, SYNC),
        ("zero_writes", zero_writes, ZERO), ("source_failures", source_failures, FAILURES), ("excluded_types", excluded_types, EXCLUDED), ("macro_inputs", macro_inputs, MACRO), ("column_repair", column_repair, REPAIR),
        ("seed_capital", seed_capital, SEED), ("silver_finance", silver_finance, FINANCE), ("silver_targets", silver_targets, TARGETS),
    ):
        register(name, fn, sql)
