"""Listings, calendars, reference data, table upkeep and run tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tapeloom.functions import scalars as S
from tapeloom.operators import asof, clean, gates, maintain
from tapeloom.plans.fixtures import BD, BW, EO, daily_bars, orders_as_earnings, weekly_bars
from tapeloom.plans.sqltext import W
from tapeloom.session import shared_folder, table
from tapeloom.sources import payloads, tables

def sessions(spark: SparkSession, d: str) -> DataFrame:
    """next session after each order day (weekends and listed holidays skipped), and quantities rounded four ways."""
    o = table(spark, d, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("day"), (F.col("o_totalprice") / 1000).alias("q"))
    days = o.select("day").distinct()
    holiday = days.where((F.month("day") == 1) & (F.dayofmonth("day") == 1)).select(F.col("day").alias("closed"))
    ahead = days.select("day", F.explode(F.sequence(F.date_add("day", 1), F.date_add("day", 5))).alias("next"))
    nxt = ahead.where(~F.dayofweek("next").isin(1, 7)).join(holiday, F.col("next") == F.col("closed"), "left_anti").groupBy("day").agg(F.min("next").alias("next_session"))
    return o.join(nxt, "day").select("o_orderkey", "day", "next_session", F.floor("q").cast("long").alias("down"), F.ceil("q").cast("long").alias("up"),
                                     F.when(F.col("q") < 0, F.ceil("q")).otherwise(F.floor("q")).cast("long").alias("toward_zero"))


SESSIONS = """
WITH o AS (SELECT o_orderkey, o_orderdate::DATE AS day, o_totalprice / 1000 AS q FROM orders), h AS (SELECT DISTINCT day AS closed FROM o WHERE month(day) = 1 AND day(day) = 1),
a AS (SELECT day, day + i::INTEGER AS nx FROM (SELECT DISTINCT day FROM o), range(1, 6) t(i)), n AS (SELECT day, min(nx) AS ns FROM a WHERE isodow(nx) < 6 AND nx NOT IN (SELECT closed FROM h) GROUP BY 1)
SELECT o_orderkey, o.day, ns AS next_session, floor(q)::BIGINT AS down, ceil(q)::BIGINT AS up, trunc(q)::BIGINT AS toward_zero FROM o JOIN n USING (day)"""


def alias_dedupe(spark: SparkSession, d: str) -> DataFrame:
    """Suppliers of one nation read as aliases of one symbol; a canonical row wins, then the first, within a date range."""
    s = table(spark, d, "supplier")
    alias = F.when(F.col("s_suppkey") % 2 == 0, F.concat(F.lit("^"), "s_nationkey")).otherwise(F.col("s_nationkey").cast("string"))
    r = s.select(F.regexp_replace(alias, r"^\^", "").alias("symbol"), alias.startswith("^").alias("is_alias"), "s_suppkey", F.date_add(F.lit("2016-01-01").cast("date"), (F.col("s_suppkey") % 900).cast("int")).alias("date"))
    r = r.where(F.col("date").between("2016-01-15", "2018-01-01"))
    return clean.last_per_key(r, ["symbol"], F.col("is_alias"), F.col("s_suppkey"))


ALIASES = """
WITH r AS (SELECT s_nationkey::VARCHAR AS symbol, s_suppkey % 2 = 0 AS is_alias, s_suppkey, DATE '2016-01-01' + (s_suppkey % 900)::INTEGER AS date FROM supplier)
SELECT symbol, is_alias, s_suppkey, date FROM (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY is_alias, s_suppkey) AS k FROM r WHERE date BETWEEN DATE '2016-01-15' AND DATE '2018-01-01') WHERE k = 1"""


def latest_rule(spark: SparkSession, d: str) -> DataFrame:
    """A rule on each customer's latest order only."""
    o = table(spark, d, "orders").select("o_custkey", "o_orderdate", "o_orderkey", "o_totalprice", "o_orderstatus")
    last = o.groupBy("o_custkey").agg(F.max_by(F.struct("o_totalprice", "o_orderstatus"), F.struct("o_orderdate", "o_orderkey", "o_totalprice")).alias("l")).select("o_custkey", "l.*")
    kinds = {n: k for n, k, _ in clean.field_catalog(last)}
    return last.where(clean.rule({"and": [{"field": "o_totalprice", "op": "gt", "value": 200000.0}, {"field": "o_orderstatus", "op": "in", "values": ["O", "F"]}]}, kinds))


LATEST_RULE = """
SELECT * FROM (SELECT o_custkey, arg_max(o_totalprice, row(o_orderdate, o_orderkey, o_totalprice)) AS o_totalprice, arg_max(o_orderstatus, row(o_orderdate, o_orderkey, o_totalprice)) AS o_orderstatus FROM orders GROUP BY 1)
WHERE o_totalprice > 200000 AND o_orderstatus IN ('O', 'F')"""


def revision_backfill(spark: SparkSession, d: str) -> DataFrame:
    """Events joined to nations by a key inside their JSON, blanks as missing."""
    e = table(spark, d, "events").select("event_id", F.nullif(F.trim(F.get_json_object("props", "$.k")), F.lit("")).try_cast("int").alias("k"))
    n = table(spark, d, "nation").select(F.col("n_nationkey").alias("k"), "n_name", "n_regionkey")
    r = table(spark, d, "region").select(F.col("r_regionkey").alias("n_regionkey"), "r_name")
    return e.join(n, "k", "left").join(r, "n_regionkey", "left").select("event_id", "k", "n_name", "r_name")


BACKFILL = """
SELECT event_id, json_extract_string(props, '$.k')::INTEGER AS k, n_name, r_name FROM events LEFT JOIN nation ON n_nationkey = json_extract_string(props, '$.k')::INTEGER LEFT JOIN region ON r_regionkey = n_regionkey"""


def fingerprints(spark: SparkSession, d: str) -> DataFrame:
    """Per status a fingerprint that does not depend on row order, the range of days, and counts."""
    o = table(spark, d, "orders")
    h = F.conv(F.substring(F.md5(F.concat_ws("|", F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string"), "o_orderpriority")), 1, 10), 16, 10).cast("long")
    return o.groupBy("o_orderstatus").agg(F.sum(h).alias("fingerprint"), F.min(F.to_date("o_orderdate")).alias("first_day"), F.max(F.to_date("o_orderdate")).alias("last_day"),
                                          F.count_if(F.col("o_totalprice") > 250000).alias("large"), F.count(F.lit(1)).alias("n"))


FINGERPRINTS = """
SELECT o_orderstatus, sum(('0x' || substr(md5(o_orderkey || '|' || o_custkey || '|' || o_orderpriority), 1, 10))::BIGINT)::BIGINT AS fingerprint, min(o_orderdate)::DATE AS first_day, max(o_orderdate)::DATE AS last_day,
  count_if(o_totalprice > 250000)::BIGINT AS large, count(*) AS n FROM orders GROUP BY 1"""


#: Customers that one batch of a segment takes.
BATCH = 25


def run_choice(spark: SparkSession, d: str) -> DataFrame:
    """Best finished order of every customer (urgent first, newest, highest key); the batch of BATCH per segment that waits longest."""
    o = table(spark, d, "orders").where("o_orderstatus = 'F'")
    best = clean.last_per_key(o, ["o_custkey"], F.col("o_orderpriority"), F.desc("o_orderdate"), F.desc("o_orderkey"), F.desc("o_totalprice"))
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment").join(best.select("o_custkey", "o_orderkey", F.to_date("o_orderdate").alias("day")), "o_custkey", "left")
    return clean.first_per(c, ["c_mktsegment"], BATCH, F.asc_nulls_first("day"), F.col("o_custkey")).select("c_mktsegment", "turn", "o_custkey", "o_orderkey", "day")


RUN_CHOICE = f"""
WITH b AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderpriority, o_orderdate DESC, o_orderkey DESC, o_totalprice DESC) AS k FROM orders WHERE o_orderstatus = 'F'),
j AS (SELECT c_custkey AS o_custkey, c_mktsegment, o_orderkey, o_orderdate::DATE AS day FROM customer LEFT JOIN (SELECT * FROM b WHERE k = 1) x ON x.o_custkey = c_custkey),
t AS (SELECT *, row_number() OVER (PARTITION BY c_mktsegment ORDER BY day NULLS FIRST, o_custkey)::INTEGER AS turn FROM j)
SELECT c_mktsegment, turn, o_custkey, o_orderkey, day FROM t WHERE turn <= {BATCH}"""


def sweeps(spark: SparkSession, d: str) -> DataFrame:
    """Lines without an order, orders before a day, and what stays, with letters touched."""
    li, o = table(spark, d, "lineitem"), table(spark, d, "orders")
    old = o.where(F.col("o_orderdate") < F.lit("1995-06-01").cast("timestamp"))
    orphan = li.join(o.where("o_orderkey % 5 <> 0").select(F.col("o_orderkey").alias("l_orderkey")), "l_orderkey", "left_anti")
    parts = [
        old.agg(F.lit("orders_before_cutoff").alias("what"), F.count(F.lit(1)).alias("n")), orphan.agg(F.lit("orphan_lines").alias("what"), F.count(F.lit(1)).alias("n")),
        o.join(old.select("o_orderkey"), "o_orderkey", "left_anti").agg(F.lit("orders_kept").alias("what"), F.count(F.lit(1)).alias("n")),
        table(spark, d, "part").groupBy(F.concat(F.lit("bucket_"), maintain.bucket_letter(F.col("p_name"))).alias("what")).agg(F.countDistinct("p_name").alias("n")),
    ]
    return maintain.union_all(*parts)


SWEEPS = """
WITH old AS (SELECT o_orderkey FROM orders WHERE o_orderdate < TIMESTAMP '1995-06-01')
SELECT 'orders_before_cutoff' AS what, count(*) AS n FROM old UNION ALL SELECT 'orphan_lines', count(*) FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderkey % 5 <> 0)
UNION ALL SELECT 'orders_kept', count(*) FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM old)
UNION ALL SELECT 'bucket_' || coalesce(nullif(regexp_extract(upper(p_name), '[A-Z]', 0), ''), 'X'), count(DISTINCT p_name) FROM part GROUP BY 1"""


def bucket_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """Customers by letter bucket, one bucket rewritten in place, read back pruned."""
    path = f"{shared_folder(spark)}/buckets-{uuid.uuid4().hex}"
    c = table(spark, d, "customer").select(F.col("c_mktsegment").alias("symbol"), "c_custkey", "c_acctbal")
    tables.write_buckets(c, path)
    tables.write_buckets(c.where("symbol like 'M%' and c_acctbal > 0"), path)
    return tables.read_buckets(spark, path, ["A", "B", "M"], {"symbol": "string", "c_custkey": "bigint", "c_acctbal": "double", "note": "string"})


BUCKETS = """
SELECT c_mktsegment AS symbol, c_custkey::BIGINT AS c_custkey, c_acctbal, NULL::VARCHAR AS note FROM customer WHERE substr(c_mktsegment, 1, 1) IN ('A', 'B') OR (c_mktsegment LIKE 'M%' AND c_acctbal > 0)"""


def target_quantities(spark: SparkSession, d: str) -> DataFrame:
    """Equity over the week's top five by return, capped, scaled for costs, in whole shares."""
    b = weekly_bars(spark, d).withColumn("r", F.round(F.col("close") / F.col("open") - 1, 9))
    top = b.withColumn("k", F.row_number().over(Window.partitionBy("date").orderBy(F.desc("r"), "symbol"))).where("k <= 5")
    w = Window.partitionBy("date")
    top = top.withColumn("notional", F.least(F.lit(100000.0) / F.count(F.lit(1)).over(w), F.lit(25000.0)))
    scale = F.least(F.lit(1.0), F.lit(99000.0) / F.sum("notional").over(w))
    return top.select("date", "symbol", (F.col("notional") * scale).alias("notional"), F.floor(F.col("notional") * scale / F.col("open")).cast("long").alias("shares"))


QUANTITIES = f"""
WITH {BW}, k AS (SELECT *, row_number() OVER (PARTITION BY date ORDER BY round(close / open - 1, 9) DESC, symbol) AS k FROM bars), t AS (SELECT *, least(100000.0::DOUBLE / count(*) OVER (PARTITION BY date), 25000.0::DOUBLE) AS n FROM k WHERE k <= 5),
s AS (SELECT *, least(1.0::DOUBLE, 99000.0::DOUBLE / sum(n) OVER (PARTITION BY date)) AS sc FROM t)
SELECT date, symbol, n * sc AS notional, floor(n * sc / open)::BIGINT AS shares FROM s"""


def intraday_status(spark: SparkSession, d: str) -> DataFrame:
    """Every user and one without events, their last event at a moment, whether it is fresh, and whether a refresh is due."""
    now = F.lit("2024-01-20 12:00:00").cast("timestamp")
    e = table(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    snap = e.where(F.col("ts") <= now + F.expr("interval 2 minutes")).groupBy("user_id").agg(F.max("ts").alias("last_at"), F.max_by("value", "ts").alias("value"))
    watch = e.select("user_id").distinct().unionByName(e.agg((F.max("user_id") + 1).alias("user_id")))
    age = F.unix_timestamp(now) - F.unix_timestamp("last_at")
    status = F.when(F.col("last_at").isNull(), "missing").when(age < -60, "future").when(age > 3600, "stale").otherwise("fresh")
    return watch.join(snap, "user_id", "left").withColumns({"status": status, "refresh_due": F.coalesce(age > 7200, F.lit(True))})


INTRADAY = """
WITH s AS (SELECT user_id, max(ts) AS last_at, arg_max(value, ts) AS value FROM events WHERE ts <= TIMESTAMP '2024-01-20 12:02:00' GROUP BY 1),
w AS (SELECT DISTINCT user_id FROM events UNION ALL SELECT max(user_id) + 1 FROM events),
j AS (SELECT w.user_id, last_at, value, floor(epoch(TIMESTAMP '2024-01-20 12:00:00')) - floor(epoch(last_at)) AS age FROM w LEFT JOIN s USING (user_id))
SELECT user_id, last_at, value, CASE WHEN last_at IS NULL THEN 'missing' WHEN age < -60 THEN 'future' WHEN age > 3600 THEN 'stale' ELSE 'fresh' END AS status, coalesce(age > 7200, true) AS refresh_due FROM j"""


def coverage(spark: SparkSession, d: str) -> DataFrame:
    """Q13, Q14, Q17: nations' weeks without any bar, late starts, and symbols behind the newest week."""
    b = weekly_bars(spark, d).select("symbol", "date")
    g = b.groupBy("symbol").agg(F.min("date").alias("first"), F.max("date").alias("last"), F.count(F.lit(1)).alias("n"))
    newest = b.agg(F.max("date").alias("newest"))
    weeks = (F.datediff("last", "first") / 7 + 1).cast("long")
    return g.crossJoin(F.broadcast(newest)).select("symbol", "n", (weeks - F.col("n")).alias("missing_weeks"), (F.col("first") > F.lit("1995-01-20").cast("date")).alias("backfill_needed"),
                                                   (F.datediff("newest", "last") > 7).alias("stale"))


COVERAGE = f"""
WITH {BW}, g AS (SELECT symbol, min(date) AS f, max(date) AS l, count(*) AS n FROM bars GROUP BY 1)
SELECT symbol, n, ((l - f) // 7 + 1 - n)::BIGINT AS missing_weeks, f > DATE '1995-01-20' AS backfill_needed, (SELECT max(date) FROM bars) - l > 7 AS stale FROM g"""


def calendar_text(spark: SparkSession, d: str) -> DataFrame:
    """S17 (calendar branch): orders written as calendar texts per customer and read back; entries without a summary are rejects."""
    o = table(spark, d, "orders")
    entry = F.concat(F.lit("BEGIN:VEVENT\nUID:"), "o_orderkey", F.lit("\nSUMMARY:"), F.when(F.col("o_orderkey") % 3 == 0, "").otherwise(F.col("o_orderpriority")),
                     F.lit("\nDTSTART;VALUE=DATE:"), F.date_format("o_orderdate", "yyyyMMdd"), F.lit("\nEND:VEVENT"))
    text = o.groupBy("o_custkey").agg(F.array_join(F.sort_array(F.collect_list(entry)), "\n").alias("text"))
    good, bad = payloads.split_rejects(payloads.calendar_entries(text, "text"), {"missing_summary": F.col("summary").isNull()}, F.col("uid"), F.col("starts"))
    g = good.select("o_custkey", F.col("uid").alias("identifier"), F.col("summary").alias("detail"), F.to_date("starts", "yyyyMMdd").alias("day"))
    return g.unionByName(bad.select(F.lit(None).cast("long").alias("o_custkey"), "identifier", F.col("reason").alias("detail"), F.to_date("preview", "yyyyMMdd").alias("day")))


CALENDAR_TEXT = """
SELECT CASE WHEN o_orderkey % 3 <> 0 THEN o_custkey END AS o_custkey, o_orderkey::VARCHAR AS identifier, CASE WHEN o_orderkey % 3 <> 0 THEN o_orderpriority ELSE 'missing_summary' END AS detail, o_orderdate::DATE AS day FROM orders"""


def listing_status(spark: SparkSession, d: str) -> DataFrame:
    """Supplier listings through CSV, kept if active stock without a dot, first per symbol."""
    s = table(spark, d, "supplier")
    line = F.concat_ws(",", F.concat(F.lit("S"), "s_nationkey", F.when(F.col("s_suppkey") % 9 == 0, ".B").otherwise("")), "s_name", F.when(F.col("s_suppkey") % 4 == 0, "ETF").otherwise("Stock"),
                       F.when(F.col("s_suppkey") % 5 == 0, "Delisted").otherwise("Active"), F.col("s_suppkey").cast("string"))
    rows = s.select(F.from_csv(line, F.lit("symbol string, name string, assetType string, status string, seq long")).alias("r")).select("r.*")
    rows = clean.snake_names(rows).where((F.upper("status") == "ACTIVE") & (F.upper("asset_type") == "STOCK") & ~F.col("symbol").contains("."))
    return clean.last_per_key(rows, ["symbol"], F.col("seq"))


LISTINGS = """
WITH r AS (SELECT 'S' || s_nationkey AS symbol, s_name AS name, 'Stock' AS asset_type, 'Active' AS status, s_suppkey AS seq FROM supplier WHERE s_suppkey % 4 <> 0 AND s_suppkey % 5 <> 0 AND s_suppkey % 9 <> 0)
SELECT symbol, name, asset_type, status, seq::BIGINT AS seq FROM (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY seq) AS k FROM r) WHERE k = 1"""


def silver_market(spark: SparkSession, d: str) -> DataFrame:
    """Raw region bars with aliases, texts for numbers and double days to the clean table."""
    b = daily_bars(spark, d)
    raw = b.select(F.concat(F.lit(" "), F.lower("symbol")).alias("Ticker"), F.col("date").cast("string").alias("Date"), *[F.col(c).cast("string").alias(c.capitalize()) for c in ("open", "high", "low", "close", "volume")])
    raw = raw.unionByName(raw.withColumn("Volume", F.lit("n/a")).where(F.substring("Date", 9, 2) == "01"))
    s = clean.first_of(raw, "symbol", ["symbol", "ticker"])
    s = clean.snake_names(s).withColumns({"symbol": F.upper(F.trim("symbol")), "date": F.to_date("date"), **{c: S.number(F.col(c)) for c in ("open", "high", "low", "close", "volume")}})
    s = s.where(F.col("date") >= F.lit("1996-01-01").cast("date"))
    return clean.project(clean.last_per_key(s, ["symbol", "date"], F.desc_nulls_last("volume")), {"symbol": "string", "date": "date", "open": "double", "high": "double", "low": "double", "close": "double", "volume": "double"})


SILVER = f"WITH {BD} SELECT upper(symbol) AS symbol, date, open, high, low, close, volume FROM bars WHERE date >= DATE '1996-01-01'"


def earnings_dedupe(spark: SparkSession, d: str) -> DataFrame:
    """Scheduled reports that an actual one of the same customer and quarter supersedes go; counts of what was replaced."""
    e = orders_as_earnings(spark, d, today="1998-01-01").withColumn("quarter", F.to_date(F.date_trunc("quarter", "date")))
    actual = clean.last_per_key(e.where("record_type = 'actual'"), ["symbol", "quarter"], F.desc("date"))
    planned = clean.last_per_key(e.where("record_type = 'scheduled'"), ["symbol", "quarter"], F.desc("date"))
    kept = planned.join(actual.select("symbol", "quarter"), ["symbol", "quarter"], "left_anti")
    return maintain.union_all(actual, kept).groupBy("record_type", "quarter").agg(F.count(F.lit(1)).alias("n"), F.max("date").alias("last_day"))


EARN_DEDUPE = f"""
WITH {EO.replace("2001-06-30", "1998-01-01")}, e AS (SELECT *, date_trunc('quarter', date)::DATE AS quarter FROM eo), l AS (SELECT symbol, quarter, record_type, max(date) AS date FROM e GROUP BY ALL)
SELECT record_type, quarter, count(*) AS n, max(date) AS last_day FROM l WHERE record_type = 'actual' OR (symbol, quarter) NOT IN (SELECT (symbol, quarter) FROM l WHERE record_type = 'actual') GROUP BY 1, 2"""


def register_all(register) -> None:
    for name, fn, sql in (
        ("sessions_and_rounding", sessions, SESSIONS), ("alias_dedupe", alias_dedupe, ALIASES), ("latest_row_rule", latest_rule, LATEST_RULE),
        ("revision_backfill", revision_backfill, BACKFILL), ("fingerprints", fingerprints, FINGERPRINTS), ("run_choice", run_choice, RUN_CHOICE), ("sweeps", sweeps, SWEEPS), ("bucket_round_trip", bucket_round_trip, BUCKETS),
        ("target_quantities", target_quantities, QUANTITIES), ("intraday_status", intraday_status, INTRADAY), ("coverage", coverage, COVERAGE), ("calendar_text", calendar_text, CALENDAR_TEXT),
        ("listing_status", listing_status, LISTINGS), ("silver_market", silver_market, SILVER), ("earnings_dedupe", earnings_dedupe, EARN_DEDUPE),
    ):
        register(name, fn, sql)
