"""Release calendars made of the input tables and read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeloom.plans.catalyst_plans import FETCHED, _listed
from tapeloom.session import table
from tapeloom.sources import calendars


def release_calendar(spark: SparkSession, d: str) -> DataFrame:
    """Each customer's orders as release dates in JSON, some without a name or a day; events and rejects."""
    o, k = table(spark, d, "orders"), F.col("o_orderkey")
    item = F.to_json(F.struct(k.cast("string").alias("release_id"), F.when(k % 5 == 0, " ").otherwise(F.concat(F.lit(" Release  "), "o_orderpriority")).alias("release_name"), F.when(k % 7 == 0, "soon").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("date")))
    texts = _listed(o, ["o_custkey"], ["o_orderkey", "o_totalprice"], F.concat(F.lit(","), item)).select("o_custkey", F.concat(F.lit('{"release_dates":['), F.expr("substring(text, 2)"), F.lit("]}")).alias("payload"))
    good, bad = calendars.release_dates(texts, "payload", ["o_custkey"], F.lit(FETCHED).cast("timestamp"))
    return good.withColumn("reason", F.lit(None).cast("string")).unionByName(bad.withColumnRenamed("raw_identifier", "source_event_key"), allowMissingColumns=True)


RELEASES = f"""
WITH o AS (SELECT o_custkey, o_orderkey AS k, CASE WHEN o_orderkey % 5 <> 0 THEN 'Release ' || o_orderpriority END AS n, CASE WHEN o_orderkey % 7 <> 0 THEN o_orderdate::DATE END AS day FROM orders)
SELECT o_custkey, k || ':' || coalesce(day::VARCHAR, 'soon') AS source_event_key, CASE WHEN day IS NOT NULL AND n IS NOT NULL THEN n END AS event_name, CASE WHEN n IS NOT NULL THEN day::TIMESTAMP END AS effective_at, CASE WHEN n IS NOT NULL THEN day::TIMESTAMP END AS published_at,
  CASE WHEN day IS NOT NULL AND n IS NOT NULL THEN 'date_only' END AS time_precision, CASE WHEN day IS NULL OR n IS NULL THEN NULL WHEN day >= TIMESTAMP '{FETCHED}'::DATE THEN 'scheduled' ELSE 'released' END AS schedule_status,
  CASE WHEN day IS NULL OR n IS NULL THEN 'missing_release_name_or_date' END AS reason FROM o"""

_SOURCES = tuple(s.source for s in calendars.SCHEDULES)


def policy_calendars(spark: SparkSession, d: str) -> DataFrame:
    """Each customer's orders as a page of one of five calendars, some pages without a date; events and rejects."""
    o = table(spark, d, "orders").select("o_custkey", "o_orderkey", F.col("o_orderdate").cast("timestamp").alias("t"))
    u, t = F.col("o_custkey") % 5, F.col("t")
    nxt = F.date_add("t", 1)
    hour = F.concat((F.col("o_orderkey") % 5 + 8).cast("string"), F.lit(":05 "), F.when(F.col("o_orderkey") % 2 == 0, "AM").otherwise("PM"))
    row = (
        F.when(u == 0, F.concat(F.date_format("t", "MMMM d"), F.lit("</td><td>"), hour, F.lit("</td><td>News</td><td>Income  of "), F.col("o_orderkey").cast("string")))
        .when(u == 1, F.concat(F.lit("<h4>For "), F.date_format(nxt, "yyyy"), F.lit(":</h4>"), F.date_format("t", "EEEE"), F.lit(", "), F.date_format("t", "MMMM d"), F.lit(", and "), F.date_format(nxt, "EEEE"), F.lit(", "), F.date_format(nxt, "MMMM d")))
        .when(u == 2, F.concat(F.date_format("t", "dd/MM/yyyy"), F.lit(" Governing Council of the ECB: monetary policy meeting in Frankfurt (Day 2), followed by press conference")))
        .when(u == 3, F.concat(F.date_format("t", "EEEE"), F.lit(" "), F.date_format("t", "d MMMM yyyy")))
        .otherwise(F.concat(F.date_format("t", "MMM"), F.lit(". "), F.dayofmonth("t").cast("string"), F.lit(" (Mon), "), F.dayofmonth("t").cast("string"), F.lit(" (Tue)"))))
    texts = _listed(o, ["o_custkey"], ["o_orderkey", "t"], F.concat(F.lit("<tr><td>"), row, F.lit("</td></tr>\n")))
    source = F.element_at(F.array(*map(F.lit, _SOURCES)), (F.col("o_custkey") % 5 + 1).cast("int"))
    pages = texts.select("o_custkey", source.alias("source"), F.when(F.col("o_custkey") % 9 == 0, "<p>Nothing this year</p>").otherwise(F.concat(F.lit("<html><table>"), "text", F.lit("</table></html>"))).alias("payload"))
    good, bad = calendars.schedule_pages(pages, "source", "payload", ["o_custkey"], F.lit(FETCHED).cast("timestamp"))
    return good.withColumn("reason", F.lit(None).cast("string")).unionByName(bad, allowMissingColumns=True)


_UTC = "(({x}) AT TIME ZONE '{z}') AT TIME ZONE 'UTC'"
_THIS = "make_timestamp(1997, month(t), day(t), {h}, {m}, 0)"
POLICY = f"""
WITH o AS (SELECT o_custkey AS c, o_orderkey AS k, o_orderdate AS t, o_custkey % 5 AS u FROM orders WHERE o_custkey % 9 <> 0 AND NOT (o_custkey % 5 IN (0, 4) AND month(o_orderdate) = 2 AND day(o_orderdate) = 29)),
e AS (
  SELECT c, 'bea_release_schedule' AS s, 'Income of ' || k || ':' || strftime(t, '%B %-d') || ' ' || (k % 5 + 8) || ':05 ' || CASE WHEN k % 2 = 0 THEN 'AM' ELSE 'PM' END AS key, 'Income of ' || k AS n,
    {_UTC.format(x=_THIS.format(h="((k % 5 + 8) % 12 + CASE WHEN k % 2 = 0 THEN 0 ELSE 12 END)", m=5), z='America/New_York')} AS at_utc, 'exact' AS p FROM o WHERE u = 0
  UNION ALL SELECT c, 'fomc_schedule', 'fomc:' || year(t + INTERVAL 1 DAY) || ':' || strftime(t, '%B %-d') || ':' || strftime(t + INTERVAL 1 DAY, '%B %-d'), 'FOMC rate decision', {_UTC.format(x="date_trunc('day', t) + INTERVAL 38 HOUR", z='America/New_York')}, 'exact' FROM o WHERE u = 1
  UNION ALL SELECT c, 'ecb_policy_calendar', 'ecb:' || strftime(t, '%d/%m/%Y'), 'ECB monetary policy decision', {_UTC.format(x="date_trunc('day', t) + INTERVAL 855 MINUTE", z='Europe/Paris')}, 'exact' FROM o WHERE u = 2
  UNION ALL SELECT c, 'boe_mpc_calendar', 'boe:' || strftime(t, '%-d %B %Y'), 'BoE MPC rate decision', {_UTC.format(x="date_trunc('day', t) + INTERVAL 12 HOUR", z='Europe/London')}, 'exact' FROM o WHERE u = 3
  UNION ALL SELECT c, 'boj_release_schedule', 'boj:' || strftime(t, '%b') || '. ' || day(t) || ':' || day(t), 'BoJ monetary policy decision', {_UTC.format(x=_THIS.format(h=14, m=0), z='Asia/Tokyo')}, 'approximate' FROM o WHERE u = 4
), g AS (SELECT DISTINCT c, s, key, n, at_utc, p FROM e)
SELECT c AS o_custkey, s AS source_name, key AS source_event_key, n AS event_name, at_utc AS effective_at, at_utc AS published_at, p AS time_precision, CASE WHEN at_utc >= TIMESTAMP '{FETCHED}' THEN 'scheduled' ELSE 'released' END AS schedule_status, NULL::VARCHAR AS reason FROM g
UNION ALL SELECT x.c, ({list(_SOURCES)!r})[x.c % 5 + 1], NULL, NULL, NULL, NULL, NULL, NULL, ({[s.reason for s in calendars.SCHEDULES]!r})[x.c % 5 + 1] FROM (SELECT DISTINCT o_custkey AS c FROM orders) x WHERE x.c NOT IN (SELECT c FROM g)"""


def vendor_calendars(spark: SparkSession, d: str) -> DataFrame:
    """Each customer's orders as a vendor's table with a mapping of its columns, of which there are three; events and rejects."""
    o, k, u = table(spark, d, "orders"), F.col("o_orderkey"), F.col("o_custkey") % 3
    day, iso = F.date_format("o_orderdate", "yyyy-MM-dd"), F.date_format(F.col("o_orderdate").cast("timestamp") + F.expr("interval 90 minutes"), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    row = F.to_json(F.create_map(
        F.lit("id"), F.when(k % 2 == 0, k.cast("string")).otherwise(""), F.lit("Title"), F.when(k % 5 == 0, " ").otherwise(F.concat(F.lit("Event "), k.cast("string"))), F.lit("when"), F.when(k % 7 == 0, "never").otherwise(F.when(u == 0, iso).otherwise(day)),
        F.lit("w"), F.element_at(F.array(*map(F.lit, ("3", "Moderate", "HIGH", "x", ""))), (k % 5 + 1).cast("int")), F.lit("act"), F.when(k % 3 == 0, "n/a").otherwise(F.col("o_totalprice").cast("string")), F.lit("land"), F.when(k % 4 == 0, "").otherwise("GB")))
    m = F.col("o_custkey") % 3
    mapping = F.when(m == 0, '{"title_column":"Title","effective_at_column":"when","importance_column":"w","actual_column":"act","static_values":{"event_name":"Unnamed","country":"US"}}').when(
        m == 1, '{"title_column":"Title","date_column":"when","importance_column":"w","country_column":"land","static_values":{"country":"US"}}').otherwise('{"date_column":"when","static_values":{"event_name":"Fixed","importance":"important"}}')
    lists = _listed(o, ["o_custkey"], ["o_orderkey", "o_totalprice"], F.concat(F.lit(","), row))
    texts = lists.select("o_custkey", F.concat(F.lit('{"mapping":'), mapping, F.lit(',"rows":['), F.expr("substring(text, 2)"), F.lit("]}")).alias("payload"))
    good, bad = calendars.vendor_tables(texts, "payload", ["o_custkey"])
    good = good.withColumn("source_event_key", F.when(F.length("source_event_key") == 64, "hash").otherwise(F.col("source_event_key")))
    bad = bad.select("o_custkey", F.when(F.length("raw_identifier") == 64, "hash").otherwise(F.col("raw_identifier")).alias("source_event_key"), "reason")
    return good.withColumn("reason", F.lit(None).cast("string")).unionByName(bad, allowMissingColumns=True)


VENDORS = """
WITH o AS (SELECT o_custkey, o_orderkey AS k, o_custkey % 3 AS u, o_totalprice AS p, o_orderdate::TIMESTAMP AS t FROM orders),
e AS (
  SELECT o_custkey, u, k, CASE WHEN k % 2 = 0 THEN k::VARCHAR WHEN u < 2 AND k % 5 <> 0 THEN 'Event ' || k ELSE 'hash' END AS key, CASE WHEN u = 2 THEN 'Fixed' WHEN k % 5 <> 0 THEN 'Event ' || k WHEN u = 0 THEN 'Unnamed' END AS n,
    CASE WHEN k % 7 = 0 THEN NULL WHEN u = 0 THEN t + INTERVAL 90 MINUTE ELSE date_trunc('day', t) END AS w, CASE WHEN u = 0 AND k % 3 <> 0 THEN p END AS a, CASE WHEN u = 0 THEN CASE WHEN k % 3 = 0 THEN 'n/a' ELSE p::VARCHAR END END AS at_text,
    CASE WHEN u = 0 THEN 'US' WHEN u = 1 THEN CASE WHEN k % 4 = 0 THEN 'US' ELSE 'GB' END END AS land, CASE WHEN u = 2 THEN 'high' ELSE ['high', 'medium', 'high', 'low', 'low'][k % 5 + 1] END AS tier FROM o
)
SELECT o_custkey, key AS source_event_key, n AS event_name, w AS effective_at, CASE WHEN u = 0 THEN 'exact' ELSE 'date_only' END AS time_precision, 'scheduled' AS schedule_status, w AS published_at, land AS country, tier AS importance_tier,
  a AS actual_numeric, at_text AS actual_text, NULL::DOUBLE AS consensus_numeric, NULL::VARCHAR AS consensus_text, NULL::DOUBLE AS previous_numeric, NULL::VARCHAR AS previous_text, NULL::VARCHAR AS reason FROM e WHERE n IS NOT NULL AND w IS NOT NULL
UNION ALL SELECT o_custkey, key, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, 'missing_title_or_effective_at' FROM e WHERE n IS NULL OR w IS NULL"""


def register_all(register) -> None:
    register("release_calendar", release_calendar, RELEASES)
    register("policy_calendars", policy_calendars, POLICY)
    register("vendor_calendars", vendor_calendars, VENDORS)
