"""Queries of the stateful streams: each reads its sink alone and equals SQL over the whole history."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeloom.plans.sqltext import r6
from tapeloom.session import shared_folder, table
from tapeloom.streaming import jobs, monitor

DELAY_S, COOLDOWN_S, SILENCE_S = 3600, 21_600, 86_400


def as_snapshots(events: DataFrame) -> DataFrame:
    """Events as polls of a user's snapshot, whose own time lies a little before, or is missing, ahead or stale, by a number in ``props``."""
    k = F.get_json_object("props", "$.k").cast("int")
    shift = F.when(k % 20 == 0, None).when(k % 20 == 1, 120).when(k % 20 == 2, -1800).otherwise(-k)
    return events.select("event_id", F.col("user_id").alias("symbol"), F.col("ts").alias("observed_at"), F.timestamp_micros(F.unix_micros("ts") + shift * 1_000_000).alias("snapshot_at"), F.col("value").alias("price"))


def intraday_poll(spark: SparkSession, d: str) -> DataFrame:
    """The poll over the event stream, run twice to the end (the second finds nothing new), read back from its sink."""
    base = f"{shared_folder(spark)}/poll-{uuid.uuid4().hex}"
    schema = table(spark, d, "events").schema
    for _ in range(2):
        stream = as_snapshots(jobs.event_stream(spark, f"{d}/event[s].parquet", schema))
        monitor.run_through(spark, monitor.poll_statuses(stream, f"{DELAY_S} seconds", COOLDOWN_S, SILENCE_S), f"{base}/rows", f"{base}/state")
    return spark.read.schema(POLL_SCHEMA).parquet(f"{base}/rows")


POLL_SCHEMA = "symbol long, observed_at timestamp, event_id long, kind string, issue string, status string, queued boolean, price double, last_snapshot_at timestamp"

POLL = f"""
WITH RECURSIVE e AS (
  SELECT event_id, user_id AS symbol, ts AS observed_at, value AS price, (props::JSON ->> 'k')::INTEGER AS k FROM events
), m AS (SELECT max(epoch_ms(observed_at)) - {DELAY_S * 1000} AS mark FROM e),
p AS (
  SELECT event_id, symbol, observed_at, price,
    observed_at + to_seconds(CASE WHEN k % 20 = 0 THEN NULL WHEN k % 20 = 1 THEN 120 WHEN k % 20 = 2 THEN -1800 ELSE -k END) AS snapshot_at,
    CASE WHEN k % 20 = 0 THEN 'missing_or_unparseable_timestamp' WHEN k % 20 = 1 THEN 'future_timestamp' WHEN k % 20 = 2 THEN 'stale_timestamp' END AS issue
  FROM e, m WHERE epoch_ms(observed_at) <= mark
), g AS (
  SELECT symbol, observed_at + INTERVAL {SILENCE_S} SECOND AS silent_at, lead(observed_at) OVER (PARTITION BY symbol ORDER BY observed_at, event_id) AS nxt FROM p
), a AS (
  SELECT symbol, observed_at, event_id, issue, price, snapshot_at, CASE WHEN issue IS NULL THEN 'snapshot_observed' ELSE 'snapshot_timestamp_invalid' END AS kind FROM p
  UNION ALL SELECT symbol, silent_at, NULL, NULL, NULL, NULL, 'snapshot_missing' FROM g, m WHERE epoch_ms(silent_at) <= mark AND (nxt IS NULL OR nxt > silent_at)
), s AS (
  SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY observed_at, event_id) AS i,
    last_value(CASE WHEN kind = 'snapshot_observed' THEN snapshot_at END IGNORE NULLS) OVER (PARTITION BY symbol ORDER BY observed_at, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS last_snapshot_at
  FROM a
), j AS (
  SELECT x.symbol, x.i, min(y.i) AS n FROM s x JOIN s y ON x.symbol = y.symbol AND y.i > x.i AND y.observed_at >= x.observed_at + INTERVAL {COOLDOWN_S} SECOND GROUP BY 1, 2
), r AS (
  SELECT symbol, 1::BIGINT AS i FROM s WHERE i = 1 UNION ALL SELECT j.symbol, j.n FROM r JOIN j ON r.symbol = j.symbol AND r.i = j.i
)
SELECT s.symbol, s.observed_at, s.event_id, s.kind, s.issue,
  CASE WHEN s.kind <> 'snapshot_observed' THEN 'failed' WHEN r.i IS NOT NULL THEN 'refresh_queued' ELSE 'observed' END AS status,
  r.i IS NOT NULL AS queued, s.price, s.last_snapshot_at
FROM s LEFT JOIN r ON s.symbol = r.symbol AND s.i = r.i"""


def rolling_sums(spark: SparkSession, d: str) -> DataFrame:
    """Each nation's daily orders and their sums over 30 and 90 days as a stream, run twice to the end, read back from its sink."""
    base = f"{shared_folder(spark)}/rolling-{uuid.uuid4().hex}"
    schema = table(spark, d, "orders").schema
    nations = table(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), F.concat(F.lit("N"), "c_nationkey").alias("symbol"))
    for _ in range(2):
        orders = spark.readStream.schema(schema).parquet(f"{d}/order[s].parquet").join(nations, "o_custkey")
        rows = orders.select("symbol", F.col("o_orderdate").cast("timestamp").alias("at"), F.col("o_totalprice").alias("value"), F.lit(1.0).alias("orders"))
        monitor.run_through(spark, monitor.rolling_day_sums(rows, "at", ["value", "orders"]), f"{base}/rows", f"{base}/state")
    got = spark.read.schema(ROLLING_SCHEMA).parquet(f"{base}/rows")
    return got.select("symbol", "as_of_date", *[(F.round(c, 6) + 0.0).alias(c) for c in got.columns[2:]])


ROLLING_SCHEMA = "symbol string, as_of_date date, value double, orders double, value_30d double, orders_30d double, value_90d double, orders_90d double"

_SPAN = "OVER (PARTITION BY symbol ORDER BY as_of_date RANGE BETWEEN INTERVAL {n} DAY PRECEDING AND CURRENT ROW)"
ROLLING = f"""
WITH o AS (SELECT 'N' || c_nationkey AS symbol, o_orderdate::TIMESTAMP AS moment, o_totalprice AS value FROM orders JOIN customer ON o_custkey = c_custkey),
d AS (SELECT symbol, moment::DATE AS as_of_date, sum(value) AS value, count(*)::DOUBLE AS orders FROM o GROUP BY 1, 2),
s AS (SELECT symbol, as_of_date, value, orders, {', '.join(f"sum({c}) {_SPAN.format(n=n - 1)} AS {c}_{n}d" for n in (30, 90) for c in ('value', 'orders'))} FROM d)
SELECT symbol, as_of_date, {', '.join(f"{r6(c)} AS {c}" for c in ('value', 'orders', 'value_30d', 'orders_30d', 'value_90d', 'orders_90d'))}
FROM s WHERE as_of_date + INTERVAL 1 DAY <= (SELECT max(moment) FROM o) - INTERVAL 2 DAY"""


def register_all(register) -> None:
    register("intraday_poll_stream", intraday_poll, POLL)
    register("rolling_sums_stream", rolling_sums, ROLLING)
