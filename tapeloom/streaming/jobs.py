"""Incremental jobs on the events table as Structured Streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def event_stream(spark: SparkSession, path: str, schema) -> DataFrame:
    """Events as files arrive; the checkpoint remembers which were read."""
    raw = spark.readStream.schema(schema).parquet(path)
    return raw.withColumn("ts", F.col("ts").cast("timestamp"))


def distinct_events(events: DataFrame, late: str = "1 hour") -> DataFrame:
    """Each event once, by the hash of its content, within the watermark."""
    return events.withColumn("source_hash", F.sha2(F.to_json(F.struct("user_id", "event_type", "value", "props")), 256)).withWatermark(
        "ts", late).dropDuplicatesWithinWatermark(["event_id", "source_hash"])


_TOTALS = "start timestamp, event_type string, n long, total double"


def keep_totals(events: DataFrame, sink: str, checkpoint: str) -> None:
    """Process what is there into five-minute totals and stop; a run again goes on behind the last one.

    Every batch sums its own new events, each once by the hash of its content,
    and writes these parts below its number, so a batch that is repeated after a
    failure replaces itself. Late events count in their window: a total is the
    sum of the parts of all batches, which :func:`kept_totals` reads. Rows that
    come again in a later batch are told apart by the watermark's state.
    """

    def put(batch: DataFrame, number: int) -> None:
        parts = batch.groupBy(F.window("ts", "5 minutes").alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))
        parts.select(F.col("w.start").alias("start"), "event_type", "n", "total").write.mode("overwrite").parquet(f"{sink}/batch={number}")

    once = distinct_events(events, "40 days")
    q = once.writeStream.foreachBatch(put).outputMode("append").option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()


def kept_totals(spark: SparkSession, sink: str) -> DataFrame:
    """``start, event_type, n, total`` of every window that :func:`keep_totals` has seen events of."""
    parts = spark.read.schema(_TOTALS).parquet(sink)
    return parts.groupBy("start", "event_type").agg(F.sum("n").alias("n"), F.round(F.sum("total"), 6).alias("total"))
