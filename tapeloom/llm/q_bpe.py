"""Query ``op4_bpe``; SQL cannot express the merges."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tapeloom.llm.bpe import round_trip_digests


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip_digests(spark.read.parquet(f"{sf_dir}/documents.parquet"))
