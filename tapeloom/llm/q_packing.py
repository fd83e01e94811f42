"""Query ``op8_packing``; SQL cannot express it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tapeloom.llm.packing import pack_documents


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))
