"""Query ``op11_token_planes``; SQL cannot express the merges."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tapeloom.llm.token_planes import read_ids, write_ids
from tapeloom.llm.workspace import scratch_path


def op11_token_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-planes")
    write_ids(spark.read.parquet(f"{sf_dir}/documents.parquet"), path)
    return read_ids(spark, path, with_ids=False)
