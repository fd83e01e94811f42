"""Query ``op1_html_extraction``; SQL cannot express it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tapeloom.llm.html_mincut import extract_pages


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_pages(spark.read.parquet(f"{sf_dir}/pages.parquet"))
