"""Query ``op6_quality``; SQL cannot express the trees."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tapeloom.llm.quality import Trees, fit, judge_documents


def fitted(spark: SparkSession, sf_dir: str) -> Trees:
    """Trees grown on documents labelled in ``sf_dir``."""
    return fit(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = judge_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"), fitted(spark, sf_dir))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "score"
    )
