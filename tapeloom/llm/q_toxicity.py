"""Query ``op5_toxicity``; SQL cannot express it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeloom.llm.toxicity import fit, fold, score_documents, training_rows


def fitted(spark: SparkSession, sf_dir: str) -> dict:
    """The model of the documents labelled in ``sf_dir``, without fold 0."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return fit(training_rows(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    scored = score_documents(docs, fitted(spark, sf_dir))
    return scored.select("doc_id", (fold("doc_id") == 0).alias("held_out"), "score", "predicted")
