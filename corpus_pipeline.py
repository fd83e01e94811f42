"""From raw documents to packed training sequences, a stage at a time.

A stage is called with the session, what its predecessor kept, and the folder of
the input tables (for labels to fit on); its result is written as Parquet and
read again by the next one. All stages but the last return the columns of the
documents they got.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tapeloom.llm import q_quality, q_toxicity
from tapeloom.llm.jaccard_join import keep_one_of_each
from tapeloom.llm.packing import pack_documents
from tapeloom.llm.quality import drop_low_quality
from tapeloom.llm.toxicity import drop_toxic
from tapeloom.llm.workspace import staged


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that the toxicity models reject."""
    return drop_toxic(docs, q_toxicity.fitted(spark, sf_dir))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that fail the base rules or the boosted trees."""
    return drop_low_quality(docs, q_quality.fitted(spark, sf_dir))


def ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the smallest id of every group of near copies."""
    return keep_one_of_each(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack what is left into sequences of 1024 tokens."""
    return pack_documents(docs)


STAGES = [
    ("toxicity", toxicity),
    ("quality_rules", quality_rules),
    ("ngram_jaccard", ngram_jaccard),
    ("packing", packing),
]

#: SQL can express neither the models nor the merges.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents in ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
