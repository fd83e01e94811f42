"""Query ``op9_warc`` and its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeloom.llm.warc import mark_revisits, page_number, read_archives, write_archives
from tapeloom.llm.workspace import scratch_path


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    write_archives(mark_revisits(spark.read.parquet(f"{sf_dir}/pages.parquet")), path)
    return read_archives(spark, path, with_payload=False).select(
        page_number(F.col("record_id")).alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        page_number(F.col("refers_to")).alias("refers_to"),
    )


OP9_SQL = """
WITH p AS (
  SELECT page_id, encode(coalesce(html, '')) AS b FROM pages
), d AS (
  SELECT page_id, octet_length(b) AS n, sha1(b) AS h FROM p
), k AS (
  SELECT *, CASE WHEN n >= 1000 THEN max(page_id) OVER (PARTITION BY h, n) ELSE page_id END AS keeper FROM d
)
SELECT page_id, n::BIGINT AS payload_bytes, h AS payload_digest,
  CASE WHEN page_id IS NOT DISTINCT FROM keeper THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id IS DISTINCT FROM keeper THEN keeper END AS refers_to
FROM k
"""
