"""Query ``op2_embedding_neardup`` and its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tapeloom.llm.neardup_vectors import near_duplicates


def op2_embedding_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


OP2_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e,
    label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
      AND len(list_filter(embedding, lambda x: x <> 0)) > 0 AS ok
  FROM embeddings
), l AS (
  SELECT x.vec_id AS a, y.vec_id AS b FROM v x JOIN v y ON x.label = y.label AND len(x.e) = len(y.e) AND x.vec_id <> y.vec_id
  WHERE x.ok AND y.ok AND list_cosine_similarity(x.e, y.e) >= 0.98
), r AS (
  SELECT vec_id AS a, vec_id AS c FROM v UNION SELECT l.a, r.c FROM r JOIN l ON l.b = r.a
), c AS (SELECT a, min(c) AS component_id FROM r GROUP BY a
), n AS (SELECT a, count(*) AS n FROM l GROUP BY a)
SELECT v.vec_id, coalesce(n.n, 0)::BIGINT AS n_links, c.component_id, v.vec_id = c.component_id AS kept
FROM v JOIN c ON c.a = v.vec_id LEFT JOIN n ON n.a = v.vec_id
"""
