"""Query ``op3_ngram_jaccard`` and its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tapeloom.llm.jaccard_join import link_documents


def op3_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP3_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents
), s AS (
  SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
    ELSE list_distinct(list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))) END AS sh FROM w
), e AS (SELECT doc_id, unnest(sh) AS h FROM s
), i AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n FROM e x JOIN e y ON x.h = y.h AND x.doc_id < y.doc_id GROUP BY ALL
), p AS (
  SELECT a, b FROM i JOIN s sa ON sa.doc_id = a JOIN s sb ON sb.doc_id = b WHERE 100 * n >= 75 * (len(sa.sh) + len(sb.sh) - n)
), l AS (SELECT a, b FROM p UNION ALL SELECT b, a FROM p
), r AS (SELECT doc_id AS a, doc_id AS c FROM s UNION SELECT l.a, r.c FROM r JOIN l ON l.b = r.a)
SELECT s.doc_id, len(any_value(s.sh))::BIGINT AS n_shingles, min(r.c) AS component_id FROM s JOIN r ON r.a = s.doc_id GROUP BY s.doc_id
"""
