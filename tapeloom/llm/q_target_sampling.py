"""Query ``op12_target_sampling`` and its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tapeloom.llm.target_sampling import BUCKETS, resample

PERCENT, LEAST_WORDS, SEED = 5, 20, 42


def op12_target_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, target = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    return resample(docs, target, PERCENT, LEAST_WORDS, SEED).select("doc_id", "n_features", "weight", "score", "rank")


_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

# crc32 of every distinct feature is folded over the hex digits of its UTF-8 bytes
OP12_SQL = f"""
WITH bits AS (
  SELECT i, list_reduce(list_prepend(i::BIGINT, range(8)), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(3988292384, c // 2) ELSE c // 2 END) AS v
  FROM range(256) AS r(i)
), tab AS (SELECT list(v ORDER BY i) AS t FROM bits),
w AS MATERIALIZED (
  SELECT 0 AS side, row_number() OVER () AS rid, doc_id, {_WORDS} AS ws FROM documents
  UNION ALL SELECT 1, row_number() OVER (), NULL, {_WORDS} FROM benchmark
), f AS MATERIALIZED (
  SELECT side, rid, unnest(list_concat(ws, list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1]),
    list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2]))) AS g
  FROM w
), k AS MATERIALIZED (
  SELECT g, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(length(h) // 2), lambda i: ('0x' || substr(h, (2 * i + 1)::BIGINT, 2))::BIGINT)),
    lambda c, x: xor(c // 256, t[(xor(c % 256, x) + 1)::BIGINT])))::BIGINT % {BUCKETS} AS bucket
  FROM (SELECT g, hex(encode(g)) AS h FROM (SELECT DISTINCT g FROM f)), tab
), c AS MATERIALIZED (
  SELECT bucket, count(*) FILTER (side = 0) AS s, count(*) FILTER (side = 1) AS t FROM f JOIN k USING (g) GROUP BY bucket
), z AS (
  SELECT bucket, floor(1000 * ln(((t + 1)::DOUBLE * (all_s + {BUCKETS})::DOUBLE) / ((s + 1)::DOUBLE * (all_t + {BUCKETS})::DOUBLE)))::BIGINT AS gain
  FROM c, (SELECT sum(s) AS all_s, sum(t) AS all_t FROM c)
), d AS (
  SELECT rid, count(*) AS n_features, sum(gain)::BIGINT AS weight FROM f JOIN k USING (g) JOIN z USING (bucket) WHERE side = 0 GROUP BY rid
), e AS (
  SELECT w.doc_id, len(ws) >= {LEAST_WORDS} AS able, coalesce(n_features, 0)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
    coalesce(weight, 0)::BIGINT + floor(-1000.0::DOUBLE * ln(-ln((('0x' || substr(sha256('{SEED}:' || coalesce(w.doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296.0::DOUBLE)))::BIGINT AS score
  FROM w LEFT JOIN d USING (rid) WHERE side = 0
), o AS (
  SELECT *, row_number() OVER (PARTITION BY able ORDER BY score DESC, doc_id NULLS FIRST) AS r, count(*) FILTER (able) OVER () AS n FROM e
)
SELECT doc_id, n_features, weight, score, CASE WHEN able AND r <= {PERCENT} * n // 100 THEN r END::BIGINT AS rank FROM o
"""
