"""Query ``op7_sharding`` and its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tapeloom.llm.sharding import LCG_MULTIPLIER, assign_shards

N_SHARDS = 24
BUCKETS = 256


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assign_shards(spark.read.parquet(f"{sf_dir}/documents.parquet"), N_SHARDS, slot_buckets=BUCKETS)


# crc32 is folded over the hex digits of the UTF-8 bytes; the table of byte
# remainders comes from the reflected polynomial.
OP7_SQL = f"""
WITH RECURSIVE bits AS (
  SELECT i, list_reduce(list_prepend(i::BIGINT, range(8)), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(3988292384, c // 2) ELSE c // 2 END) AS v
  FROM range(256) AS r(i)
), tab AS (SELECT list(v ORDER BY i) AS t FROM bits),
src AS (
  SELECT row_number() OVER () AS rid, doc_id, hex(encode(coalesce(text, ''))) AS h, t FROM documents, tab
), crcs AS (
  SELECT rid, doc_id, (length(h) // 2 + 8)::BIGINT AS size,
    xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(length(h) // 2), lambda i: ('0x' || substr(h, (2 * i + 1)::BIGINT, 2))::BIGINT)),
      lambda c, x: xor(c // 256, t[(xor(c % 256, x) + 1)::BIGINT])))::BIGINT AS text_crc32
  FROM src
), ids AS (
  SELECT DISTINCT doc_id, ((coalesce(doc_id, 0)::HUGEINT % 18446744073709551616) + 18446744073709551616) % 18446744073709551616 AS k0 FROM documents
), walk AS (
  SELECT doc_id, k0 AS k, 0::BIGINT AS j, 0 AS s0, 0 AS s1 FROM ids
  UNION ALL
  SELECT doc_id, k1, floor((j + 1)::DOUBLE * (2147483648.0::DOUBLE / ((k1 // 8589934592) + 1)::DOUBLE))::BIGINT,
    CASE WHEN j < {N_SHARDS} THEN j ELSE s0 END::INTEGER, CASE WHEN j < {N_SHARDS + 1} THEN j ELSE s1 END::INTEGER
  FROM (SELECT *, (k * {LCG_MULTIPLIER} + 1) % 18446744073709551616 AS k1 FROM walk WHERE j < {N_SHARDS + 1})
), ended AS (SELECT doc_id, s0 AS shard, s1 AS grown_shard FROM walk WHERE j >= {N_SHARDS + 1}
), keyed AS (
  SELECT c.doc_id, c.size, c.text_crc32, e.shard, e.grown_shard,
    ((((i.k0 * {LCG_MULTIPLIER} + 1) % 18446744073709551616) // 1048576) % {BUCKETS} + c.text_crc32) % {BUCKETS} AS bucket
  FROM crcs c JOIN ended e ON c.doc_id IS NOT DISTINCT FROM e.doc_id JOIN ids i ON c.doc_id IS NOT DISTINCT FROM i.doc_id
)
SELECT doc_id, size, text_crc32, 'key' AS law, shard::INTEGER AS shard,
  (row_number() OVER (PARTITION BY shard ORDER BY bucket, doc_id NULLS FIRST, text_crc32, size) - 1)::BIGINT AS slot,
  grown_shard::INTEGER AS grown_shard
FROM keyed
"""
