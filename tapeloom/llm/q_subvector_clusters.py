"""Query ``op13_subvector_clusters`` and its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tapeloom.llm.subvector_clusters import cluster_vectors

CLUSTERS, ROUNDS, DIMS, SCALE, SEED = 8, 10, 64, 1024, 3


def op13_subvector_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = cluster_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), k=CLUSTERS, rounds=ROUNDS, dims=DIMS, scale=SCALE, seed=SEED)
    return found.drop("centroid")


def _assigned(i: int) -> str:
    return f"""a{i} AS MATERIALIZED (
  SELECT rid, vec_id, e, c, distance FROM (
    SELECT v.rid, v.vec_id, v.e, c{i}.c, list_sum(list_transform(list_zip(v.e, c{i}.m), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT AS distance FROM v, c{i}
  ) QUALIFY row_number() OVER (PARTITION BY rid ORDER BY distance, c) = 1
)"""


def _moved(i: int) -> str:
    """Centroids after round ``i``: floors of exact means, negative ones too."""
    return f"""s{i} AS (
  SELECT c, j, sum(x)::BIGINT AS s, count(*) AS n FROM (SELECT c, unnest(e) AS x, unnest(range({DIMS})) AS j FROM a{i}) GROUP BY c, j
), c{i + 1} AS MATERIALIZED (
  SELECT c{i}.c, coalesce(any_value(n.m), any_value(c{i}.m)) AS m FROM c{i} LEFT JOIN (
    SELECT c, list((s - ((s % n) + n) % n) // n ORDER BY j) AS m FROM s{i} GROUP BY c
  ) n ON n.c = c{i}.c GROUP BY c{i}.c
)"""


OP13_SQL = f"""
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS e FROM embeddings
  WHERE len(embedding) = {DIMS} AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
), c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('{SEED}:' || coalesce(vec_id::VARCHAR, '')), e) - 1 AS c, e AS m FROM v
  QUALIFY row_number() OVER (ORDER BY sha256('{SEED}:' || coalesce(vec_id::VARCHAR, '')), e) <= {CLUSTERS}
), {", ".join(f"{_assigned(i)}, {_moved(i)}" for i in range(ROUNDS))}, {_assigned(ROUNDS)}
SELECT vec_id, a.c::INTEGER AS cluster, distance, sum(distance) OVER (PARTITION BY a.c)::BIGINT AS cluster_inertia, sum(distance) OVER ()::BIGINT AS inertia,
  sha256(array_to_string(m, ',')) AS centroid_sha256
FROM a{ROUNDS} a JOIN c{ROUNDS} c ON c.c = a.c
"""
