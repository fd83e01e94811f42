"""Centroid clustering over dictionaries of subvectors, in whole numbers.

Vectors are turned into integers once and written in chunks. In each chunk every
block of dimensions has a dictionary of its distinct subvectors, and a vector is
a code per block; nothing is lost. A round computes each dictionary entry's exact
squared distance to every centroid once and adds up entries by code. Sums for
the new centroids come from counts of codes, again over dictionaries.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapeloom.llm.workspace import staged

#: Vectors whose scaled components lie beyond this are left out: their squared distances fit in no 64-bit number.
LARGEST = 1 << 26
#: Vectors in a chunk, each with its own dictionaries.
CHUNK = 8192

_CHUNKS = "ids array<long>, sizes array<int>, entries binary, codes binary"


def scaled(df: DataFrame, id_col: str, vector_col: str, dims: int, scale: int) -> DataFrame:
    """``id, vector array<int>``: floor(scale * x) of the usable vectors."""
    x = F.transform(F.col(vector_col), lambda v: v.cast("double"))
    whole = F.transform(x, lambda v: F.floor(v * F.lit(float(scale))))
    fine = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v * F.lit(float(scale))) < float(LARGEST)))
    kept = df.where(F.coalesce((F.size(vector_col) == dims) & fine, F.lit(False)))
    return kept.select(F.col(id_col).cast("long").alias("id"), F.transform(whole, lambda v: v.cast("int")).alias("vector"))


def first_centroids(vectors: DataFrame, k: int, seed: int) -> list[list[int]]:
    """The vectors of the ``k`` smallest hashes of ``seed:id``; equal hashes go by their components."""
    named = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
    return [list(r["vector"]) for r in vectors.select(named.alias("name"), "vector").orderBy("name", "vector").limit(k).collect()]


def encode_chunks(vectors: DataFrame, dims: int, block: int, chunk: int = CHUNK) -> DataFrame:
    """A row per chunk: ids, sizes of the dictionaries, their entries one behind the other, and codes block by block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[tuple[pa.Array, np.ndarray]] = []
        held = 0

        def out() -> pa.RecordBatch:
            ids = pa.concat_arrays([x for x, _ in waiting])
            matrix = np.concatenate([m for _, m in waiting])
            entries, codes, sizes = [], [], []
            for at in range(0, dims, block):
                part = np.ascontiguousarray(matrix[:, at : at + block])
                distinct, code = np.unique(part, axis=0, return_inverse=True)
                entries.append(distinct.astype("<i4").tobytes())
                codes.append(code.reshape(-1).astype("<u2" if chunk <= 1 << 16 else "<u4").tobytes())
                sizes.append(len(distinct))
            many = pa.array([0, len(ids)], pa.int32())
            return pa.RecordBatch.from_arrays(
                [pa.ListArray.from_arrays(many, ids), pa.array([sizes], pa.list_(pa.int32())), pa.array([b"".join(entries)], pa.binary()), pa.array([b"".join(codes)], pa.binary())],
                names=["ids", "sizes", "entries", "codes"],
            )

        for batch in batches:
            matrix = batch.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.int32).reshape(-1, dims)
            at = 0
            while at < batch.num_rows:
                n = min(batch.num_rows - at, chunk - held)
                waiting.append((batch.column(0).slice(at, n), matrix[at : at + n]))
                held, at = held + n, at + n
                if held == chunk:
                    yield out()
                    waiting, held = [], 0
        if held:
            yield out()

    return vectors.select("id", "vector").mapInArrow(run, _CHUNKS)


class Chunk:
    """One chunk's dictionaries and codes."""

    def __init__(self, sizes: list[int], entries: bytes, codes: bytes, n: int, dims: int, block: int, wide: bool):
        self.n, at = n, 0
        flat = np.frombuffer(entries, dtype="<i4").astype(np.int64)
        self.codes = np.frombuffer(codes, dtype="<u4" if wide else "<u2").reshape(-1, n)
        self.distinct: list[np.ndarray] = []
        for size, first in zip(sizes, range(0, dims, block), strict=True):
            width = min(block, dims - first)
            self.distinct.append(flat[at : at + size * width].reshape(size, width))
            at += size * width

    def assign(self, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each vector's nearest centroid (the smaller number of equal ones) and its squared distance."""
        total = np.zeros((self.n, len(centroids)), dtype=np.int64)
        at = 0
        for entries, code in zip(self.distinct, self.codes, strict=True):
            width = entries.shape[1]
            part = centroids[:, at : at + width]
            total += ((entries[:, None, :] - part[None, :, :]) ** 2).sum(axis=2)[code]
            at += width
        best = total.argmin(axis=1)
        return best, total[np.arange(self.n), best]

    def sums(self, cluster: np.ndarray, k: int) -> np.ndarray:
        """Componentwise sums of each cluster's vectors, from counts of codes."""
        out = []
        for entries, code in zip(self.distinct, self.codes, strict=True):
            many = np.bincount(cluster * len(entries) + code, minlength=k * len(entries)).reshape(k, len(entries))
            out.append(many @ entries)
        return np.concatenate(out, axis=1)


def _chunks(batches: Iterator[pa.RecordBatch], dims: int, block: int, wide: bool) -> Iterator[tuple[pa.Array, Chunk]]:
    for batch in batches:
        for i in range(batch.num_rows):
            ids, sizes, entries, codes = (c[i] for c in batch.columns)
            yield ids.values, Chunk(sizes.as_py(), entries.as_py(), codes.as_py(), len(ids.values), dims, block, wide)


def _moved(chunks: DataFrame, centroids: list[list[int]], dims: int, block: int, wide: bool) -> list[list[int]]:
    """Centroids after a round: floors of exact means; one without vectors stays. Every task sends k * (dims + 1) sums at most."""
    k, start = len(centroids), np.array(centroids, dtype=np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, many = np.zeros((k, dims), dtype=np.int64), np.zeros(k, dtype=np.int64)
        for _, chunk in _chunks(batches, dims, block, wide):
            cluster, _ = chunk.assign(start)
            sums += chunk.sums(cluster, k)
            many += np.bincount(cluster, minlength=k)
        rows = np.concatenate((many[:, None], sums), axis=1)
        where = np.indices(rows.shape)
        yield pa.RecordBatch.from_arrays([pa.array(where[0].reshape(-1)), pa.array(where[1].reshape(-1) - 1), pa.array(rows.reshape(-1))], names=["cluster", "dim", "total"])

    found = chunks.mapInArrow(run, "cluster long, dim long, total long").groupBy("cluster", "dim").agg(F.sum("total").alias("total")).collect()
    totals = {(r["cluster"], r["dim"]): r["total"] for r in found}
    return [
        [totals[c, d] // totals[c, -1] for d in range(dims)] if totals.get((c, -1), 0) else centroids[c]
        for c in range(k)
    ]


def cluster_vectors(
    df: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    k: int = 8,
    rounds: int = 10,
    dims: int = 64,
    block: int = 2,
    scale: int = 1024,
    seed: int = 3,
    chunk: int = CHUNK,
) -> DataFrame:
    """``id_col, cluster, distance, cluster_inertia, inertia, centroid_sha256, centroid`` of every usable vector.

    Usable are vectors of exactly ``dims`` components, none null or non-finite;
    others give no row, nor do those whose scaled components reach LARGEST (no
    64-bit distance could tell them). Components become floor(scale * x).
    Centroids start as the ``k`` vectors of smallest sha256 of ``seed:id``; each
    round assigns all vectors to the nearest centroid, ties to the smaller
    number, and moves every centroid to the componentwise floor of its vectors'
    exact mean; one without vectors stays. Then all are assigned once more.

    Chunks are written once to the shared folder; rounds read them where they
    lie, without an exchange, and send k * (dims + 1) sums a task, so copies of
    a vector, however many, cost nothing but their codes. Fewer than ``k``
    vectors make fewer clusters; null ids are hashed as an empty string;
    repeated ids are rows of their own; no usable vectors give no rows. Other
    columns are not read.
    """
    wide = chunk > 1 << 16
    vectors = scaled(df, id_col, vector_col, dims, scale)
    chunks = staged(encode_chunks(vectors, dims, block, chunk), "vector-chunks")
    centroids = first_centroids(vectors, k, seed)
    key = df.schema[id_col].dataType
    if not centroids:
        none = vectors.where(F.lit(False)).select(F.col("id").cast(key).alias(id_col))
        return none.select(id_col, *[F.lit(None).cast(t).alias(c) for c, t in (("cluster", "int"), ("distance", "long"), ("cluster_inertia", "long"), ("inertia", "long"), ("centroid_sha256", "string"), ("centroid", "array<int>"))])
    for _ in range(rounds):
        moved = _moved(chunks, centroids, dims, block, wide)
        if moved == centroids:
            break  # further rounds would change nothing
        centroids = moved
    last = np.array(centroids, dtype=np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, one in _chunks(batches, dims, block, wide):
            cluster, distance = one.assign(last)
            yield pa.RecordBatch.from_arrays([ids, pa.array(cluster, pa.int32()), pa.array(distance, pa.int64())], names=["id", "cluster", "distance"])

    rows = staged(chunks.mapInArrow(run, "id long, cluster int, distance long"), "vector-clusters")
    inertia = {r["cluster"]: r["total"] for r in rows.groupBy("cluster").agg(F.sum("distance").alias("total")).collect()}  # k rows at most
    facts = [
        (c, inertia[c], sum(inertia.values()), hashlib.sha256(",".join(map(str, centroids[c])).encode()).hexdigest(), centroids[c])
        for c in sorted(inertia)
    ]
    told = df.sparkSession.createDataFrame(facts, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string, centroid array<int>")
    return rows.join(F.broadcast(told), "cluster").select(
        F.col("id").cast(key).alias(id_col), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256", "centroid"
    )
