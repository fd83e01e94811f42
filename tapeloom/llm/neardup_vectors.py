"""Near-duplicate vectors by p-stable hashing with exact cosine checks."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapeloom.llm.components import connected_components
from tapeloom.llm.workspace import staged

#: Width of a quantised projection of normalised vectors.
WIDTH = 1.2
#: Chance that a pair just at the threshold meets in no table.
MISS = 5e-6
SEED = 20240607


def _meet(distance: float, width: float) -> float:
    """Chance that two vectors at a distance fall into one cell of one projection."""
    r = width / distance
    tail = 0.5 * math.erfc(r / math.sqrt(2))
    return 1 - 2 * tail - 2 / (math.sqrt(2 * math.pi) * r) * (1 - math.exp(-r * r / 2))


def plan_tables(n: int, threshold: float, width: float = WIDTH, miss: float = MISS) -> tuple[int, int]:
    """Projections per key and number of tables for groups of up to ``n`` vectors.

    Keys are long enough that a vector meets about one unrelated vector a table;
    then there are enough tables that a pair at the threshold is missed with
    chance ``miss`` at most.
    """
    near = _meet(math.sqrt(max(2 - 2 * threshold, 1e-12)), width)
    far = _meet(math.sqrt(2), width)
    k = max(4, math.ceil(math.log(max(n, 2)) / -math.log(far)))
    return k, max(1, math.ceil(math.log(miss) / math.log(1 - near**k)))


def _usable(vector: Column) -> Column:
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vector.isNotNull() & (F.size(vector) > 0) & fine & F.exists(vector, lambda x: x != 0), F.lit(False))


def table_keys(classes: DataFrame, k: int, tables: int, width: float = WIDTH) -> DataFrame:
    """``label, dims, id, t, key`` for every table ``t``: quantised projections of the normalised vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            ids, dims = batch.column(1), batch.column(2).to_numpy()
            for d in np.unique(dims).tolist():
                if d not in made:
                    rng = np.random.default_rng([SEED, d])
                    made[d] = rng.standard_normal((d, tables * k)), rng.uniform(0, width, tables * k)
                a, b = made[d]
                pick = np.flatnonzero(dims == d)
                part = batch.take(pa.array(pick))
                x = part.column(3).flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(pick), d)
                x = x / np.abs(x).max(axis=1, keepdims=True)
                x = x / np.linalg.norm(x, axis=1, keepdims=True)
                cells = np.floor((x @ a + b) / width).astype(np.int64).reshape(len(pick), tables, k)
                key = np.zeros((len(pick), tables), dtype=np.uint64)
                for i in range(k):
                    key = (key ^ cells[:, :, i].view(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
                    key ^= key >> np.uint64(29)
                flat = lambda c: pa.array(np.repeat(c.to_numpy(zero_copy_only=False), tables))
                yield pa.RecordBatch.from_arrays(
                    [flat(part.column(0)), flat(part.column(2)), flat(part.column(1)),
                     pa.array(np.tile(np.arange(tables, dtype=np.int32), len(pick))), pa.array(key.view(np.int64).reshape(-1))],
                    names=["label", "dims", "id", "t", "key"],
                )

    return classes.select("label", "id", "dims", "vector").mapInArrow(run, "label long, dims int, id long, t int, key long")


def cosine_links(pairs: DataFrame, classes: DataFrame, threshold: float) -> DataFrame:
    """The pairs ``a, b`` whose cosine in double precision reaches the threshold."""
    left = classes.select(F.col("id").alias("a"), F.col("vector").alias("va"))
    right = classes.select(F.col("id").alias("b"), F.col("vector").alias("vb"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = np.diff(batch.column(2).offsets.to_numpy())
            good = np.zeros(batch.num_rows, dtype=bool)
            for d in np.unique(size).tolist():
                pick = np.flatnonzero(size == d)
                part = batch.take(pa.array(pick))
                x, y = (part.column(i).flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(pick), d) for i in (2, 3))
                # powers of two change no digit of the cosine, but keep squares in range
                x, y = (np.ldexp(v, -np.frexp(np.abs(v).max(axis=1, keepdims=True))[1]) for v in (x, y))
                top = np.einsum("ij,ij->i", x, y)
                base = np.sqrt(np.einsum("ij,ij->i", x, x)) * np.sqrt(np.einsum("ij,ij->i", y, y))
                good[pick] = top >= threshold * base
            mask = pa.array(good)
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(mask), batch.column(1).filter(mask)], names=["a", "b"])

    return pairs.join(left, "a").join(right, "b").select("a", "b", "va", "vb").mapInArrow(run, "a long, b long")


def near_duplicates(
    df: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    threshold: float = 0.98,
    width: float = WIDTH,
    miss: float = MISS,
) -> DataFrame:
    """Links between vectors of equal label at a cosine of ``threshold`` or more.

    Returns one row per input row: ``id_col, n_links`` (other rows linked
    directly), ``component_id`` (smallest id reachable, itself included),
    ``kept`` (id = component). Vectors are compared only when their labels are
    equal and not null and they have equally many components. Null, empty and
    zero vectors, vectors with null or non-finite components, and rows with a
    null id link with nothing (the null id stays its own component, not kept).

    Equal vectors of a label form one class, found with map-side sums; only
    classes are hashed, and only pairs that share a key in some table are
    checked, exactly. Classes of equal vectors, however large, cost one row.
    No bucket is capped: hot ones are joined with skew splitting. A repeated id
    is a row of its own. An empty table gives no rows.
    """
    whole = df.schema[label_col].dataType.typeName() in ("byte", "short", "integer", "long")
    # labels of other types are told apart by their text's hash; only equality counts
    label = F.col(label_col).cast("long") if whole else F.when(F.col(label_col).isNotNull(), F.xxhash64(F.col(label_col).cast("string")))
    rows = df.select(F.col(id_col).cast("long").alias("id"), label.alias("label"), F.col(vector_col).alias("vector"))
    ok = F.coalesce(F.col("label").isNotNull() & F.col("id").isNotNull() & _usable(F.col("vector")), F.lit(False))
    parts = [F.xxhash64(F.lit(s), "label", "vector") for s in (1, 2)]
    rows = rows.withColumn("class", F.when(ok, F.concat_ws("-", *[p.cast("string") for p in parts])))
    classes = (
        rows.where("class is not null")
        .groupBy("class").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("n"), F.any_value("label").alias("label"), F.any_value("vector").alias("vector"))
        .withColumn("dims", F.size("vector"))
    )
    classes = staged(classes, "vector-classes")
    largest = classes.groupBy("label", "dims").count().agg(F.coalesce(F.max("count"), F.lit(0))).first()[0]
    k, tables = plan_tables(largest, threshold, width, miss)
    keys = staged(table_keys(classes, k, tables, width), "vector-keys")
    other = keys.select("label", "dims", "t", "key", F.col("id").alias("b"))
    pairs = keys.withColumnRenamed("id", "a").join(other, ["label", "dims", "t", "key"]).where("a < b").select("a", "b").distinct()
    links = staged(cosine_links(pairs, classes, threshold), "vector-links")
    sizes = classes.select(F.col("id").alias("to"), F.col("n").alias("others"))
    both = links.select(F.col("a").alias("id"), F.col("b").alias("to")).unionByName(
        links.select(F.col("b").alias("id"), F.col("a").alias("to"))
    )
    linked = both.join(sizes, "to").groupBy("id").agg(F.sum("others").alias("linked"))
    found = connected_components(links).withColumnRenamed("node", "id")
    info = classes.select("class", "id", "n").join(linked, "id", "left").join(found, "id", "left").select(
        "class", (F.coalesce("linked", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("component", "id").alias("component_id")
    )
    info = staged(info, "vector-info")
    # rows without a class get keys of their own, so that they do not meet in one task
    alone = F.concat(F.lit("?"), F.xxhash64("id", F.monotonically_increasing_id()).cast("string"))
    return (
        rows.select("id", F.coalesce("class", alone).alias("class")).join(info, "class", "left")
        .select(
            F.col("id").cast(df.schema[id_col].dataType).alias(id_col),
            F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
            F.coalesce("component_id", "id").alias("component_id"),
            F.coalesce(F.col("id") == F.coalesce("component_id", "id"), F.lit(False)).alias("kept"),
        )
    )
