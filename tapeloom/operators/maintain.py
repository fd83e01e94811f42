"""Merges, upserts, version history and sweeps of tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def union_all(*frames: DataFrame) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def merge_last(existing: DataFrame, incoming: DataFrame, keys: list[str]) -> DataFrame:
    """Both tables, incoming rows instead of existing ones with equal keys."""
    kept = existing.join(incoming.select(*keys).distinct(), keys, "left_anti")
    return kept.select(*existing.columns).unionByName(incoming, allowMissingColumns=True)


def staged_apply(current: DataFrame, stage: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """What applying ``stage`` to ``current`` does: ``op`` of every key and its values afterwards.

    Updates are told from unchanged rows by null-safe comparison.
    """
    c = current.select(*keys, F.struct(*values).alias("_c"))
    s = stage.select(*keys, F.struct(*values).alias("_s"))
    op = (
        F.when(F.col("_c").isNull(), "insert").when(F.col("_s").isNull(), "delete")
        .when(F.col("_c").eqNullSafe(F.col("_s")), "unchanged").otherwise("update")
    )
    return c.join(s, keys, "full_outer").select(*keys, op.alias("op"), *[F.coalesce(F.col("_s"), F.col("_c"))[v].alias(v) for v in values])


def gentle_upsert(current: DataFrame, incoming: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """New values where they are not null or blank, else the old ones; new keys are added."""
    i = incoming.select(*keys, *[F.nullif(F.trim(F.col(v).cast("string")), F.lit("")).cast(current.schema[v].dataType).alias(f"_{v}") for v in values])
    return current.select(*keys, *values).join(i, keys, "full_outer").select(*keys, *[F.coalesce(f"_{v}", v).alias(v) for v in values])


def bucket_letter(symbol: Column) -> Column:
    return F.coalesce(F.nullif(F.regexp_extract(F.upper(symbol), r"[A-Z]", 0), F.lit("")), F.lit("X"))


def pick_first(value: Column, *order: Column) -> Column:
    """Aggregate: the first value by ``order`` that is neither null nor blank."""
    usable = F.nullif(F.trim(value.cast("string")), F.lit("")).isNotNull()
    return F.min_by(F.when(usable, value), F.when(usable, F.struct(*order)))


def versions(changes: DataFrame, entity: str, source: str, at: str, value: str, priority: dict[str, int]) -> DataFrame:
    """History of an entity's fused state: a row whenever the state changes.

    After each observation the state is the latest value of every source, by
    the sources' priority; it is carried with windows (one pass per source, no
    pair of observations is compared).
    """
    w = Window.partitionBy(entity).orderBy(at, source)
    past = w.rowsBetween(Window.unboundedPreceding, 0)
    latest = {s: F.last(F.when(F.col(source) == s, F.col(value)), ignorenulls=True).over(past) for s in priority}
    out = changes.withColumns({f"_v_{i}": latest[s] for i, s in enumerate(sorted(priority, key=priority.get))})
    out = out.withColumn("state", F.coalesce(*[f"_v_{i}" for i in range(len(priority))]))
    out = out.withColumn("_h", F.sha2(F.concat_ws("|", *[F.coalesce(F.col(f"_v_{i}").cast("string"), F.lit("~")) for i in range(len(priority))]), 256))
    before = F.lag("state").over(w)
    out = out.withColumns({"_before": before, "_changed": F.coalesce(F.lag("_h").over(w) != F.col("_h"), F.lit(True))}).where("_changed")
    kind = F.when(F.col("_before").isNull() & F.col("state").isNotNull(), "publish").when(F.col("_before").eqNullSafe(F.col("state")), "correction").otherwise("revision")
    return out.select(entity, at, source, "state", F.row_number().over(w).alias("version_seq"), kind.alias("version_kind"))


def changed_snapshots(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of one snapshot that the other lacks, with the side they are on; none if the two are equal."""
    return a.exceptAll(b).withColumn("side", F.lit("removed")).unionByName(b.exceptAll(a).withColumn("side", F.lit("added")))
