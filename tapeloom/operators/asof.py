"""As-of and enrichment joins, linear in their inputs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def asof_backward(
    left: DataFrame, right: DataFrame, by: list[str], left_at: str, right_at: str, take: list[str], strict: bool = False, tie: list[str] | None = None
) -> DataFrame:
    """Left rows with the latest right row at or before them (``strict``: before them).

    Both sides are sorted together once per key and the last right row is
    carried on, so no pair of rows is compared. ``tie`` orders right rows of one
    moment; the last of them counts.
    """
    order = tie or []
    l = left.select(*by, F.col(left_at).alias("_at"), F.lit(0 if strict else 1).alias("_side"), *[F.lit(None).cast(right.schema[c].dataType).alias(f"_t{i}") for i, c in enumerate(order)],
                    F.lit(None).cast(right.select(F.struct(*take)).schema[0].dataType).alias("_r"), F.struct(*left.columns).alias("_l"))
    r = right.select(*by, F.col(right_at).alias("_at"), F.lit(1 if strict else 0).alias("_side"), *[F.col(c).alias(f"_t{i}") for i, c in enumerate(order)],
                     F.struct(*take).alias("_r"), F.lit(None).cast(left.select(F.struct(*left.columns)).schema[0].dataType).alias("_l"))
    w = Window.partitionBy(*by).orderBy("_at", "_side", *[f"_t{i}" for i in range(len(order))]).rowsBetween(Window.unboundedPreceding, 0)
    both = l.unionByName(r).withColumn("_m", F.last("_r", ignorenulls=True).over(w)).where(F.col("_l").isNotNull())
    return both.select("_l.*", *[F.col(f"_m.{c}").alias(c if c not in left.columns else f"right_{c}") for c in take])


def asof_forward(left: DataFrame, right: DataFrame, by: list[str], left_at: str, right_at: str, take: list[str]) -> DataFrame:
    """Left rows with the first right row at or after them; of equal moments the right row comes after."""
    l = left.select(*by, F.col(left_at).alias("_at"), F.lit(0).alias("_side"),
                    F.lit(None).cast(right.select(F.struct(*take)).schema[0].dataType).alias("_r"), F.struct(*left.columns).alias("_l"))
    r = right.select(*by, F.col(right_at).alias("_at"), F.lit(1).alias("_side"), F.struct(*take).alias("_r"),
                     F.lit(None).cast(left.select(F.struct(*left.columns)).schema[0].dataType).alias("_l"))
    w = Window.partitionBy(*by).orderBy("_at", "_side", "_r").rowsBetween(0, Window.unboundedFollowing)
    both = l.unionByName(r).withColumn("_m", F.first("_r", ignorenulls=True).over(w)).where(F.col("_l").isNotNull())
    return both.select("_l.*", *[F.col(f"_m.{c}").alias(c if c not in left.columns else f"right_{c}") for c in take])


def latest_at(df: DataFrame, by: str, at: str, moment: Column, take: list[str]) -> DataFrame:
    """The newest row of every key at or before one moment."""
    rows = df.where(F.col(at) <= moment)
    return rows.groupBy(by).agg(*[F.max_by(c, at).alias(c) for c in take])


def outer_snapshots(frames: list[DataFrame], key: str) -> DataFrame:
    """Full-outer merge of per-table snapshots on a key; each has one row per key."""
    out = frames[0]
    for f in frames[1:]:
        out = out.join(f, key, "full_outer")
    return out


def enrich(left: DataFrame, right: DataFrame, on: list[str], columns: list[str], prefer: str = "right") -> DataFrame:
    """Left join whose columns are the right side's where present, else the left's (or the other way round)."""
    r = right.select(*on, *[F.col(c).alias(f"_{c}") for c in columns])
    out = left.join(r, on, "left")
    have = set(left.columns)
    new = {}
    for c in columns:
        pair = [F.col(f"_{c}"), F.col(c)] if c in have else [F.col(f"_{c}")]
        new[c] = F.coalesce(*(pair if prefer == "right" else pair[::-1]))
    return out.withColumns(new).drop(*[f"_{c}" for c in columns])


def fill_forward(df: DataFrame, columns: list[str], by: str = "symbol", order: str = "date") -> DataFrame:
    w = Window.partitionBy(by).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumns({c: F.last(c, ignorenulls=True).over(w) for c in columns})


def daily_spine(df: DataFrame, columns: list[str], by: str = "symbol", at: str = "date", until: str | None = None) -> DataFrame:
    """One row per key and calendar day from the first to the last (or ``until``), values carried forward."""
    last = F.max(at) if until is None else F.greatest(F.max(at), F.lit(until).cast("date"))
    days = df.groupBy(by).agg(F.explode(F.sequence(F.min(at), last)).alias(at))
    return fill_forward(days.join(df.select(by, at, *columns), [by, at], "left"), columns, by, at)
