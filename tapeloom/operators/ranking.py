"""Cross-sectional transforms, scores, ranks and selections by date."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapeloom.functions.nulls import safe_div


def transform(x: Column, name: str, by: str | list[str] = "date", **p: float) -> Column:
    """One rank transform over the cross-section.

    Ties share the average rank; deviations are the sample's; quantiles are
    interpolated; ``minmax`` and ``zscore`` of a constant are null.
    """
    w = Window.partitionBy(by)
    if name == "percentile_rank":
        # average rank: rows below, plus half of those that tie (itself included) and a half
        order = w.orderBy(x)
        below = F.rank().over(order) - F.sum(F.when(x.isNull(), 1).otherwise(0)).over(w)
        ties = F.count(x).over(order.rangeBetween(0, 0))
        return F.when(x.isNotNull(), (below + (ties - 1) / 2.0) / F.count(x).over(w))
    if name == "zscore":
        return safe_div(x - F.avg(x).over(w), F.stddev_samp(x).over(w))
    if name == "minmax":
        return safe_div(x - F.min(x).over(w), F.max(x).over(w) - F.min(x).over(w))
    if name == "clip":
        return F.when(x.isNotNull(), F.least(F.greatest(x, F.lit(p["low"])), F.lit(p["high"])))
    if name == "winsorize":
        low, high = (F.percentile(x, F.lit(p[k])).over(w) for k in ("low", "high"))
        return F.when(x.isNotNull(), F.least(F.greatest(x, low), high))
    if name == "coalesce":
        return F.coalesce(x, F.lit(p["value"]))
    if name == "log1p":
        return F.when(x > -1, F.log1p(x))
    if name == "negate":
        return -x
    if name == "abs":
        return F.abs(x)
    raise ValueError(f"unknown transform {name}")


@dataclass(frozen=True)
class Factor:
    """A column, its weight, direction, treatment of nulls and transforms in order."""

    column: str
    weight: float = 1.0
    ascending: bool = False
    missing: str = "exclude"
    transforms: tuple[tuple[str, dict], ...] = field(default=(("percentile_rank", {}),))


@dataclass(frozen=True)
class Group:
    name: str
    weight: float
    factors: tuple[Factor, ...]


def score(df: DataFrame, groups: list[Group], by: str = "date") -> DataFrame:
    """Adds ``score``: the weighted mean of groups, each the weighted mean of its factors.

    A factor with ``missing='exclude'`` drops the row where it is null, ``zero``
    counts as 0. A null group adds 0 but its weight still counts. Rows without a
    score are dropped.
    """
    out = df
    for g in groups:
        for f in g.factors:
            if f.missing == "exclude":
                out = out.where(F.col(f.column).isNotNull())
    cols = {}
    for g in groups:
        top = F.lit(0.0)
        for i, f in enumerate(g.factors):
            x = F.col(f.column).cast("double")
            name = f"_{g.name}_{i}"
            steps = f.transforms
            for name_, p in steps:
                x = transform(x, name_, by, **p)
            if f.ascending:
                x = -x
            if f.missing == "zero":
                x = F.coalesce(x, F.lit(0.0))
            cols[name] = x
            top = top + F.col(name) * f.weight
        cols_group = top / sum(f.weight for f in g.factors)
        cols[f"_group_{g.name}"] = cols_group
    plain = {k: v for k, v in cols.items() if not k.startswith("_group_")}
    out = out.withColumns(plain)
    out = out.withColumns({k: v for k, v in cols.items() if k.startswith("_group_")})
    total = sum(g.weight for g in groups)
    whole = sum((F.coalesce(F.col(f"_group_{g.name}"), F.lit(0.0)) * g.weight for g in groups), F.lit(0.0)) / total
    out = out.withColumn("score", whole).where(F.col("score").isNotNull())
    return out.drop(*cols)


def ordinal(df: DataFrame, by: str = "date") -> DataFrame:
    """Adds ``rank``: 1..n by score downwards; scores equal to 9 places tie, and symbols break ties."""
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(by).orderBy(F.desc(F.round("score", 9)), "symbol")))


def top_n(df: DataFrame, n: int, max_open: int | None = None) -> DataFrame:
    return df.where(F.col("rank") <= (n if max_open is None else min(n, max_open)))


def target_weights(df: DataFrame, n: int, multiplier: float = 1.0, cap: float | None = None) -> DataFrame:
    """Adds ``target_weight``: an equal share of ``multiplier``, capped."""
    w = F.lit(multiplier / n)
    return df.withColumn("target_weight", F.least(w, F.lit(cap)) if cap is not None else w)


def sample_symbols(df: DataFrame, symbol: str = "symbol", most: int = 25) -> DataFrame:
    """The first symbols in order, ``most`` at most, each with the number of all distinct ones; a look at what a universe holds."""
    distinct = df.where(F.col(symbol).isNotNull()).select(F.col(symbol).alias("symbol")).distinct()
    total = distinct.agg(F.count(F.lit(1)).alias("symbol_count"))  # one row
    return distinct.orderBy("symbol").limit(most).crossJoin(F.broadcast(total))
