"""Row windows over one symbol's history."""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

#: So many distinct values are sorted in one task when a rank is looked up.
SORTED_VALUES = 100_000
PIVOTS = 64


def series(by: str | list[str] = "symbol", order: str = "date") -> WindowSpec:
    return Window.partitionBy(by).orderBy(order)


class Rolling:
    """Aggregates over the last ``n`` rows, null unless all ``n`` values are there."""

    def __init__(self, by: str | list[str] = "symbol", order: str = "date"):
        self.w = series(by, order)

    def frame(self, n: int, end: int = 0) -> WindowSpec:
        return self.w.rowsBetween(end - n + 1, end)

    def full(self, agg, x: Column, n: int, end: int = 0) -> Column:
        """``agg`` (a function of a column) over ``n`` rows that end ``end`` rows from here."""
        return F.when(F.count(x).over(self.frame(n, end)) == n, agg(x).over(self.frame(n, end)))

    def mean(self, x: Column, n: int) -> Column:
        return self.full(F.avg, x, n)

    def std(self, x: Column, n: int) -> Column:
        return self.full(F.stddev_samp, x, n)

    def total(self, x: Column, n: int) -> Column:
        return self.full(F.sum, x, n)

    def lag(self, x: Column, n: int = 1) -> Column:
        return F.lag(x, n).over(self.w)

    def filled(self, x: Column) -> Column:
        """The last value that is not null."""
        return F.last(x, ignorenulls=True).over(self.w.rowsBetween(Window.unboundedPreceding, 0))

    def zscore(self, x: Column, n: int) -> Column:
        mean, std = self.mean(x, n), self.std(x, n)
        return (x - mean) / F.nullif(std, F.lit(0.0))


def value_at(df: DataFrame, column: str, rank: int, few: int = SORTED_VALUES) -> tuple[Any, int]:
    """The value at a 0-based rank among the values that are not null, ascending, and the number of values below it.

    Exact and never one sort of everything: sampled pivots narrow the range by
    about ``PIVOTS`` a pass, until at most about ``few`` distinct values are left.
    ``rank`` must lie below the number of values.
    """
    c = F.col("v")
    inside, below, seed = df.select(F.col(column).alias("v")).where(c.isNotNull()), 0, 0
    while True:
        n, distinct = inside.agg(F.count(c), F.approx_count_distinct(c)).first()
        if distinct <= few:
            upto = inside.groupBy("v").count().withColumn("upto", F.sum("count").over(Window.orderBy("v")))
            found = upto.where(F.col("upto") > rank - below).orderBy("v").first()
            return found["v"], below + found["upto"] - found["count"]
        sample = sorted({r[0] for r in inside.sample(min(1.0, 40.0 * PIVOTS / n), seed).limit(80 * PIVOTS).collect()})
        pivots = sample[:: max(1, len(sample) // PIVOTS)]
        seed += 1
        if not pivots:
            continue
        at_most = inside.agg(*[F.count_if(c <= F.lit(p)) for p in pivots]).first()
        i = next((i for i, k in enumerate(at_most) if k > rank - below), len(pivots))
        if i:
            inside, below = inside.where(c > F.lit(pivots[i - 1])), below + at_most[i - 1]
        if i < len(pivots):
            inside = inside.where(c <= F.lit(pivots[i]))
