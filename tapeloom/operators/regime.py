"""Market regimes from daily metrics: inputs, streaks, rules, transitions, publication."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapeloom.functions.nulls import flag


def streak(cond: Column, by: str, order: str) -> Column:
    """Rows in a row, this one included, for which ``cond`` holds; a null ends a streak."""
    w = Window.partitionBy(by).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    hit = F.coalesce(cond, F.lit(False))
    last_miss = F.max(F.when(~hit, F.row_number().over(Window.partitionBy(by).orderBy(order)))).over(w)
    row = F.row_number().over(Window.partitionBy(by).orderBy(order))
    return F.when(hit, row - F.coalesce(last_miss, F.lit(0))).otherwise(0)


def complete(columns: list[str]) -> Column:
    out = F.lit(True)
    for c in columns:
        out = out & F.col(c).isNotNull()
    return out


#: Share of a regime's rules that must hold.
ACTIVE = 0.6


def classify(metrics: DataFrame, rules: list[tuple[str, str, str, float]], keys: list[str], active: float = ACTIVE) -> DataFrame:
    """One row per key and regime: share of its rules that hold, status, activity.

    ``rules``: regime, metric, operator, threshold; a small list, made a table
    and broadcast. A missing metric makes the regime ``insufficient_data``.
    """
    spark = metrics.sparkSession
    names = sorted({m for _, m, _, _ in rules})
    table = spark.createDataFrame(rules, "code string, metric string, op string, threshold double")
    long = metrics.select(*keys, F.explode(F.create_map(*[x for n in names for x in (F.lit(n), F.col(n).cast("double"))])).alias("metric", "value"))
    hit = F.expr("case op when 'gt' then value > threshold when 'gte' then value >= threshold when 'lt' then value < threshold else value <= threshold end")
    j = long.join(F.broadcast(table), "metric").groupBy(*keys, "code").agg(
        F.count(F.lit(1)).alias("n"), F.count("value").alias("known"), F.count_if(hit).alias("held"),
    )
    score = F.when(F.col("known") == F.col("n"), F.col("held") / F.col("n"))
    j = j.withColumn("score", score)
    status = F.when(F.col("score").isNull(), "insufficient_data").when(F.col("score") >= active, "active").otherwise("inactive")
    return j.select(*keys, "code", "score", status.alias("status"), flag(F.col("score") >= active).alias("is_active"))


def transitions(signals: DataFrame, by: list[str], order: str) -> DataFrame:
    """Rows at which a signal begins or ends; a first active row counts as a beginning."""
    before = F.coalesce(F.lag("is_active").over(Window.partitionBy(*by).orderBy(order)), F.lit(0))
    t = F.when((F.col("is_active") == 1) & (before == 0), "entered").when((F.col("is_active") == 0) & (before == 1), "exited")
    return signals.withColumn("transition", t).where("transition is not null")


def snapshot(signals: DataFrame, key: str) -> DataFrame:
    """Per key the active codes in order, and ``unclassified`` where none is."""
    codes = F.sort_array(F.collect_list(F.when(F.col("is_active") == 1, F.col("code"))))
    return signals.groupBy(key).agg(codes.alias("codes")).withColumn("label", F.when(F.size("codes") == 0, "unclassified").otherwise(F.array_join("codes", ",")))


def publish_window(df: DataFrame, at: str, ready: str) -> DataFrame:
    """One row: the last complete date, the last date at all, and the dates behind the complete one, in order.

    The dates that are not complete meet in one row: at most one per calendar day, whatever the table holds.
    """
    open_days = F.collect_set(F.when(~F.coalesce(F.col(ready), F.lit(False)), F.col(at)))
    w = df.agg(F.max(F.when(F.col(ready), F.col(at))).alias("published_through"), F.max(at).alias("input_through"), open_days.alias("_open"))
    return w.select("published_through", "input_through", F.array_sort(F.filter("_open", lambda d: F.col("published_through").isNull() | (d > F.col("published_through")))).alias("skipped"))


def inputs_daily(features: DataFrame, macro: DataFrame, slices: dict[str, tuple[str, dict[str, str]]], vix: str, vix_far: str, high: float = 32.0) -> DataFrame:
    """One row a date: columns of several symbols side by side, macro inputs, the slope and streak of volatility, and whether all is there.

    ``slices``: a symbol and its columns with their new names, by any name;
    ``vix`` and ``vix_far`` are such new names. ``macro``: date and inputs. The
    symbols are laid out in one aggregate by date and met with the macro rows in
    one full join; the streak runs over dates, one row a day. ``inputs_complete``
    is true where no input is null.
    """
    picks = [F.max(F.when(F.col("symbol") == symbol, F.col(c))).alias(new) for symbol, columns in slices.values() for c, new in columns.items()]
    wide = features.where(F.col("symbol").isin(*{symbol for symbol, _ in slices.values()})).groupBy("date").agg(*picks)
    out = wide.join(macro, "date", "full_outer").withColumn("vix_slope", F.col(vix_far) - F.col(vix)).withColumn("_all", F.lit(1))
    out = out.withColumn("vix_streak", streak(F.coalesce(F.col(vix) > high, F.lit(False)), "_all", "date")).drop("_all")
    needed = [c for c in out.columns if c not in ("date", "vix_streak")]
    return out.withColumn("inputs_complete", complete(needed))


def ready_through(df: DataFrame, by: str, at: str, ready: str) -> DataFrame:
    """Per key the last date before which every date was ready."""
    w = Window.partitionBy(by).orderBy(at).rowsBetween(Window.unboundedPreceding, 0)
    ok = F.min(F.col(ready).cast("int")).over(w) == 1
    return df.withColumn("_ok", ok).groupBy(by).agg(F.max(F.when(F.col("_ok"), F.col(at))).alias("ready_through"), F.count_if("_ok").alias("ready_dates"))
