"""Data-quality gates as tables: counts of what breaks a rule, freshness, jumps, drift."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def violations(df: DataFrame, rules: dict[str, Column], keys: list[str] | None = None) -> DataFrame:
    """One row per rule with the number of rows that break it; ``duplicate_key`` counts surplus rows."""
    counts = df.agg(*[F.count_if(F.coalesce(c, F.lit(False))).alias(n) for n, c in rules.items()])
    out = counts.select(F.explode(F.map_from_arrays(F.array(*[F.lit(n) for n in rules]), F.array(*rules))).alias("rule", "rows"))
    if keys:
        dup = df.groupBy(*keys).count().agg(F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).alias("rows")).select(F.lit("duplicate_key").alias("rule"), "rows")
        out = out.unionByName(dup)
    return out


def schema_drift(have: DataFrame, want: dict[str, str]) -> DataFrame:
    """Missing, extra and retyped columns, and those that stand elsewhere among the columns of both."""
    now = dict(have.dtypes)
    rows = [(c, "missing") for c in want if c not in now] + [(c, "extra") for c in now if c not in want] + [(c, "type") for c in want if c in now and now[c] != want[c]]
    rows += [(a, "order") for a, b in zip([c for c in now if c in want], [c for c in want if c in now], strict=True) if a != b]
    return have.sparkSession.createDataFrame(rows, "column string, drift string")


def null_columns(df: DataFrame) -> DataFrame:
    """Columns and how many values they have; none means all null."""
    c = df.agg(*[F.count(F.col(x)).alias(x) for x in df.columns])
    return c.select(F.explode(F.map_from_arrays(F.array(*[F.lit(x) for x in df.columns]), F.array(*[F.col(x) for x in df.columns]))).alias("column", "n_values"))


def freshness(df: DataFrame, by: str, at: str, now: Column, stale: int, error: int) -> DataFrame:
    """Days since the last row of each key, and whether that is fine."""
    g = df.groupBy(by).agg(F.max(at).alias("last_at")).withColumn("age_days", F.datediff(now, F.col("last_at")))
    return g.withColumn("status", F.when(F.col("age_days") > error, "error").when(F.col("age_days") > stale, "stale").otherwise("healthy"))


def count_jumps(df: DataFrame, by: str, at: str, warn: float, error: float, least: int) -> DataFrame:
    """Days whose row count is a multiple of that of the day before; a day behind one without rows has no ratio."""
    g = df.groupBy(by, at).agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy(by).orderBy(at)
    before = F.when(F.datediff(F.col(at), F.lag(at).over(w)) == 1, F.lag("n").over(w))
    g = g.withColumn("ratio", F.col("n") / before).where((F.col("n") >= least) & (F.col("ratio") >= warn))
    return g.withColumn("level", F.when(F.col("ratio") >= error, "error").otherwise("warning"))


def promotions(runs: DataFrame, by: str, order: str, reason: str, threshold: int) -> DataFrame:
    """Longest and last streak of runs that failed for one and the same reason; a success or another reason begins anew."""
    w = Window.partitionBy(by).orderBy(order)
    changed = F.coalesce(~F.col(reason).eqNullSafe(F.lag(reason).over(w)), F.lit(True)).cast("int")
    g = runs.withColumn("_c", changed).withColumn("_g", F.sum("_c").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    s = g.where(F.col(reason).isNotNull()).groupBy(by, "_g", reason).agg(F.count(F.lit(1)).alias("runs"))
    return s.groupBy(by).agg(F.max("runs").alias("longest"), F.max_by(reason, F.struct("runs", reason)).alias("reason")).withColumn("promoted", F.col("longest") >= threshold)


def to_reprocess(current: DataFrame, prior: DataFrame, key: str, last_success: str | None) -> DataFrame:
    """Items to be processed again, with the ``reason``: new, another ``etag`` than ``prior_etag``, or ``modified_at`` after the last success."""
    late = F.lit(False) if last_success is None else F.col("modified_at") > F.lit(last_success).cast("timestamp")
    reason = F.when(F.col("prior_etag").isNull(), "new").when(~F.col("etag").eqNullSafe(F.col("prior_etag")), "changed").when(late, "modified")
    return current.join(prior, key, "left").withColumn("reason", reason).where("reason is not null")


def sync_current(source: DataFrame, state: DataFrame, keys: list[str]) -> DataFrame:
    """``is_current`` for every source bucket: its last sync succeeded at ``source_commit`` or later."""
    done = (F.lower(F.trim("status")) == "success") & (F.col("prior_commit").try_cast("double") >= F.col("source_commit"))
    return source.join(state, keys, "left").select(*keys, "source_commit", F.coalesce(done, F.lit(False)).alias("is_current"))


def zero_write(runs: DataFrame) -> DataFrame:
    """Runs that processed something and wrote nothing."""
    return runs.where((F.col("processed") > 0) & (F.coalesce("written", F.lit(0)) == 0))


def source_decision(sources: DataFrame, run: str) -> DataFrame:
    """Per run whether it fails: only if all its sources did, or all ``official`` ones of those it has."""
    all_failed, official = F.bool_and("failed"), F.coalesce(F.bool_and(F.when(F.col("official"), F.col("failed"))), F.lit(False))
    g = sources.groupBy(run).agg(all_failed.alias("_a"), official.alias("_o"), F.count_if("failed").alias("failed"), F.count_if(~F.col("failed")).alias("succeeded"))
    reason = F.when(F.col("_a"), "all_selected_sources_failed").when(F.col("_o"), "all_required_sources_failed").otherwise("partial_source_outage")
    return g.select(run, (F.col("_a") | F.col("_o")).alias("fails"), reason.alias("reason"), "failed", "succeeded")
