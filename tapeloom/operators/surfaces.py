"""Portfolio surfaces of accounts that hold several sleeves: history, slices and alerts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tapeloom.functions.nulls import safe_div

# When cash and drift are worth an alert.
CASH_RATIO, DRIFT = 0.2, 0.1
_SAMPLE = ("portfolio_value", "cash", "gross_exposure", "net_exposure", "turnover", "commission", "slippage_cost", "drawdown", "cumulative_return")


def last_samples(df: DataFrame, keys: list[str], at: str = "bar_ts") -> DataFrame:
    """The last sample of every UTC day: ``keys, as_of`` and the other columns; cash and exposures count 0 where they are null.

    The session's time zone should be UTC; of samples at one moment the largest by value counts.
    """
    rest = [c for c in df.columns if c not in (*keys, at)]
    zeros = ("cash", "gross_exposure", "net_exposure")
    row = F.struct(*[(F.coalesce(c, F.lit(0.0)) if c in zeros else F.col(c)).alias(c) for c in rest])
    return df.where(F.col(at).isNotNull()).groupBy(*keys, F.to_date(at).alias("as_of")).agg(F.max_by(row, F.struct(at, *[c for c in rest])).alias("_s")).select(*keys, "as_of", "_s.*")


def sleeve_days(samples: DataFrame, account: str = "account", sleeve: str = "sleeve") -> DataFrame:
    """Each sleeve on every day on which any sleeve of its account has a sample, by its last sample up to then; none before its first."""
    days = samples.select(account, "as_of").distinct()
    sleeves = samples.groupBy(account, sleeve).agg(F.min("as_of").alias("_first"))
    spine = days.join(sleeves, account).where("as_of >= _first").drop("_first")
    values = [c for c in _SAMPLE if c in samples.columns]
    joined = spine.join(samples.select(account, sleeve, "as_of", F.struct(*values).alias("_s")), [account, sleeve, "as_of"], "left")
    w = Window.partitionBy(account, sleeve).orderBy("as_of").rowsBetween(Window.unboundedPreceding, 0)
    return joined.withColumn("_s", F.last("_s", ignorenulls=True).over(w)).select(account, sleeve, "as_of", "_s.*")


def portfolio_history(samples: DataFrame, allocations: DataFrame, accounts: DataFrame) -> DataFrame:
    """``account, as_of`` with nav, cash, exposures, profit, returns, drawdown, turnover and cost of every day.

    ``samples``: of :func:`last_samples` by (account, sleeve); ``allocations``:
    account, sleeve, scale; ``accounts``: account, seed_nav, residual_cash. A
    day adds up the scaled sleeves; exposures and turnover are weighted by their
    value, costs are basis points of the value of sleeves that had any. A first
    day without value starts at the seed. One join by (account, sleeve), one
    window a sleeve and one an account.
    """
    s = sleeve_days(samples).join(allocations.select("account", "sleeve", "scale"), ["account", "sleeve"], "left").withColumn("scale", F.coalesce("scale", F.lit(0.0)))
    v = F.col("portfolio_value") * F.col("scale")
    cost = F.coalesce("commission", F.lit(0.0)) + F.coalesce("slippage_cost", F.lit(0.0))
    costly = (v > 0) & (cost > 0)
    day = s.groupBy("account", "as_of").agg(
        F.sum(v).alias("_nav"), F.sum(F.col("cash") * F.col("scale")).alias("_cash"), F.sum(F.col("gross_exposure") * v).alias("_gross"), F.sum(F.col("net_exposure") * v).alias("_net"),
        F.sum(F.coalesce(F.col("turnover") * v, F.lit(0.0))).alias("_turnover"), F.sum(F.when(costly, cost * 10000.0)).alias("_drag"), F.sum(F.when(costly, v)).alias("_drag_on"))
    day = day.join(accounts.select("account", "seed_nav", "residual_cash"), "account")
    w = Window.partitionBy("account").orderBy("as_of")
    extra = F.greatest(F.coalesce("residual_cash", F.lit(0.0)), F.lit(0.0))
    day = day.withColumns({"nav": F.col("_nav") + extra, "cash": F.col("_cash") + extra})
    empty = (F.abs("nav") < 1e-9) & (F.row_number().over(w) == 1) & (F.col("seed_nav") > 0)
    day = day.withColumns({"_empty": empty}).withColumns({"nav": F.when(F.col("_empty"), F.col("seed_nav")).otherwise(F.col("nav")), "cash": F.when(F.col("_empty"), F.col("seed_nav")).otherwise(F.col("cash"))})
    nav, before, peak = F.col("nav"), F.lag("nav").over(w), F.greatest(F.max("nav").over(w.rowsBetween(Window.unboundedPreceding, 0)), F.lit(0.0))
    total = nav - F.col("seed_nav")
    total_return = F.when(F.col("seed_nav") > 0, total / F.col("seed_nav")).otherwise(0.0)
    out = day.withColumns({"_before": before, "_peak": peak, "cumulative_pnl": total, "cumulative_return": total_return})
    pnl = F.coalesce(nav - F.col("_before"), F.col("cumulative_pnl"))
    some = nav > 0
    return out.select(
        "account", "as_of", "nav", "cash", F.when(some, F.col("_gross") / nav).otherwise(0.0).alias("gross_exposure"), F.when(some, F.col("_net") / nav).otherwise(0.0).alias("net_exposure"),
        pnl.alias("period_pnl"), F.coalesce(safe_div(pnl, F.col("_before")), F.col("cumulative_return")).alias("period_return"), "cumulative_pnl", "cumulative_return",
        F.when(F.col("_peak") > 0, nav / F.col("_peak") - 1).otherwise(0.0).alias("drawdown"), F.when(some, F.col("_turnover") / nav).alias("turnover"), safe_div(F.col("_drag"), F.col("_drag_on")).alias("cost_drag_bps"),
    )


def portfolio_slices(samples: DataFrame, allocations: DataFrame, history: DataFrame) -> DataFrame:
    """What each allocated sleeve is worth at an account's last day, and what it brought; ``position`` is its place by value, largest first."""
    last = history.groupBy("account").agg(F.max_by("nav", "as_of").alias("_nav"), F.max("as_of").alias("as_of"))
    per = samples.groupBy("account", "sleeve").agg(F.min_by("portfolio_value", "as_of").alias("_first"), *[F.max_by(c, "as_of").alias(c) for c in ("portfolio_value", "gross_exposure", "net_exposure", "turnover", "drawdown", "cumulative_return")])
    s = allocations.join(per, ["account", "sleeve"]).join(last, "account")
    nav, scale = F.col("_nav"), F.coalesce("scale", F.lit(0.0))
    s = s.withColumn("market_value", F.col("portfolio_value") * scale)
    s = s.withColumns({"actual_weight": F.when(nav > 0, F.col("market_value") / nav).otherwise(0.0), "pnl_contribution": F.col("market_value") - F.col("_first") * scale})
    place = F.row_number().over(Window.partitionBy("account").orderBy(F.desc("market_value"), "sleeve"))
    w = F.col("actual_weight")
    return s.select(
        "account", "sleeve", "as_of", F.coalesce("target_weight", F.lit(0.0)).alias("target_weight"), "actual_weight", "market_value", F.greatest(F.col("gross_exposure") * w, F.lit(0.0)).alias("gross_exposure"),
        (F.col("net_exposure") * w).alias("net_exposure"), "pnl_contribution", F.when(nav > 0, F.col("pnl_contribution") / nav).otherwise(0.0).alias("return_contribution"),
        (F.coalesce("drawdown", F.lit(0.0)) * w).alias("drawdown_contribution"), "turnover", F.col("cumulative_return").alias("since_inception_return"), place.alias("position"),
    )


def portfolio_alerts(accounts: DataFrame, history: DataFrame, slices: DataFrame) -> DataFrame:
    """``account, code, severity, as_of, level``: accounts without an assignment or revision, too much cash, sleeves off their target.

    ``accounts``: account, assigned and revised (booleans). The level is the share of cash, or how far the weight is off.
    """
    last = history.groupBy("account").agg(F.max("as_of").alias("as_of"), F.max_by(F.when(F.col("nav") > 0, F.col("cash") / F.col("nav")), "as_of").alias("level"))
    none, day = F.lit(None).cast("double").alias("level"), F.lit(None).cast("date").alias("as_of")
    parts = [
        accounts.where(~F.coalesce("assigned", F.lit(False))).select("account", F.lit("no_assignment").alias("code"), F.lit("critical").alias("severity"), day, none),
        accounts.where(~F.coalesce("revised", F.lit(False))).select("account", F.lit("no_portfolio_revision").alias("code"), F.lit("critical").alias("severity"), day, none),
        last.where(F.abs("level") >= CASH_RATIO).select("account", F.lit("cash_residual_high").alias("code"), F.lit("warning").alias("severity"), "as_of", "level"),
        slices.withColumn("level", F.col("actual_weight") - F.col("target_weight")).where(F.abs("level") >= DRIFT).select("account", F.concat(F.lit("drift_"), "sleeve").alias("code"), F.lit("warning").alias("severity"), "as_of", "level"),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
