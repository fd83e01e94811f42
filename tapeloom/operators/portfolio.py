"""Positions, nav paths, performance and exits from trades and bars."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapeloom.functions.nulls import safe_div
from tapeloom.operators.asof import asof_backward
from tapeloom.session import stored


def nav_path(df: DataFrame, by: str, at: str, nav: str = "nav") -> DataFrame:
    """Adds period profit and return, running peak, drawdown and cumulative return."""
    w = Window.partitionBy(by).orderBy(at)
    past = w.rowsBetween(Window.unboundedPreceding, 0)
    n, before, first = F.col(nav), F.lag(nav).over(w), F.first(nav).over(past)
    out = df.withColumns({"period_pnl": n - before, "period_return": safe_div(n, before) - 1, "peak": F.max(nav).over(past), "cumulative_return": safe_div(n, first) - 1})
    return out.withColumn("drawdown", safe_div(n, F.col("peak")) - 1)


def rolling_metrics(df: DataFrame, by: str, at: str, n: int, periods: float) -> DataFrame:
    """Adds return, volatility, Sharpe ratio and worst drawdown over the last ``n`` periods."""
    w = Window.partitionBy(by).orderBy(at).rowsBetween(-(n - 1), 0)
    r = F.col("period_return")
    full = F.count(r).over(w) == n
    vol = F.stddev_pop(r).over(w) * (periods**0.5)
    mean = F.avg(r).over(w)
    out = df.withColumns({"rolling_return": F.when(full, F.product(1 + r).over(w) - 1), "rolling_vol": F.when(full, vol), "_mean": F.when(full, mean),
                          "rolling_max_drawdown": F.when(full, F.min("drawdown").over(w))})
    return out.withColumn("rolling_sharpe", safe_div(F.col("_mean") * periods, F.col("rolling_vol"))).drop("_mean")


def performance(df: DataFrame, by: str, at: str, periods: float, nav: str = "nav") -> DataFrame:
    """One row per run: returns, risk and ratios, from :func:`nav_path`."""
    r = F.col("period_return")
    g = df.groupBy(by).agg(
        F.min_by(nav, at).alias("first_nav"), F.max_by(nav, at).alias("last_nav"), F.count(r).alias("n"), F.avg(r).alias("mean"), F.stddev_pop(r).alias("std"),
        F.sqrt(F.avg(F.when(r < 0, r * r).when(r.isNotNull(), 0.0))).alias("down"), F.min("drawdown").alias("max_drawdown"), F.count_if(r > 0).alias("ups"),
        F.sum(F.when(r > 0, r)).alias("gain"), F.sum(F.when(r < 0, -r)).alias("loss"),
    )
    total = safe_div(F.col("last_nav"), F.col("first_nav")) - 1
    year = F.when(F.col("n") > 0, F.pow(1 + total, F.lit(periods) / F.col("n")) - 1)
    return g.select(
        by, total.alias("total_return"), year.alias("annualized_return"), (F.col("std") * periods**0.5).alias("volatility"),
        safe_div(F.col("mean") * periods**0.5, F.col("std")).alias("sharpe"), safe_div(F.col("mean") * periods**0.5, F.col("down")).alias("sortino"),
        safe_div(year, F.abs("max_drawdown")).alias("calmar"), "max_drawdown", safe_div(F.col("ups").cast("double"), F.col("n").cast("double")).alias("hit_rate"),
        safe_div(F.col("gain"), F.col("loss")).alias("profit_factor"),
    )


_EXACT = "decimal(30,8)"


def _composed(maps: Column, unit: Column) -> Column:
    """Maps of (cost, profit) one after the other: ``c -> a c + b`` and ``r -> r + g c + d``; closings add up."""

    def then(x: Column, y: Column) -> Column:
        return F.struct((y["a"] * x["a"]).alias("a"), (y["a"] * x["b"] + y["b"]).alias("b"), (x["g"] + y["g"] * x["a"]).alias("g"), (x["d"] + y["d"] + y["g"] * x["b"]).alias("d"), (x["n"] + y["n"]).alias("n"))

    return F.aggregate(maps, unit, then)


def fold_positions(trades: DataFrame, keys: list[str], at: list[str], block: int = 4096) -> DataFrame:
    """Quantity, average cost and realised profit after all trades of a key.

    Buys re-average the cost, sells realise against it, a sell beyond the
    holding is cut to it. Both steps compose: the holding is a sum of trades
    less its lowest value below zero, and once it is known the cost is a linear
    map. So trades are dealt by ranges of (key, order) into blocks of ``block``
    at most, a key's holding before each block comes from the blocks' sums and
    lowest sums, each block is folded by itself, and blocks are put together
    ``block`` at a time, twice, then once more. No array is longer than ``block``
    (the last: rows of a key / block**2), however many trades one key has.
    Sums are exact to eight places.
    """
    order = [*keys, *at, "_q", "_p"]
    rows = trades.select(*keys, *at, F.col("quantity").cast("double").alias("_q"), F.col("price").cast("double").alias("_p"))
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_block", F.expr(f"monotonically_increasing_id() div {block}"))
    listed = rows.groupBy(*keys, "_block").agg(F.sort_array(F.collect_list(F.struct(*at, F.col("_q").alias("q"), F.col("_p").alias("p")))).alias("_rows"))
    zero = F.lit(0).cast(_EXACT)
    swing = F.aggregate("_rows", F.struct(zero.alias("s"), zero.alias("m")), lambda a, t: F.struct((a["s"] + t["q"].cast(_EXACT)).cast(_EXACT).alias("s"), F.least(a["m"], (a["s"] + t["q"].cast(_EXACT)).cast(_EXACT)).alias("m")))
    blocks = stored(listed.withColumn("_swing", swing), "trade-blocks")
    past = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    sums = blocks.select(*keys, "_block", F.col("_swing.s").alias("_s"), F.col("_swing.m").alias("_m"))
    sums = sums.withColumn("_before", F.coalesce(F.sum("_s").over(past), zero)).withColumn("_low", F.least(zero, F.min(F.col("_before") + F.col("_m")).over(past)))
    held = sums.select(*keys, "_block", (F.col("_before") - F.col("_low")).cast("double").alias("_held"))

    def step(a: Column, t: Column) -> Column:
        sold = F.least(-t["q"], a["q"])
        q = F.when(t["q"] > 0, a["q"] + t["q"]).otherwise(a["q"] - sold)
        share = F.when(t["q"] > 0, a["q"] / F.nullif(q, F.lit(0.0))).when(q > 0, 1.0).otherwise(0.0)
        paid = F.when(t["q"] > 0, t["q"] * t["p"] / F.nullif(q, F.lit(0.0))).otherwise(0.0)
        gone = F.when(t["q"] > 0, 0.0).otherwise(sold)
        return F.struct(q.alias("q"), (share * a["a"]).alias("a"), (share * a["b"] + paid).alias("b"), (a["g"] - gone * a["a"]).alias("g"), (a["d"] + gone * (t["p"] - a["b"])).alias("d"),
                        (a["n"] + F.when((t["q"] <= 0) & (q == 0) & (sold > 0), 1).otherwise(0)).alias("n"))

    unit = [F.lit(1.0).alias("a"), F.lit(0.0).alias("b"), F.lit(0.0).alias("g"), F.lit(0.0).alias("d"), F.lit(0).alias("n")]
    maps = blocks.join(held, [*keys, "_block"]).withColumn("_m", F.aggregate("_rows", F.struct(F.col("_held").alias("q"), *unit), step)).select(*keys, "_block", "_m")
    for _ in range(2):
        grouped = maps.groupBy(*keys, F.expr(f"_block div {block}").alias("_block")).agg(F.sort_array(F.collect_list(F.struct("_block", "_m"))).alias("_l"))
        maps = grouped.select(*keys, "_block", F.struct(F.element_at("_l", -1)["_m"]["q"].alias("q"), _composed(F.transform("_l", lambda x: x["_m"]), F.struct(*unit)).alias("f")).alias("_m"))
        maps = maps.select(*keys, "_block", F.struct("_m.q", "_m.f.*").alias("_m"))
    last = maps.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("_block", "_m"))).alias("_l"))
    out = last.select(*keys, F.element_at("_l", -1)["_m"]["q"].alias("q"), _composed(F.transform("_l", lambda x: x["_m"]), F.struct(*unit)).alias("f"))
    return out.select(*keys, F.col("q").alias("quantity"), F.col("f.b").alias("average_cost"), F.col("f.d").alias("realized_pnl"), F.col("f.n").alias("closed_positions"))


def first_exits(positions: DataFrame, bars: DataFrame, stop: float, profit: float, trail: float, max_bars: int, prefer: str = "stop") -> DataFrame:
    """The first bar after entry at which an exit rule fires, the rule chosen within the bar, and the conflicts.

    ``positions``: position_id, symbol, entry_date, entry_price. The trailing
    anchor is the highest price since entry, this bar's included.
    """
    b = bars.select("symbol", "date", "high", "low", "close", F.row_number().over(Window.partitionBy("symbol").orderBy("date")).alias("_bar"))
    p = asof_backward(positions.select("position_id", "symbol", "entry_date", "entry_price"), b, ["symbol"], "entry_date", "date", ["_bar"])
    p = p.withColumn("_entry", F.coalesce("_bar", F.lit(0))).drop("_bar")
    # the time rule fires at max_bars, so only so many bars can matter: they lie in two blocks of that length
    p = p.withColumn("_block", F.explode(F.sequence(F.expr(f"(_entry + 1) div {max_bars}"), F.expr(f"(_entry + {max_bars}) div {max_bars}"))))
    j = p.join(b.withColumn("_block", F.expr(f"_bar div {max_bars}")), ["symbol", "_block"]).withColumn("held", F.col("_bar") - F.col("_entry"))
    j = j.where(F.col("held").between(1, max_bars))
    w = Window.partitionBy("position_id").orderBy("date").rowsBetween(Window.unboundedPreceding, 0)
    j = j.withColumn("anchor", F.greatest(F.max("high").over(w), F.col("entry_price")))
    e = F.col("entry_price")
    levels = {"stop": (F.col("low") <= e * (1 - stop), e * (1 - stop)), "profit": (F.col("high") >= e * (1 + profit), e * (1 + profit)),
              "trail": (F.col("low") <= F.col("anchor") * (1 - trail), F.col("anchor") * (1 - trail)), "time": (F.col("held") >= max_bars, F.col("close"))}
    order = ["stop", "profit", "trail", "time"] if prefer == "stop" else ["profit", "stop", "trail", "time"]
    fired = F.array(*[F.when(levels[k][0], F.struct(F.lit(i).alias("i"), F.lit(k).alias("rule"), levels[k][1].alias("price"))) for i, k in enumerate(order)])
    j = j.withColumn("fired", F.filter(fired, lambda x: x.isNotNull())).where(F.size("fired") > 0)
    first = j.groupBy("position_id").agg(F.min_by(F.struct("date", "held", "fired"), "date").alias("x"))
    return first.select("position_id", F.col("x.date").alias("exit_date"), F.col("x.held").alias("bars_held"), F.col("x.fired")[0]["rule"].alias("rule"),
                        F.col("x.fired")[0]["price"].alias("price"), (F.size("x.fired") - 1).alias("conflicts"))
