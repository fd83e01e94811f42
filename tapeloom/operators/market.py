"""Per-symbol base features of daily bars: one shuffle by symbol serves them all."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapeloom.functions.frames import Rolling
from tapeloom.functions.nulls import flag, r6, safe_div

RETURN_DAYS = (1, 5, 20, 60)
AVERAGES = (20, 50, 200)


def true_range(high: Column, low: Column, prev_close: Column) -> Column:
    """Largest of the bar's range and its distances to the close before; nulls are passed over."""
    return F.greatest(high - low, F.abs(high - prev_close), F.abs(low - prev_close))


def share_at_most(x: Column, frame) -> Column:
    """Share of the frame's values that are at most the current one; null for a null."""
    values = F.collect_list(x).over(frame)
    return F.when(x.isNotNull(), F.size(F.filter(values, lambda v: v <= x)) / F.size(values))


def market_features(bars: DataFrame) -> DataFrame:
    """Returns, momentum, volatility, drawdown, range, averages, crosses and volume features.

    ``bars``: symbol, date, open, high, low, close, volume and, if present,
    dividend_amount and split_coefficient. Windows need all their rows; flags
    are 0 where an operand is null, but the two event flags stay null.
    """
    r = Rolling()
    c, h, low, v = F.col("close"), F.col("high"), F.col("low"), F.col("volume")
    have = set(bars.columns)
    padded = r.filled(c)
    a = bars.withColumns({
        "_padded": padded,
        "_prev_close": r.lag(c),
        "_delta": c - r.lag(c),
    })
    p = F.col("_padded")
    a = a.withColumns({
        **{f"return_{n}d": p / F.nullif(r.lag(p, n), F.lit(0.0)) - 1 for n in RETURN_DAYS},
        "_gain": F.when(F.col("_delta").isNotNull(), F.greatest(F.col("_delta"), F.lit(0.0))),
        "_loss": F.when(F.col("_delta").isNotNull(), F.greatest(-F.col("_delta"), F.lit(0.0))),
        "true_range": true_range(h, low, F.col("_prev_close")),
        "rolling_max_252d": F.max(c).over(r.frame(252)),
        "range_close": safe_div(h - low, c),
        "range_20": safe_div(r.full(F.max, h, 20) - r.full(F.min, low, 20), c),
        "is_dividend_day": F.when(F.col("dividend_amount").isNotNull(), (F.col("dividend_amount") != 0).cast("int"))
        if "dividend_amount" in have else F.lit(None).cast("int"),
        "is_split_day": F.when(F.col("split_coefficient").isNotNull(), (F.col("split_coefficient") != 1).cast("int"))
        if "split_coefficient" in have else F.lit(None).cast("int"),
        "_v_mean": r.mean(v, 20),
        "_v_std": r.std(v, 20),
        "volume_pct_rank_252d": share_at_most(v, r.frame(252)),
        **{f"sma_{n}d": r.mean(c, n) for n in AVERAGES},
        "_c_std": r.std(c, 20),
    })
    one = F.col("return_1d")
    gain, loss = r.mean(F.col("_gain"), 14), r.mean(F.col("_loss"), 14)
    a = a.withColumns({"_g": gain, "_l": loss})
    g, lo = F.col("_g"), F.col("_l")
    a = a.withColumns({
        "rsi_14d": r6(F.when((lo == 0) & (g > 0), 100.0).when((g == 0) & (lo > 0), 0.0).otherwise(100 - 100 / (1 + safe_div(g, lo)))),
        "vol_20d": r6(r.std(one, 20)),
        "vol_60d": r6(r.std(one, 60)),
        "drawdown_1y": c / F.nullif(F.col("rolling_max_252d"), F.lit(0.0)) - 1,
        "atr_14d": r.mean(F.col("true_range"), 14),
        "compression_score": share_at_most(F.col("range_20"), r.frame(252)),
        "volume_z_20d": r6(safe_div(v - F.col("_v_mean"), F.col("_v_std"))),
        "bb_width_20d": r6(safe_div(4 * F.col("_c_std"), F.col("sma_20d"))),
        "sma_20_gt_sma_50": flag(F.col("sma_20d") > F.col("sma_50d")),
        "sma_50_gt_sma_200": flag(F.col("sma_50d") > F.col("sma_200d")),
        "above_sma_50": flag(c > F.col("sma_50d")),
        "trend_50_200": r6(safe_div(F.col("sma_50d"), F.col("sma_200d")) - 1),
    })
    crosses = {}
    for x in ("sma_20_gt_sma_50", "sma_50_gt_sma_200"):
        step = F.col(x) - F.coalesce(r.lag(F.col(x)), F.col(x))
        short, long = x.split("_gt_")
        crosses[f"{short}_crosses_above_{long}"] = flag(step == 1)
        crosses[f"{short}_crosses_below_{long}"] = flag(step == -1)
    a = a.withColumns({**crosses, "gap_atr": r6(safe_div(F.abs(F.col("open") - F.col("_prev_close")), F.col("atr_14d")))})
    a = a.withColumns({"atr_14d": r6(F.col("atr_14d")), **{f"sma_{n}d": r6(F.col(f"sma_{n}d")) for n in AVERAGES}})
    return a.drop(*[x for x in a.columns if x.startswith("_")])
