"""Candlestick geometry and patterns, Heikin-Ashi and Ichimoku, per symbol."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapeloom.functions.frames import Rolling, series
from tapeloom.functions.nulls import flag, r6, safe_div
from tapeloom.operators.market import true_range


@dataclass(frozen=True)
class Thresholds:
    """When a body is small or long and a shadow short; ratios to the bar's range or body."""

    trend: int = 3
    doji: float = 0.05
    spinning: float = 0.30
    long_body: float = 0.60
    marubozu: float = 0.90
    marubozu_shadow: float = 0.05
    hammer: float = 2.0
    small_shadow: float = 0.25
    gap_atr: float = 0.01
    gap_price: float = 0.0005
    gap_floor: float = 0.0


class _Bar:
    """The bar ``k`` rows back as columns."""

    def __init__(self, k: int):
        s = f"_{k}"
        self.o, self.h, self.l, self.c, self.gap = (F.col(f"_{x}{s}") for x in ("o", "h", "l", "c", "gap"))
        self.bull, self.bear = self.c > self.o, self.c < self.o
        self.top, self.bottom = F.greatest(self.o, self.c), F.least(self.o, self.c)
        self.mid = (self.o + self.c) / 2
        self.share = safe_div(F.abs(self.c - self.o), self.h - self.l)


def _geometry(bars: DataFrame) -> DataFrame:
    o, h, low, c = (F.col(x) for x in ("open", "high", "low", "close"))
    r = Rolling()
    out = bars.withColumns({
        "range": F.greatest(h - low, F.lit(0.0)), "body": F.abs(c - o), "is_bull": flag(c > o), "is_bear": flag(c < o),
        "upper_shadow": h - F.greatest(o, c), "lower_shadow": F.least(o, c) - low, "true_range": true_range(h, low, r.lag(c)),
    })
    return out.withColumns({
        "body_to_range": safe_div(F.col("body"), F.col("range")), "upper_to_range": safe_div(F.col("upper_shadow"), F.col("range")),
        "lower_to_range": safe_div(F.col("lower_shadow"), F.col("range")), "_atr": r6(r.mean(F.col("true_range"), 14)),
    })


def candlestick_patterns(bars: DataFrame, t: Thresholds = Thresholds()) -> DataFrame:
    """Adds geometry and 0/1 patterns ``pat_*``; a pattern with a null operand is 0.

    Bars up to seven rows back are fetched in one window stage; patterns that
    look at other patterns a bar back come in a second.
    """
    r = Rolling()
    g = _geometry(bars)
    c, atr = F.col("close"), F.coalesce(F.col("_atr"), F.lit(0.0))
    price = F.coalesce(F.abs(c), F.lit(0.0))
    g = g.withColumns({
        "_eq": F.greatest(0.05 * atr, 0.001 * price, F.lit(0.01)),
        "_gap": F.greatest(t.gap_atr * atr, t.gap_price * price, F.lit(t.gap_floor)),
    })
    g = g.withColumns({
        **{f"_{n}_{k}": r.lag(F.col(x), k) if k else F.col(x) for n, x in (("o", "open"), ("h", "high"), ("l", "low"), ("c", "close"), ("gap", "_gap")) for k in range(4)},
        **{f"_c_{k}": r.lag(c, k) for k in range(4, 5 + t.trend)},
    })
    b0, b1, b2, b3 = (_Bar(k) for k in range(4))
    closes = [F.col(f"_c_{k}") for k in range(5 + t.trend)]
    down = {k: closes[k] < closes[k + t.trend] for k in range(1, 5)}
    up = {k: closes[k] > closes[k + t.trend] for k in range(1, 5)}
    body, ratio = F.nullif(F.col("body"), F.lit(0.0)), F.col("body_to_range")
    upper, lower = F.col("upper_shadow"), F.col("lower_shadow")
    upper_ratio, lower_ratio = F.col("upper_to_range"), F.col("lower_to_range")
    doji, small = ratio <= t.doji, ratio <= t.spinning
    gap01, gap12 = F.greatest(b0.gap, b1.gap), F.greatest(b1.gap, b2.gap)
    spin = (ratio > t.doji) & small & (upper >= 0.5 * body) & (lower >= 0.5 * body)
    plain = (upper_ratio <= t.marubozu_shadow) & (lower_ratio <= t.marubozu_shadow) & (ratio >= t.marubozu)
    rise, fall = b0.bottom > b1.top + gap01, b0.top < b1.bottom - gap01
    hammer = small & (lower >= t.hammer * body) & (upper <= t.small_shadow * body)
    inverted = small & (upper >= t.hammer * body) & (lower <= t.small_shadow * body)
    inside = (b0.bottom > b1.bottom) & (b0.top < b1.top)
    long1, long2, long0 = b1.share >= t.long_body, b2.share >= t.long_body, b0.share >= t.long_body
    mid_small, mid_doji = b1.share <= t.spinning, b1.share <= t.doji
    within = (b1.o >= b2.bottom) & (b1.o <= b2.top) & (b0.o >= b1.bottom) & (b0.o <= b1.top)
    morning = down[3] & b2.bear & long2 & b0.bull & long0 & (b0.c > b2.mid)
    evening = up[3] & b2.bull & long2 & b0.bear & long0 & (b0.c < b2.mid)
    strike_up = up[4] & b3.bull & b2.bull & b1.bull & (b1.c > b2.c) & (b2.c > b3.c)
    strike_down = down[4] & b3.bear & b2.bear & b1.bear & (b1.c < b2.c) & (b2.c < b3.c)
    eq = F.col("_eq")
    found = {
        "doji": doji,
        "spinning_top": spin,
        "bullish_marubozu": b0.bull & plain,
        "bearish_marubozu": b0.bear & plain,
        "star_gap_up": small & rise,
        "star_gap_down": small & fall,
        "hammer": hammer & down[1],
        "hanging_man": hammer & up[1],
        "inverted_hammer": inverted & down[1],
        "shooting_star": inverted & up[1],
        "dragonfly_doji": doji & (upper_ratio <= 0.10) & (lower_ratio >= 0.60) & down[1],
        "gravestone_doji": doji & (lower_ratio <= 0.10) & (upper_ratio >= 0.60) & up[1],
        "bullish_spinning_top": spin & down[1],
        "bearish_spinning_top": spin & up[1],
        "bullish_engulfing": down[2] & b1.bear & b0.bull & (b0.o <= b1.c) & (b0.c >= b1.o),
        "bearish_engulfing": up[2] & b1.bull & b0.bear & (b0.o >= b1.c) & (b0.c <= b1.o),
        "bullish_harami": down[2] & b1.bear & b0.bull & inside,
        "bearish_harami": up[2] & b1.bull & b0.bear & inside,
        "piercing_line": down[2] & b1.bear & long1 & b0.bull & (b0.o < b1.c) & (b0.c > b1.mid) & (b0.c < b1.o),
        "dark_cloud_line": up[2] & b1.bull & long1 & b0.bear & (b0.o > b1.c) & (b0.c < b1.mid) & (b0.c > b1.o),
        "tweezer_bottom": down[2] & (F.abs(b1.l - b0.l) <= eq) & b1.bear & b0.bull,
        "tweezer_top": up[2] & (F.abs(b1.h - b0.h) <= eq) & b1.bull & b0.bear,
        "bullish_kicker": down[2] & b1.bear & b0.bull & rise & long0,
        "bearish_kicker": up[2] & b1.bull & b0.bear & fall & long0,
        "morning_star": morning & mid_small,
        "morning_doji_star": morning & mid_doji,
        "evening_star": evening & mid_small,
        "evening_doji_star": evening & mid_doji,
        "bullish_abandoned_baby": down[3] & b2.bear & mid_doji & (b1.top < b2.bottom - gap12) & (b0.bottom > b1.top + gap01) & b0.bull,
        "bearish_abandoned_baby": up[3] & b2.bull & mid_doji & (b1.bottom > b2.top + gap12) & (b0.top < b1.bottom - gap01) & b0.bear,
        "three_white_soldiers": b2.bull & b1.bull & b0.bull & (b0.c > b1.c) & (b1.c > b2.c) & within,
        "three_black_crows": b2.bear & b1.bear & b0.bear & (b0.c < b1.c) & (b1.c < b2.c) & within,
        "bullish_three_line_strike": strike_up & b0.bear & (b0.o >= b1.c) & (b0.c < b3.o),
        "bearish_three_line_strike": strike_down & b0.bull & (b0.o <= b1.c) & (b0.c > b3.o),
    }
    g = g.withColumns({f"pat_{k}": flag(v) for k, v in found.items()})
    before = {k: F.coalesce(r.lag(F.col(f"pat_{k}")), F.lit(0)) == 1 for k in ("bullish_harami", "bearish_harami", "bullish_engulfing", "bearish_engulfing")}
    g = g.withColumns({
        "pat_star": flag((F.col("pat_star_gap_up") == 1) | (F.col("pat_star_gap_down") == 1)),
        "pat_three_inside_up": flag(down[3] & b2.bear & long2 & before["bullish_harami"] & b0.bull & (b0.c > b2.o)),
        "pat_three_outside_up": flag(down[3] & b2.bear & before["bullish_engulfing"] & b0.bull & (b0.c > b1.c)),
        "pat_three_inside_down": flag(up[3] & b2.bull & long2 & before["bearish_harami"] & b0.bear & (b0.c < b2.o)),
        "pat_three_outside_down": flag(up[3] & b2.bull & before["bearish_engulfing"] & b0.bear & (b0.c < b1.c)),
    }).withColumnRenamed("_atr", "atr_14d")
    return g.drop(*[x for x in g.columns if x.startswith("_")])


#: Bars the Heikin-Ashi open looks back; older ones weigh less than 2**-64.
HA_DEPTH = 64


def heikin_ashi_ichimoku(bars: DataFrame) -> DataFrame:
    """Adds Heikin-Ashi bars and the Ichimoku lines (lagging lines look back only).

    The open is the mean of the open and close before it, from the first bar's
    middle on: a fold over at most HA_DEPTH closes. Once a close is missing all
    later opens are null.
    """
    r = Rolling()
    o, h, low, c = (F.col(x) for x in ("open", "high", "low", "close"))
    whole = series().rowsBetween(Window.unboundedPreceding, -1)
    a = bars.withColumns({"ha_close": (o + h + low + c) / 4.0, "_n": F.row_number().over(series())})
    first = F.first((o + c) / 2.0).over(series().rowsBetween(Window.unboundedPreceding, 0))
    tail = F.collect_list("ha_close").over(series().rowsBetween(-HA_DEPTH, -1))
    broken = F.coalesce(F.max(F.col("ha_close").isNull()).over(whole), F.lit(False))
    a = a.withColumns({"_seed": first, "_tail": tail, "_broken": broken})
    fold = F.aggregate("_tail", F.col("_seed"), lambda acc, x: (acc + x) / 2.0)
    a = a.withColumn("ha_open", F.when(~F.col("_broken"), F.when(F.col("_n") == 1, F.col("_seed")).otherwise(fold)))

    def middle(n: int) -> Column:
        return (r.full(F.max, h, n) + r.full(F.min, low, n)) / 2.0

    a = a.withColumns({
        "ha_high": F.when(F.col("ha_open").isNotNull(), F.greatest(h, "ha_open", "ha_close")),
        "ha_low": F.when(F.col("ha_open").isNotNull(), F.least(low, "ha_open", "ha_close")),
        "ichimoku_tenkan_sen_9": middle(9), "ichimoku_kijun_sen_26": middle(26), "ichimoku_senkou_span_b": middle(52),
        "ichimoku_chikou_span_26": r.lag(c, 26),
    })
    a = a.withColumn("ichimoku_senkou_span_a", (F.col("ichimoku_tenkan_sen_9") + F.col("ichimoku_kijun_sen_26")) / 2.0)
    a = a.withColumns({f"ichimoku_senkou_span_{x}_26": r.lag(F.col(f"ichimoku_senkou_span_{x}"), 26) for x in "ab"})
    return a.drop("_n", "_seed", "_tail", "_broken")
