"""Market structure per symbol: prior periods, channels, pivots, zones, swings, sweeps, liquidity."""

from __future__ import annotations

import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapeloom.functions.frames import Rolling, series
from tapeloom.functions.nulls import finite, flag, r6, safe_div

CHANNELS = (20, 55)
PIVOT_SPAN = 3
#: A zone's half width is the largest of a share of its price, of its ATR, and a floor.
ZONE_PRICE, ZONE_ATR, ZONE_FLOOR = 0.0075, 0.35, 0.01
RECENCY_BARS = 63.0
BLOCK_BARS = 64
CONFIRM_BARS = 3
FIB = (0.236, 0.382, 0.5, 0.618, 0.786)


def prior_periods(bars: DataFrame) -> DataFrame:
    """Adds the distances to the high and low of the present week and month before, in ATRs.

    Weeks end on Friday; the period before is the last one that has bars.
    """
    out = bars
    for name, key in (("week", F.date_trunc("week", F.date_add("date", 2))), ("month", F.date_trunc("month", "date"))):
        out = out.withColumn("_p", F.unix_date(F.to_date(key)))
        inside, before = Window.partitionBy("symbol", "_p"), Window.partitionBy("symbol").orderBy("_p").rangeBetween(Window.unboundedPreceding, -1)
        out = out.withColumns({"_h": F.max("high").over(inside), "_l": F.min("low").over(inside)})
        # of the rows before this period all of the last one tell the same
        out = out.withColumns({"_ph": F.last("_h").over(before), "_pl": F.last("_l").over(before)}).withColumns({
            f"dist_prev_{name}_high_atr": safe_div(F.col("_ph") - F.col("close"), F.col("atr_14d")),
            f"dist_prev_{name}_low_atr": safe_div(F.col("close") - F.col("_pl"), F.col("atr_14d")),
        }).drop("_p", "_h", "_l", "_ph", "_pl")
    return out


def channels(bars: DataFrame) -> DataFrame:
    """Adds the Donchian channels of the bars before this one, and what the close does with them."""
    r = Rolling()
    c, atr, prev = F.col("close"), F.col("atr_14d"), r.lag(F.col("close"))
    out = bars.withColumns({
        **{f"donchian_high_{n}d": r.full(F.max, F.col("high"), n, -1) for n in CHANNELS},
        **{f"donchian_low_{n}d": r.full(F.min, F.col("low"), n, -1) for n in CHANNELS}, "_prev": prev,
    })
    more = {}
    for n in CHANNELS:
        hi, lo = F.col(f"donchian_high_{n}d"), F.col(f"donchian_low_{n}d")
        more |= {
            f"dist_donchian_high_{n}d_atr": safe_div(hi - c, atr), f"dist_donchian_low_{n}d_atr": safe_div(c - lo, atr),
            f"above_donchian_high_{n}d": flag(c > hi), f"below_donchian_low_{n}d": flag(c < lo),
            f"crosses_above_donchian_high_{n}d": flag((c > hi) & (F.col("_prev") <= hi)),
            f"crosses_below_donchian_low_{n}d": flag((c < lo) & (F.col("_prev") >= lo)),
            f"position_in_{n}d_range": safe_div(c - lo, hi - lo),
        }
    return out.withColumns(more).drop("_prev")


def confirmed_pivots(bars: DataFrame) -> DataFrame:
    """Adds ``bar`` (0-based), and the pivots that become known at this bar, with the ATR at the pivot.

    A pivot is the extreme of the seven bars around it; it is known three bars later.
    """
    r, w = Rolling(), series()
    around = w.rowsBetween(-PIVOT_SPAN, PIVOT_SPAN)
    n = 2 * PIVOT_SPAN + 1
    out = bars.withColumn("bar", (F.row_number().over(w) - 1).cast("int"))
    marks = {}
    for side, x, agg in (("high", F.col("high"), F.max), ("low", F.col("low"), F.min)):
        is_pivot = (F.count(x).over(around) == n) & (x == agg(x).over(around))
        marks[f"_m_{side}"] = F.when(is_pivot, x)
        marks[f"_a_{side}"] = F.when(is_pivot, F.col("atr_14d"))
    out = out.withColumns(marks)
    return out.withColumns({
        **{f"pivot_{s}": r.lag(F.col(f"_m_{s}"), PIVOT_SPAN) for s in ("high", "low")},
        **{f"pivot_{s}_atr": r.lag(F.col(f"_a_{s}"), PIVOT_SPAN) for s in ("high", "low")},
    }).drop(*marks)


def swings(bars: DataFrame) -> DataFrame:
    """Adds the direction, anchors and retracement levels of the last swing, from :func:`confirmed_pivots`."""
    past = series().rowsBetween(Window.unboundedPreceding, 0)
    last = {
        s: F.last(F.when(F.col(f"pivot_{s}").isNotNull(), F.struct((F.col("bar") - PIVOT_SPAN).alias("at"), F.col(f"pivot_{s}").alias("px"))), True).over(past)
        for s in ("low", "high")
    }
    out = bars.withColumns({"_lo": last["low"], "_hi": last["high"]})
    lo, hi = F.col("_lo.px"), F.col("_hi.px")
    ok = F.coalesce(hi > lo, F.lit(False))
    way = F.when(ok & (F.col("_lo.at") < F.col("_hi.at")), 1).when(ok & (F.col("_hi.at") < F.col("_lo.at")), -1).otherwise(0)
    out = out.withColumn("fib_swing_direction", way)
    d, c, atr = F.col("fib_swing_direction"), F.col("close"), F.col("atr_14d")
    names = [f"fib_level_{round(f * 1000):03d}" for f in FIB]
    out = out.withColumns({
        "fib_anchor_low": F.when(d != 0, lo), "fib_anchor_high": F.when(d != 0, hi),
        **{x: F.when(d == 1, hi - F.lit(f) * (hi - lo)).when(d == -1, lo + F.lit(f) * (hi - lo)) for x, f in zip(names, FIB, strict=True)},
    })
    # ties go to the shallower level
    ranked = F.array_min(F.array(*[F.struct(F.abs(F.col(x) - c).alias("d"), F.lit(i).alias("i"), F.col(x).alias("v")) for i, x in enumerate(names)]))
    out = out.withColumn("fib_nearest_level", F.when((d != 0) & c.isNotNull(), ranked["v"]))
    a, b = F.col(names[1]), F.col(names[3])
    return out.withColumns({
        "fib_nearest_dist_atr": safe_div(c - F.col("fib_nearest_level"), atr),
        "fib_in_value_zone": flag((c >= F.least(a, b)) & (c <= F.greatest(a, b))),
    }).drop("_lo", "_hi")


def liquidity(bars: DataFrame) -> DataFrame:
    """Adds dollar volume, Amihud illiquidity, their z-scores, and a stress score. Needs return_1d and gap_atr."""
    r = Rolling()
    value = F.col("close") * F.col("volume")
    impact = F.abs(F.col("return_1d")) / F.greatest(value, F.lit(1.0))
    out = bars.withColumns({"_v": value, "_i": F.when(value.isNotNull(), impact)})
    out = out.withColumns({"_dv": r.mean(F.col("_v"), 20), "_am": r.mean(F.col("_i"), 20)})
    out = out.withColumns({"_dz": r.zscore(F.col("_dv"), 252), "_az": r.zscore(F.col("_am"), 252)})
    return out.withColumns({
        "dollar_volume_20d": F.col("_dv"), "amihud_20d": F.col("_am"),
        "amihud_z_252d": r6(finite(F.col("_az"))), "dollar_volume_z_252d": r6(finite(F.col("_dz"))),
        "liquidity_stress_score": r6(F.col("_az") - F.col("_dz") + F.coalesce(F.col("gap_atr"), F.lit(0.0))),
    }).drop("_v", "_i", "_dv", "_am", "_dz", "_az")


def zone_half_width(price: float, atr: float | None) -> float:
    wide = abs(atr) * ZONE_ATR if atr is not None and math.isfinite(atr) else 0.0
    return max(abs(price) * ZONE_PRICE, wide, ZONE_FLOOR)


def zone_versions(pivots: DataFrame) -> DataFrame:
    """Every state of every zone, from pivots alone: ``symbol, side, zone, bar_from, bar_to, mid, low, high, touches, last_touch, n_bars``.

    ``pivots``: symbol, side, bar, price, atr, n_bars (of the symbol). A pivot joins the nearest zone
    that its band reaches, the older one at equal distance, or begins a new one.
    ``bar_to`` (exclusive) is null for a state that lasts. Bars never reach
    Python; a symbol's pivots are at most a seventh of them.
    """

    def replay(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("bar")
        zones: list[dict] = []
        out: list[dict] = []
        for row in pdf.itertuples(index=False):
            half = zone_half_width(row.price, None if pd.isna(row.atr) else row.atr)
            near = [z for z in zones if z["low"] - half <= row.price <= z["high"] + half]
            at = int(row.bar)
            if near:
                z = min(near, key=lambda x: abs(x["total"] / x["touches"] - row.price))
                z["state"]["bar_to"] = at
                z.update(total=z["total"] + row.price, touches=z["touches"] + 1, low=min(z["low"], row.price - half), high=max(z["high"], row.price + half))
            else:
                z = {"number": len(zones), "total": row.price, "touches": 1, "low": row.price - half, "high": row.price + half}
                zones.append(z)
            z["state"] = {
                "symbol": row.symbol, "side": row.side, "zone": z["number"], "bar_from": at, "bar_to": None, "mid": z["total"] / z["touches"],
                "low": z["low"], "high": z["high"], "touches": z["touches"], "last_touch": at, "n_bars": int(row.n_bars),
            }
            out.append(z["state"])
        frame = pd.DataFrame(out, columns=["symbol", "side", "zone", "bar_from", "bar_to", "mid", "low", "high", "touches", "last_touch", "n_bars"])
        frame["bar_to"] = frame["bar_to"].astype("Int32")
        return frame

    schema = "symbol string, side string, zone int, bar_from int, bar_to int, mid double, low double, high double, touches int, last_touch int, n_bars int"
    return pivots.groupBy("symbol", "side").applyInPandas(replay, schema)


def _chosen(bars: DataFrame, zones: DataFrame) -> DataFrame:
    """The nearest zone of each side for every bar; strength breaks ties, then age of the zone.

    Bars and states meet by blocks of bars, so a bar meets the states that live
    in its block, not those of the whole history.
    """
    parts = ("mid", "low", "high", "touches", "last_touch")
    z = zones.withColumn("_last", F.coalesce("bar_to", "n_bars") - 1).where(F.col("bar_from") <= F.col("_last"))
    z = z.select("symbol", "side", "zone", "bar_from", "_last", *[F.col(x).alias(f"z_{x}") for x in parts],
                 F.explode(F.sequence(F.expr(f"bar_from div {BLOCK_BARS}"), F.expr(f"_last div {BLOCK_BARS}"))).alias("_block"))
    b = bars.select("symbol", "bar", F.col("close").alias("c"), F.expr(f"bar div {BLOCK_BARS}").alias("_block"))
    j = b.join(z, ["symbol", "_block"]).where(F.col("bar").between(F.col("bar_from"), F.col("_last")))
    inside = (F.col("c") >= F.col("z_low")) & (F.col("c") <= F.col("z_high"))
    beyond = F.when(F.col("side") == "support", F.col("z_mid") <= F.col("c")).otherwise(F.col("z_mid") >= F.col("c"))
    strength = F.col("z_touches") * F.exp(-(F.col("bar") - F.col("z_last_touch")) / RECENCY_BARS)
    j = j.where(inside | beyond).withColumn("strength", strength)
    pick = F.struct(F.abs(F.col("c") - F.col("z_mid")), -F.col("strength"), F.col("zone"))
    state = F.struct("z_mid", "z_low", "z_high", "z_touches", "strength")
    sides = ("support", "resistance")
    best = j.groupBy("symbol", "_block", "bar").agg(*[F.min_by(state, F.when(F.col("side") == s, pick)).alias(s) for s in sides])
    return best.select(
        "symbol", "bar", *[F.col(f"{s}.{a}").alias(f"sr_{s}_1_{b}") for s in sides
                           for a, b in (("z_mid", "mid"), ("z_low", "low"), ("z_high", "high"), ("z_touches", "touches"), ("strength", "strength"))]
    )


def zones_and_sweeps(bars: DataFrame) -> DataFrame:
    """Adds nearest support and resistance, breaks, sweeps and their confirmation.

    ``bars`` come from :func:`confirmed_pivots`.
    """
    pivots = None
    bars = bars.withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy("symbol")).cast("int"))
    for side, x in (("support", "low"), ("resistance", "high")):
        one = bars.where(F.col(f"pivot_{x}").isNotNull()).select(
            "symbol", F.lit(side).alias("side"), "bar", F.col(f"pivot_{x}").alias("price"), F.col(f"pivot_{x}_atr").alias("atr"), F.col("_n").alias("n_bars")
        )
        pivots = one if pivots is None else pivots.unionByName(one)
    zones = zone_versions(pivots)
    out = bars.drop("_n").join(_chosen(bars, zones), ["symbol", "bar"], "left")
    r, past = Rolling(), series().rowsBetween(Window.unboundedPreceding, 0)
    c, h, low, atr = (F.col(x) for x in ("close", "high", "low", "atr_14d"))
    sup, res = {}, {}
    for d, side in ((sup, "support"), (res, "resistance")):
        d.update({x: F.col(f"sr_{side}_1_{x}") for x in ("mid", "low", "high")})
    swept_res, swept_sup = (h > res["high"]) & (c < res["high"]), (low < sup["low"]) & (c > sup["low"])
    over, under = F.greatest(h - res["high"], F.lit(0.0)), F.greatest(sup["low"] - low, F.lit(0.0))
    over, under = F.when(res["high"].isNotNull(), over), F.when(sup["low"].isNotNull(), under)
    out = out.withColumns({
        "_prev": r.lag(c), "_over": over, "_under": under, "_row": F.col("bar"),
        "swept_sr_resistance_1": flag(swept_res), "swept_sr_support_1": flag(swept_sup),
    })
    prev = F.col("_prev")
    out = out.withColumns({
        **{f"sr_{s}_1_touches": F.coalesce(f"sr_{s}_1_touches", F.lit(0)) for s in ("support", "resistance")},
        **{f"sr_{s}_1_strength": F.coalesce(f"sr_{s}_1_strength", F.lit(0.0)) for s in ("support", "resistance")},
        "sr_support_1_dist_atr": safe_div(c - sup["mid"], atr), "sr_resistance_1_dist_atr": safe_div(res["mid"] - c, atr),
        "sr_in_support_1_zone": flag((c >= sup["low"]) & (c <= sup["high"])), "sr_in_resistance_1_zone": flag((c >= res["low"]) & (c <= res["high"])),
        "sr_breaks_above_resistance_1": flag((c > res["high"]) & (prev <= res["high"])), "sr_breaks_below_support_1": flag((c < sup["low"]) & (prev >= sup["low"])),
        "sr_zone_position": F.when(res["mid"] > sup["mid"], (c - sup["mid"]) / (res["mid"] - sup["mid"])),
        "bearish_sweep_magnitude_atr": safe_div(F.col("_over"), atr), "bullish_sweep_magnitude_atr": safe_div(F.col("_under"), atr),
        "bearish_sweep_reclaim_frac": F.when(F.col("_over") > 0, (res["high"] - c) / F.col("_over")).when(res["high"].isNotNull(), 0.0),
        "bullish_sweep_reclaim_frac": F.when(F.col("_under") > 0, (c - sup["low"]) / F.col("_under")).when(sup["low"].isNotNull(), 0.0),
    })
    events = {}
    for way, mark, x in (("bearish", "swept_sr_resistance_1", low), ("bullish", "swept_sr_support_1", h)):
        hit = F.col(mark) == 1
        events[f"bars_since_{way}_sweep"] = F.col("bar") - F.last(F.when(hit, F.col("bar")), True).over(past)
        events[f"_x_{way}"] = F.last(F.when(hit, x), True).over(past)
    out = out.withColumns(events)
    return out.withColumns({
        "bearish_confirm_after_sweep": flag((F.col("bars_since_bearish_sweep") <= CONFIRM_BARS) & (c < F.col("_x_bearish"))),
        "bullish_confirm_after_sweep": flag((F.col("bars_since_bullish_sweep") <= CONFIRM_BARS) & (c > F.col("_x_bullish"))),
    }).drop("_prev", "_over", "_under", "_row", "_x_bearish", "_x_bullish")
