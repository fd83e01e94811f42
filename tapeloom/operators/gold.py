"""The gold market table: every feature of a bar in one chain over one exchange by symbol."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapeloom.functions.nulls import r6
from tapeloom.operators import candles, market, structure
from tapeloom.session import stored

#: What pivots leave behind for the features made of them; no part of the table.
_WORK = ("bar", "pivot_high", "pivot_low", "pivot_high_atr", "pivot_low_atr")


def gold_market(bars: DataFrame, zones: bool = True) -> DataFrame:
    """Base, structure, candlestick, Heikin-Ashi and Ichimoku features of daily bars, a row per (symbol, date).

    Rows are dealt by symbol once and sorted by date; every window of every
    feature finds them so (that of the periods before sorts them by period).
    Support and resistance alone need more: the table so far is written, zones
    are replayed from its pivots, a few of the rows, and their states are joined
    back by blocks of bars. ``zones`` false leaves them out. The average true
    range is rounded once, as the base features round it. A symbol's history is
    one task's sort.
    """
    g = market.market_features(bars.repartition("symbol"))
    g = candles.candlestick_patterns(g.drop("atr_14d")).withColumn("atr_14d", r6(F.col("atr_14d")))
    g = candles.heikin_ashi_ichimoku(g)
    g = structure.liquidity(structure.channels(structure.prior_periods(g)))
    g = structure.swings(structure.confirmed_pivots(g))
    g = structure.zones_and_sweeps(stored(g, "gold-bars")) if zones else g
    return g.drop(*_WORK)
