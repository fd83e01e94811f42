"""Candlestick, Heikin-Ashi and Ichimoku queries on region-daily bars."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tapeloom.operators import candles
from tapeloom.plans.fixtures import BD, daily_bars
from tapeloom.plans.sqltext import W, div, flag, full, lag, r6

PATTERNS = {
    "doji": "btr <= 0.05",
    "spinning_top": "btr > 0.05 AND btr <= 0.30 AND us >= 0.5 * nb AND ls >= 0.5 * nb",
    "bullish_marubozu": "c0 > o0 AND btr >= 0.90 AND utr <= 0.05 AND ltr <= 0.05",
    "bearish_marubozu": "c0 < o0 AND btr >= 0.90 AND utr <= 0.05 AND ltr <= 0.05",
    "star_gap_up": "btr <= 0.30 AND lo0 > hi1 + g01",
    "star_gap_down": "btr <= 0.30 AND hi0 < lo1 - g01",
    "star": "btr <= 0.30 AND (lo0 > hi1 + g01 OR hi0 < lo1 - g01)",
    "hammer": "btr <= 0.30 AND ls >= 2.0 * nb AND us <= 0.25 * nb AND c1 < c4",
    "hanging_man": "btr <= 0.30 AND ls >= 2.0 * nb AND us <= 0.25 * nb AND c1 > c4",
    "inverted_hammer": "btr <= 0.30 AND us >= 2.0 * nb AND ls <= 0.25 * nb AND c1 < c4",
    "shooting_star": "btr <= 0.30 AND us >= 2.0 * nb AND ls <= 0.25 * nb AND c1 > c4",
    "dragonfly_doji": "btr <= 0.05 AND utr <= 0.10 AND ltr >= 0.60 AND c1 < c4",
    "gravestone_doji": "btr <= 0.05 AND ltr <= 0.10 AND utr >= 0.60 AND c1 > c4",
    "bullish_spinning_top": "btr > 0.05 AND btr <= 0.30 AND us >= 0.5 * nb AND ls >= 0.5 * nb AND c1 < c4",
    "bearish_spinning_top": "btr > 0.05 AND btr <= 0.30 AND us >= 0.5 * nb AND ls >= 0.5 * nb AND c1 > c4",
    "bullish_engulfing": "c2 < c5 AND c1 < o1 AND c0 > o0 AND o0 <= c1 AND c0 >= o1",
    "bearish_engulfing": "c2 > c5 AND c1 > o1 AND c0 < o0 AND o0 >= c1 AND c0 <= o1",
    "bullish_harami": "c2 < c5 AND c1 < o1 AND c0 > o0 AND lo0 > lo1 AND hi0 < hi1",
    "bearish_harami": "c2 > c5 AND c1 > o1 AND c0 < o0 AND lo0 > lo1 AND hi0 < hi1",
    "piercing_line": "c2 < c5 AND c1 < o1 AND sh1 >= 0.6 AND c0 > o0 AND o0 < c1 AND c0 > (o1 + c1) / 2 AND c0 < o1",
    "dark_cloud_line": "c2 > c5 AND c1 > o1 AND sh1 >= 0.6 AND c0 < o0 AND o0 > c1 AND c0 < (o1 + c1) / 2 AND c0 > o1",
    "tweezer_bottom": "c2 < c5 AND abs(l1 - l0) <= eq AND c1 < o1 AND c0 > o0",
    "tweezer_top": "c2 > c5 AND abs(h1 - h0) <= eq AND c1 > o1 AND c0 < o0",
    "bullish_kicker": "c2 < c5 AND c1 < o1 AND c0 > o0 AND lo0 > hi1 + g01 AND sh0 >= 0.6",
    "bearish_kicker": "c2 > c5 AND c1 > o1 AND c0 < o0 AND hi0 < lo1 - g01 AND sh0 >= 0.6",
    "morning_star": "c3 < c6 AND c2 < o2 AND sh2 >= 0.6 AND sh1 <= 0.30 AND c0 > o0 AND sh0 >= 0.6 AND c0 > (o2 + c2) / 2",
    "morning_doji_star": "c3 < c6 AND c2 < o2 AND sh2 >= 0.6 AND sh1 <= 0.05 AND c0 > o0 AND sh0 >= 0.6 AND c0 > (o2 + c2) / 2",
    "evening_star": "c3 > c6 AND c2 > o2 AND sh2 >= 0.6 AND sh1 <= 0.30 AND c0 < o0 AND sh0 >= 0.6 AND c0 < (o2 + c2) / 2",
    "evening_doji_star": "c3 > c6 AND c2 > o2 AND sh2 >= 0.6 AND sh1 <= 0.05 AND c0 < o0 AND sh0 >= 0.6 AND c0 < (o2 + c2) / 2",
    "bullish_abandoned_baby": "c3 < c6 AND c2 < o2 AND sh1 <= 0.05 AND hi1 < lo2 - g12 AND lo0 > hi1 + g01 AND c0 > o0",
    "bearish_abandoned_baby": "c3 > c6 AND c2 > o2 AND sh1 <= 0.05 AND lo1 > hi2 + g12 AND hi0 < lo1 - g01 AND c0 < o0",
    "three_white_soldiers": "c2 > o2 AND c1 > o1 AND c0 > o0 AND c0 > c1 AND c1 > c2 AND o1 BETWEEN lo2 AND hi2 AND o0 BETWEEN lo1 AND hi1",
    "three_black_crows": "c2 < o2 AND c1 < o1 AND c0 < o0 AND c0 < c1 AND c1 < c2 AND o1 BETWEEN lo2 AND hi2 AND o0 BETWEEN lo1 AND hi1",
    "bullish_three_line_strike": "c4 > c7 AND c3 > o3 AND c2 > o2 AND c1 > o1 AND c1 > c2 AND c2 > c3 AND c0 < o0 AND o0 >= c1 AND c0 < o3",
    "bearish_three_line_strike": "c4 < c7 AND c3 < o3 AND c2 < o2 AND c1 < o1 AND c1 < c2 AND c2 < c3 AND c0 > o0 AND o0 <= c1 AND c0 > o3",
}
LATER = {
    "three_inside_up": "c3 < c6 AND c2 < o2 AND sh2 >= 0.6 AND p_bullish_harami = 1 AND c0 > o0 AND c0 > o2",
    "three_outside_up": "c3 < c6 AND c2 < o2 AND p_bullish_engulfing = 1 AND c0 > o0 AND c0 > c1",
    "three_inside_down": "c3 > c6 AND c2 > o2 AND sh2 >= 0.6 AND p_bearish_harami = 1 AND c0 < o0 AND c0 < o2",
    "three_outside_down": "c3 > c6 AND c2 > o2 AND p_bearish_engulfing = 1 AND c0 < o0 AND c0 < c1",
}


def _sql() -> str:
    lags = ", ".join(
        [f"{lag(x, k) if k else x} AS {n}{k}" for n, x in (("o", "open"), ("h", "high"), ("l", "low"), ("c", "close")) for k in range(4)]
        + [f"{lag('close', k)} AS c{k}" for k in range(4, 8)] + [f"{lag('gap', k) if k else 'gap'} AS gp{k}" for k in range(3)]
    )
    bodies = ", ".join(f"greatest(o{k}, c{k}) AS hi{k}, least(o{k}, c{k}) AS lo{k}, {div(f'abs(c{k} - o{k})', f'h{k} - l{k}')} AS sh{k}" for k in range(3))
    first = ", ".join(f"{flag(v)} AS pat_{k}" for k, v in PATTERNS.items())
    prev = ", ".join(f"lag(pat_{k}) OVER ({W}) AS p_{k}" for k in ("bullish_harami", "bearish_harami", "bullish_engulfing", "bearish_engulfing"))
    later = ", ".join(f"{flag(v)} AS pat_{k}" for k, v in LATER.items())
    names = ", ".join(f"pat_{k}" for k in PATTERNS)
    return f"""
WITH {BD}, a AS (
  SELECT *, greatest(high - low, 0.0) AS range, abs(close - open) AS body, {flag('close > open')} AS is_bull, {flag('close < open')} AS is_bear,
    high - greatest(open, close) AS us, least(open, close) - low AS ls,
    greatest(high - low, abs(high - {lag('close')}), abs(low - {lag('close')})) AS true_range FROM bars
), b AS (
  SELECT *, {div('body', 'range')} AS btr, {div('us', 'range')} AS utr, {div('ls', 'range')} AS ltr, nullif(body, 0.0) AS nb, {r6(full('avg', 'true_range', 14))} AS atr FROM a
), c AS (
  SELECT *, greatest(0.05 * coalesce(atr, 0.0), 0.001 * abs(close), 0.01) AS eq, greatest(0.01 * coalesce(atr, 0.0), 0.0005 * abs(close), 0.0) AS gap FROM b
), d AS (SELECT *, {lags} FROM c
), e AS (SELECT *, {bodies}, greatest(gp0, gp1) AS g01, greatest(gp1, gp2) AS g12 FROM d
), f AS (SELECT *, {first} FROM e
), g AS (SELECT *, {prev} FROM f)
SELECT symbol, date, open, high, low, close, volume, range, body, is_bull, is_bear, us AS upper_shadow, ls AS lower_shadow, btr AS body_to_range,
  utr AS upper_to_range, ltr AS lower_to_range, true_range, atr AS atr_14d, {names}, {later} FROM g
"""


def candlesticks(spark: SparkSession, d: str) -> DataFrame:
    """C1-C44."""
    return candles.candlestick_patterns(daily_bars(spark, d))


def heikin_ashi(spark: SparkSession, d: str) -> DataFrame:
    """H1-H5."""
    return candles.heikin_ashi_ichimoku(daily_bars(spark, d))


def _mid(n: int) -> str:
    return f"(({full('max', 'high', n)}) + ({full('min', 'low', n)})) / 2.0"


HA_SQL = f"""
WITH RECURSIVE {BD}, n AS (
  SELECT *, row_number() OVER ({W}) AS rn, (open + high + low + close) / 4.0 AS hc FROM bars
), r AS (
  SELECT symbol, rn, (open + close) / 2.0 AS ho, hc FROM n WHERE rn = 1
  UNION ALL SELECT n.symbol, n.rn, (r.ho + r.hc) / 2.0, n.hc FROM r JOIN n ON n.symbol = r.symbol AND n.rn = r.rn + 1
), i AS (
  SELECT *, {_mid(9)} AS t, {_mid(26)} AS k, {_mid(52)} AS sb, {lag('close', 26)} AS ch FROM n
), s AS (SELECT *, (t + k) / 2.0 AS sa FROM i)
SELECT s.symbol, date, open, high, low, close, volume, s.hc AS ha_close, ho AS ha_open,
  greatest(high, ho, s.hc) AS ha_high, least(low, ho, s.hc) AS ha_low,
  t AS ichimoku_tenkan_sen_9, k AS ichimoku_kijun_sen_26, sb AS ichimoku_senkou_span_b, ch AS ichimoku_chikou_span_26, sa AS ichimoku_senkou_span_a,
  {lag('sa', 26, w='PARTITION BY s.symbol ORDER BY date')} AS ichimoku_senkou_span_a_26, {lag('sb', 26, w='PARTITION BY s.symbol ORDER BY date')} AS ichimoku_senkou_span_b_26
FROM s JOIN r ON r.symbol = s.symbol AND r.rn = s.rn
"""


def register_all(register) -> None:
    register("candlesticks", candlesticks, _sql())
    register("heikin_ashi_ichimoku", heikin_ashi, HA_SQL)
