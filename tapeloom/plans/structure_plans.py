"""Market-structure queries on region-daily bars."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeloom.operators import market, structure
from tapeloom.plans.fixtures import BD, daily_bars
from tapeloom.plans.sqltext import W, div, flag, full, lag, r6

_KEEP = ("symbol", "date", "high", "low", "close", "volume", "atr_14d", "return_1d", "gap_atr")


def _base(spark: SparkSession, d: str) -> DataFrame:
    return market.market_features(daily_bars(spark, d)).select(*_KEEP)


def _base_sql() -> str:
    tr = f"greatest(high - low, abs(high - {lag('close')}), abs(low - {lag('close')}))"
    return f"""{BD}, t AS (SELECT *, {tr} AS tr, {lag('close')} AS pc FROM bars), u AS (SELECT *, {full('avg', 'tr', 14)} AS a FROM t
), base AS (SELECT symbol, date, high, low, close, volume, {r6('a')} AS atr, close / nullif(pc, 0) - 1 AS r1, {r6(div('abs(open - pc)', 'a'))} AS gap FROM u)"""


def periods_and_channels(spark: SparkSession, d: str) -> DataFrame:
    """M1-M6, A1."""
    out = structure.channels(structure.prior_periods(_base(spark, d)))
    return out.drop("high", "low", "volume", "return_1d", "gap_atr")


def _channels_sql() -> str:
    cols, dists = [], []
    for n in structure.CHANNELS:
        cols.append(f"{full('max', 'high', n, 1)} AS dh{n}, {full('min', 'low', n, 1)} AS dl{n}")
        dists.append(
            f"dh{n} AS donchian_high_{n}d, dl{n} AS donchian_low_{n}d, {div(f'dh{n} - close', 'atr')} AS dist_donchian_high_{n}d_atr, "
            f"{div(f'close - dl{n}', 'atr')} AS dist_donchian_low_{n}d_atr, {flag(f'close > dh{n}')} AS above_donchian_high_{n}d, "
            f"{flag(f'close < dl{n}')} AS below_donchian_low_{n}d, {flag(f'close > dh{n} AND pc <= dh{n}')} AS crosses_above_donchian_high_{n}d, "
            f"{flag(f'close < dl{n} AND pc >= dl{n}')} AS crosses_below_donchian_low_{n}d, {div(f'close - dl{n}', f'dh{n} - dl{n}')} AS position_in_{n}d_range"
        )
    return f"""
WITH {_base_sql()}, k AS (
  SELECT *, date_trunc('week', date + 2) AS wk, date_trunc('month', date) AS mo FROM base
), wk AS (
  SELECT symbol, wk, lag(h) OVER (PARTITION BY symbol ORDER BY wk) AS wh, lag(l) OVER (PARTITION BY symbol ORDER BY wk) AS wl
  FROM (SELECT symbol, wk, max(high) AS h, min(low) AS l FROM k GROUP BY ALL)
), mo AS (
  SELECT symbol, mo, lag(h) OVER (PARTITION BY symbol ORDER BY mo) AS mh, lag(l) OVER (PARTITION BY symbol ORDER BY mo) AS ml
  FROM (SELECT symbol, mo, max(high) AS h, min(low) AS l FROM k GROUP BY ALL)
), j AS (
  SELECT k.*, wh, wl, mh, ml FROM k JOIN wk ON k.symbol = wk.symbol AND k.wk = wk.wk JOIN mo ON k.symbol = mo.symbol AND k.mo = mo.mo
), c AS (SELECT *, {lag('close')} AS pc, {', '.join(cols)} FROM j)
SELECT symbol, date, close, atr AS atr_14d, {div('wh - close', 'atr')} AS dist_prev_week_high_atr, {div('close - wl', 'atr')} AS dist_prev_week_low_atr,
  {div('mh - close', 'atr')} AS dist_prev_month_high_atr, {div('close - ml', 'atr')} AS dist_prev_month_low_atr, {', '.join(dists)} FROM c
"""


def pivots_and_swings(spark: SparkSession, d: str) -> DataFrame:
    """M7, M12-M14."""
    out = structure.swings(structure.confirmed_pivots(_base(spark, d)))
    return out.drop("high", "low", "volume", "return_1d", "gap_atr")


def _swings_sql() -> str:
    names = [f"fib_level_{round(f * 1000):03d}" for f in structure.FIB]
    levels = ", ".join(f"CASE dir WHEN 1 THEN hp - {f} * (hp - lp) WHEN -1 THEN lp + {f} * (hp - lp) END AS {n}" for n, f in zip(names, structure.FIB, strict=True))
    nearest = ", ".join(f"{{'d': abs({n} - close), 'i': {i}, 'v': {n}}}" for i, n in enumerate(names))
    return f"""
WITH {_pivots_sql()}, s AS (
  SELECT *, last_value(pivot_high IGNORE NULLS) OVER w AS hp, last_value(pivot_low IGNORE NULLS) OVER w AS lp,
    last_value(CASE WHEN pivot_high IS NOT NULL THEN bar END IGNORE NULLS) OVER w AS hb, last_value(CASE WHEN pivot_low IS NOT NULL THEN bar END IGNORE NULLS) OVER w AS lb
  FROM q WINDOW w AS ({W} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
), d AS (
  SELECT *, CASE WHEN hp > lp AND lb < hb THEN 1 WHEN hp > lp AND hb < lb THEN -1 ELSE 0 END AS dir FROM s
), l AS (SELECT *, {levels} FROM d
), n AS (SELECT *, CASE WHEN dir <> 0 THEN list_sort([{nearest}])[1].v END AS near FROM l)
SELECT symbol, date, close, atr AS atr_14d, bar, pivot_high, pivot_low, pivot_high_atr, pivot_low_atr, dir AS fib_swing_direction,
  CASE WHEN dir <> 0 THEN lp END AS fib_anchor_low, CASE WHEN dir <> 0 THEN hp END AS fib_anchor_high, {', '.join(names)}, near AS fib_nearest_level,
  {div('close - near', 'atr')} AS fib_nearest_dist_atr,
  {flag('close BETWEEN least(fib_level_382, fib_level_618) AND greatest(fib_level_382, fib_level_618)')} AS fib_in_value_zone FROM n
"""


def zones_and_sweeps(spark: SparkSession, d: str) -> DataFrame:
    """M8-M11, M15-M18."""
    out = structure.zones_and_sweeps(structure.confirmed_pivots(_base(spark, d))).drop("volume", "return_1d", "gap_atr")
    return out.withColumns({f"sr_{s}_1_strength": F.round(f"sr_{s}_1_strength", 6) for s in ("support", "resistance")})


def _pivots_sql() -> str:
    def centred(agg: str, x: str) -> str:
        return f"{agg}({x}) OVER ({W} ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING)"

    return f"""{_base_sql()}, p AS (
  SELECT *, (row_number() OVER ({W}) - 1)::INTEGER AS bar,
    CASE WHEN {centred('count', 'high')} = 7 AND high = {centred('max', 'high')} THEN high END AS ph,
    CASE WHEN {centred('count', 'low')} = 7 AND low = {centred('min', 'low')} THEN low END AS pl FROM base
), q AS (
  SELECT *, {lag('ph', 3)} AS pivot_high, {lag('pl', 3)} AS pivot_low,
    {lag('CASE WHEN ph IS NOT NULL THEN atr END', 3)} AS pivot_high_atr, {lag('CASE WHEN pl IS NOT NULL THEN atr END', 3)} AS pivot_low_atr FROM p
)"""


def _zones_sql() -> str:
    """Zones grow pivot by pivot in a recursive query, one step for the k-th pivot of every symbol and side."""
    zone = "STRUCT(zone INTEGER, total DOUBLE, touches INTEGER, low DOUBLE, high DOUBLE)"
    grown = "{'zone': z.zone, 'total': z.total + price, 'touches': z.touches + 1, 'low': least(z.low, price - half), 'high': greatest(z.high, price + half)}"
    new = "{'zone': len(zones)::INTEGER, 'total': price, 'touches': 1, 'low': price - half, 'high': price + half}"
    past = f"{W} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
    parts = ", ".join(f"{s}.{x} AS sr_{s}_1_{x}" for s in ("support", "resistance") for x in ("mid", "low", "high"))
    more = ", ".join(f"coalesce({s}.touches, 0)::INTEGER AS sr_{s}_1_touches, round(coalesce({s}.strength, 0.0::DOUBLE), 6) AS sr_{s}_1_strength" for s in ("support", "resistance"))
    joins = " ".join(f"LEFT JOIN best {s} ON {s}.symbol = q.symbol AND {s}.bar = q.bar AND {s}.side = '{s}'" for s in ("support", "resistance"))
    s, r = "sr_support_1", "sr_resistance_1"
    return f"""
WITH RECURSIVE {_pivots_sql()}, o AS (
  SELECT symbol, 'support' AS side, bar, pivot_low AS price, pivot_low_atr AS a FROM q WHERE pivot_low IS NOT NULL
  UNION ALL SELECT symbol, 'resistance', bar, pivot_high, pivot_high_atr FROM q WHERE pivot_high IS NOT NULL
), pv AS (
  SELECT symbol, side, bar, price, greatest(abs(price) * {structure.ZONE_PRICE}::DOUBLE, coalesce(abs(a), 0.0::DOUBLE) * {structure.ZONE_ATR}::DOUBLE, {structure.ZONE_FLOOR}::DOUBLE) AS half,
    row_number() OVER (PARTITION BY symbol, side ORDER BY bar) AS k FROM o
), grow AS (
  SELECT DISTINCT symbol, side, 0::BIGINT AS k, -1 AS bar, -1 AS hit, []::{zone}[] AS zones FROM pv
  UNION ALL
  SELECT symbol, side, k, bar, coalesce(near, len(zones))::INTEGER AS hit,
    CASE WHEN near IS NULL THEN list_append(zones, {new}) ELSE list_transform(zones, lambda z: CASE WHEN z.zone = near THEN {grown} ELSE z END) END AS zones
  FROM (SELECT pv.symbol, pv.side, pv.k, pv.bar, price, half, zones,
      list_sort(list_transform(list_filter(zones, lambda z: z.low - half <= price AND price <= z.high + half), lambda z: {{'d': abs(z.total / z.touches - price), 'zone': z.zone}}))[1].zone AS near
    FROM grow JOIN pv ON pv.symbol = grow.symbol AND pv.side = grow.side AND pv.k = grow.k + 1)
), ver AS (
  SELECT symbol, side, hit, bar AS bar_from, lead(bar) OVER (PARTITION BY symbol, side, hit ORDER BY bar) AS bar_to, zones[hit + 1] AS z FROM grow WHERE k > 0
), met AS (
  SELECT q.symbol, q.bar, side, hit, z.total / z.touches AS mid, z.low AS low, z.high AS high, z.touches AS touches, close,
    z.touches * exp(-(q.bar - bar_from) / {structure.RECENCY_BARS}::DOUBLE) AS strength
  FROM q JOIN ver ON ver.symbol = q.symbol AND q.bar >= bar_from AND q.bar < coalesce(bar_to, 2147483647)
), best AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY symbol, side, bar ORDER BY abs(close - mid), -strength, hit) AS n FROM met
    WHERE close BETWEEN low AND high OR CASE side WHEN 'support' THEN mid <= close ELSE mid >= close END) WHERE n = 1
), c AS (SELECT q.*, {lag('q.close', w='PARTITION BY q.symbol ORDER BY q.date')} AS prev, {parts}, {more} FROM q {joins}
), e AS (SELECT *, {flag(f'high > {r}_high AND close < {r}_high')} AS swept_sr_resistance_1, {flag(f'low < {s}_low AND close > {s}_low')} AS swept_sr_support_1,
    CASE WHEN {r}_high IS NOT NULL THEN greatest(high - {r}_high, 0.0) END AS ov, CASE WHEN {s}_low IS NOT NULL THEN greatest({s}_low - low, 0.0) END AS un FROM c
), f AS (SELECT *, bar - last_value(CASE WHEN swept_sr_resistance_1 = 1 THEN bar END IGNORE NULLS) OVER w AS bars_since_bearish_sweep,
    bar - last_value(CASE WHEN swept_sr_support_1 = 1 THEN bar END IGNORE NULLS) OVER w AS bars_since_bullish_sweep,
    last_value(CASE WHEN swept_sr_resistance_1 = 1 THEN low END IGNORE NULLS) OVER w AS xb, last_value(CASE WHEN swept_sr_support_1 = 1 THEN high END IGNORE NULLS) OVER w AS xu
  FROM e WINDOW w AS ({past}))
SELECT symbol, date, high, low, close, atr AS atr_14d, bar, pivot_high, pivot_low, pivot_high_atr, pivot_low_atr,
  {', '.join(f'{p}_{x}' for p in (s, r) for x in ('mid', 'low', 'high', 'touches', 'strength'))}, swept_sr_resistance_1, swept_sr_support_1,
  {div(f'close - {s}_mid', 'atr')} AS {s}_dist_atr, {div(f'{r}_mid - close', 'atr')} AS {r}_dist_atr,
  {flag(f'close BETWEEN {s}_low AND {s}_high')} AS sr_in_support_1_zone, {flag(f'close BETWEEN {r}_low AND {r}_high')} AS sr_in_resistance_1_zone,
  {flag(f'close > {r}_high AND prev <= {r}_high')} AS sr_breaks_above_resistance_1, {flag(f'close < {s}_low AND prev >= {s}_low')} AS sr_breaks_below_support_1,
  CASE WHEN {r}_mid > {s}_mid THEN (close - {s}_mid) / ({r}_mid - {s}_mid) END AS sr_zone_position,
  {div('ov', 'atr')} AS bearish_sweep_magnitude_atr, {div('un', 'atr')} AS bullish_sweep_magnitude_atr,
  CASE WHEN ov > 0 THEN ({r}_high - close) / ov WHEN {r}_high IS NOT NULL THEN 0.0 END AS bearish_sweep_reclaim_frac,
  CASE WHEN un > 0 THEN (close - {s}_low) / un WHEN {s}_low IS NOT NULL THEN 0.0 END AS bullish_sweep_reclaim_frac,
  bars_since_bearish_sweep, bars_since_bullish_sweep,
  {flag(f'bars_since_bearish_sweep <= {structure.CONFIRM_BARS} AND close < xb')} AS bearish_confirm_after_sweep,
  {flag(f'bars_since_bullish_sweep <= {structure.CONFIRM_BARS} AND close > xu')} AS bullish_confirm_after_sweep FROM f
"""


def liquidity(spark: SparkSession, d: str) -> DataFrame:
    """M19-M21."""
    return structure.liquidity(_base(spark, d)).select(
        "symbol", "date", F.round("dollar_volume_20d", 2).alias("dollar_volume_20d"), F.round("amihud_20d", 9).alias("amihud_20d"), "amihud_z_252d",
        "dollar_volume_z_252d", "liquidity_stress_score",
    )


def _z(x: str) -> str:
    return f"({x} - ({full('avg', x, 252)})) / nullif({full('stddev_samp', x, 252)}, 0.0)"


LIQUIDITY_SQL = f"""
WITH {_base_sql()}, v AS (SELECT *, close * volume AS dv, abs(r1) / greatest(close * volume, 1.0) AS im FROM base
), a AS (SELECT *, {full('avg', 'dv', 20)} AS m, {full('avg', 'im', 20)} AS i FROM v
), z AS (SELECT *, {_z('i')} AS az, {_z('m')} AS dz FROM a)
SELECT symbol, date, round(m, 2) AS dollar_volume_20d, round(i, 9) AS amihud_20d, {r6('az')} AS amihud_z_252d, {r6('dz')} AS dollar_volume_z_252d,
  {r6('az - dz + coalesce(gap, 0.0)')} AS liquidity_stress_score FROM z
"""


def gold_market(spark: SparkSession, d: str) -> DataFrame:
    """All features of region-daily bars as one table."""
    from tapeloom.operators.gold import gold_market as table

    bars = daily_bars(spark, d).withColumns({"dividend_amount": F.when(F.col("volume") > 40, F.col("volume") - F.lit(41.0)), "split_coefficient": F.when(F.col("volume") > 20, F.lit(1.0))})
    places = {"sr_support_1_strength": 6, "sr_resistance_1_strength": 6, "dollar_volume_20d": 2, "amihud_20d": 9}
    return table(bars).drop("dividend_amount", "split_coefficient").withColumns({c: F.round(c, n) for c, n in places.items()})


def _gold_sql() -> str:
    from tapeloom.plans import candle_plans, market_plans

    bar, bars = "date, symbol", "date, symbol, open, high, low, close, volume"
    pivots = "bar, pivot_high, pivot_low, pivot_high_atr, pivot_low_atr"
    parts = (
        (candle_plans._sql(), f"{bars}, true_range, atr_14d"), (candle_plans.HA_SQL, bars), (_channels_sql(), f"{bar}, close, atr_14d"), (_swings_sql(), f"{bar}, close, atr_14d, {pivots}"),
        (_zones_sql(), f"{bar}, high, low, close, atr_14d, {pivots}"), (LIQUIDITY_SQL, bar),
    )
    joins = " ".join(f"JOIN ({sql}) p{i} ON m.symbol = p{i}.symbol AND m.date = p{i}.date" for i, (sql, _) in enumerate(parts))
    return f"SELECT m.*, {', '.join(f'p{i}.* EXCLUDE ({shared})' for i, (_, shared) in enumerate(parts))} FROM ({market_plans._features_sql()}) m {joins}"


def register_all(register) -> None:
    register("gold_market", gold_market, _gold_sql())
    register("structure_channels", periods_and_channels, _channels_sql())
    register("structure_swings", pivots_and_swings, _swings_sql())
    register("structure_zones", zones_and_sweeps, _zones_sql())
    register("structure_liquidity", liquidity, LIQUIDITY_SQL)
