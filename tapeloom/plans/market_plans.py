"""Queries on daily and weekly bars: base features, ranking, selection."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeloom.operators import market, ranking
from tapeloom.plans.fixtures import BD, BW, daily_bars, weekly_bars
from tapeloom.plans.sqltext import div, flag, full, lag, over, r6

RANK_GROUPS = [
    ranking.Group("momentum", 0.6, (ranking.Factor("return_5d", 0.7), ranking.Factor("return_20d", 0.3))),
    ranking.Group("quiet", 0.4, (ranking.Factor("atr_share", 1.0, ascending=True),)),
]


def market_features(spark: SparkSession, d: str) -> DataFrame:
    """W1-W14 on region-daily bars; the volume stands in for dividends and splits."""
    bars = daily_bars(spark, d).withColumns({
        "dividend_amount": F.when(F.col("volume") > 40, F.col("volume") - F.lit(41.0)),
        "split_coefficient": F.when(F.col("volume") > 20, F.lit(1.0)),
    })
    return market.market_features(bars).drop("dividend_amount", "split_coefficient")


def _features_sql() -> str:
    returns = ", ".join(f"padded / nullif({lag('padded', n)}, 0.0) - 1 AS return_{n}d" for n in market.RETURN_DAYS)
    smas = ", ".join(f"{full('avg', 'close', n)} AS sma_{n}" for n in market.AVERAGES)
    return f"""
WITH {BD}, a AS (
  SELECT *, last_value(close IGNORE NULLS) OVER (PARTITION BY symbol ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS padded,
    {lag('close')} AS pc, CASE WHEN volume > 40 THEN volume - 41.0 END AS dividend, CASE WHEN volume > 20 THEN 1.0 END AS split FROM bars
), b AS (
  SELECT *, {returns}, greatest(close - pc, 0.0) AS g0, greatest(pc - close, 0.0) AS l0, pc IS NOT NULL AS has,
    greatest(high - low, abs(high - pc), abs(low - pc)) AS true_range, {over('max(close)', 252)} AS rolling_max_252d,
    {div('high - low', 'close')} AS range_close, {div(full('max', 'high', 20) + ' - ' + full('min', 'low', 20), 'close')} AS range_20,
    {full('avg', 'volume', 20)} AS v_mean, {full('stddev_samp', 'volume', 20)} AS v_std, {full('stddev_samp', 'close', 20)} AS c_std, {smas},
    {over('list(volume)', 252)} AS vs
  FROM a
), c AS (
  SELECT *, CASE WHEN has THEN g0 END AS gain, CASE WHEN has THEN l0 END AS loss, {over('list(range_20) FILTER (WHERE range_20 IS NOT NULL)', 252)} AS rs FROM b
), d AS (
  SELECT *, {full('avg', 'gain', 14)} AS g, {full('avg', 'loss', 14)} AS l, {full('stddev_samp', 'return_1d', 20)} AS v20,
    {full('stddev_samp', 'return_1d', 60)} AS v60, {full('avg', 'true_range', 14)} AS atr,
    {flag('sma_20 > sma_50')} AS f1, {flag('sma_50 > sma_200')} AS f2 FROM c
), e AS (SELECT *, f1 - {lag('f1')} AS s1, f2 - {lag('f2')} AS s2 FROM d)
SELECT symbol, date, open, high, low, close, volume, return_1d, return_5d, return_20d, return_60d, true_range, rolling_max_252d, range_close, range_20,
  CASE WHEN dividend IS NOT NULL THEN (dividend <> 0)::INTEGER END AS is_dividend_day, CASE WHEN split IS NOT NULL THEN (split <> 1)::INTEGER END AS is_split_day,
  len(list_filter(vs, lambda x: x <= volume)) / len(vs) AS volume_pct_rank_252d,
  {r6('sma_20')} AS sma_20d, {r6('sma_50')} AS sma_50d, {r6('sma_200')} AS sma_200d,
  {r6("CASE WHEN l = 0 AND g > 0 THEN 100.0 WHEN g = 0 AND l > 0 THEN 0.0 ELSE 100 - 100 / (1 + g / nullif(l, 0)) END")} AS rsi_14d,
  {r6('v20')} AS vol_20d, {r6('v60')} AS vol_60d, close / nullif(rolling_max_252d, 0) - 1 AS drawdown_1y, {r6('atr')} AS atr_14d,
  CASE WHEN range_20 IS NOT NULL THEN len(list_filter(rs, lambda x: x <= range_20)) / len(rs) END AS compression_score,
  {r6(div('volume - v_mean', 'v_std'))} AS volume_z_20d, {r6(div('4 * c_std', 'sma_20'))} AS bb_width_20d,
  f1 AS sma_20_gt_sma_50, f2 AS sma_50_gt_sma_200, {flag('close > sma_50')} AS above_sma_50, {r6(div('sma_50', 'sma_200') + ' - 1')} AS trend_50_200,
  {flag('s1 = 1')} AS sma_20_crosses_above_sma_50, {flag('s1 = -1')} AS sma_20_crosses_below_sma_50,
  {flag('s2 = 1')} AS sma_50_crosses_above_sma_200, {flag('s2 = -1')} AS sma_50_crosses_below_sma_200,
  {r6(div('abs(open - pc)', 'atr'))} AS gap_atr
FROM e
"""


def ranked(spark: SparkSession, d: str) -> DataFrame:
    f = market.market_features(weekly_bars(spark, d))
    f = f.select("symbol", "date", "close", "return_5d", "return_20d", (F.col("atr_14d") / F.col("close")).alias("atr_share"))
    return ranking.ordinal(ranking.score(f, RANK_GROUPS)).withColumn("score", F.round("score", 6))


def ranking_top5(spark: SparkSession, d: str) -> DataFrame:
    """Factors, percentile ranks, weighted score, ordinal, top five with equal weights per week."""
    top = ranking.target_weights(ranking.top_n(ranked(spark, d), 5, max_open=8), 5, cap=0.15)
    return top.select("date", "symbol", "rank", "score", "target_weight")


def _pct(x: str) -> str:
    return f"((rank() OVER (PARTITION BY date ORDER BY {x})) + (count(*) OVER (PARTITION BY date, {x}) - 1) / 2.0) / count(*) OVER (PARTITION BY date)"


_RANKED = f"""
{BW}, a AS (
  SELECT symbol, date, close, close / nullif({lag('close', 5)}, 0) - 1 AS r5, close / nullif({lag('close', 20)}, 0) - 1 AS r20,
    greatest(high - low, abs(high - {lag('close')}), abs(low - {lag('close')})) AS tr FROM bars
), b AS (
  SELECT *, {r6(full('avg', 'tr', 14))} / close AS q FROM a
), c AS (
  SELECT * FROM b WHERE r5 IS NOT NULL AND r20 IS NOT NULL AND q IS NOT NULL
), s AS (
  SELECT symbol, date, close, (0.6 * (0.7 * {_pct('r5')} + 0.3 * {_pct('r20')}) / 1.0 + 0.4 * -({_pct('q')})) / 1.0 AS score FROM c
), k AS (
  SELECT symbol, date, round(score, 6) AS score, score AS exact, row_number() OVER (PARTITION BY date ORDER BY round(score, 9) DESC, symbol) AS rank FROM s
)"""


def rank_transforms(spark: SparkSession, d: str) -> DataFrame:
    """All nine transforms of the weekly return, and the reversed rank."""
    f = weekly_bars(spark, d).select("symbol", "date", (F.col("close") / F.col("open") - 1).alias("x"))
    x = F.col("x")
    t = ranking.transform
    return f.select(
        "symbol", "date",
        t(x, "percentile_rank").alias("pct"), F.round(t(x, "zscore"), 6).alias("z"), t(x, "minmax").alias("mm"),
        t(x, "clip", low=-0.1, high=0.1).alias("clipped"), F.round(t(x, "winsorize", low=0.05, high=0.95), 6).alias("wins"),
        t(F.when(x > 0, x), "coalesce", value=0.0).alias("filled"), F.round(t(x, "log1p"), 6).alias("l1p"), t(x, "negate").alias("neg"), t(x, "abs").alias("mag"),
    )


RANK_TRANSFORMS = f"""
WITH {BW}, f AS (SELECT symbol, date, close / open - 1 AS x FROM bars), g AS (
  SELECT date, avg(x) AS m, stddev_samp(x) AS s, min(x) AS lo, max(x) AS hi, quantile_cont(x, 0.05) AS q1, quantile_cont(x, 0.95) AS q2 FROM f GROUP BY date
)
SELECT symbol, f.date, {_pct('x').replace('PARTITION BY date', 'PARTITION BY f.date')} AS pct, round((x - m) / nullif(s, 0), 6) AS z,
  (x - lo) / nullif(hi - lo, 0) AS mm, least(greatest(x, -0.1), 0.1) AS clipped, round(least(greatest(x, q1), q2), 6) AS wins,
  CASE WHEN x > 0 THEN x ELSE 0.0 END AS filled, round(ln(1 + x), 6) AS l1p, -x AS neg, abs(x) AS mag
FROM f JOIN g ON f.date = g.date
"""


def platinum(spark: SparkSession, d: str) -> DataFrame:
    """The published ranking, up to the last week of the history."""
    r = ranked(spark, d)
    last = r.agg(F.max("date").alias("last_updated_date"))
    return r.select("date", "symbol", "rank", "score").crossJoin(F.broadcast(last))


def register_all(register) -> None:
    register("market_features", market_features, _features_sql())
    register("ranking_top5", ranking_top5, f"""
WITH {_RANKED} SELECT date, symbol, rank::INTEGER AS rank, score, least(0.2, 0.15)::DOUBLE AS target_weight FROM k WHERE rank <= 5""")
    register("rank_transforms", rank_transforms, RANK_TRANSFORMS)
    register("platinum_rankings", platinum, f"""
WITH {_RANKED} SELECT date, symbol, rank::INTEGER AS rank, score, (SELECT max(date) FROM k) AS last_updated_date FROM k""")
