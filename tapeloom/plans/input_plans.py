"""Regime inputs in one frame, the publish window, silver earnings, providers' symbols and table statistics."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeloom.operators import clean, fundamentals, market, regime
from tapeloom.plans import market_plans
from tapeloom.plans.fixtures import daily_bars
from tapeloom.plans.payload_plans import _texts
from tapeloom.plans.sqltext import full
from tapeloom.session import shared_folder, table
from tapeloom.sources import payloads as P
from tapeloom.sources import tables

SLICES = {
    "spy": ("ASIA", {"close": "spy_close", "return_1d": "return_1d", "return_20d": "return_20d", "sma_200d": "spy_sma_200d", "atr_14d": "atr_14d", "gap_atr": "gap_atr", "bb_width_20d": "bb_width_20d", "rsi_14d": "rsi_14d", "volume_pct_rank_252d": "volume_pct_rank_252d"}),
    "qqq": ("EUROPE", {"close": "qqq_close", "return_20d": "qqq_return_20d", "sma_200d": "qqq_sma_200d"}),
    "iwm": ("AMERICA", {"close": "iwm_close", "return_20d": "iwm_return_20d"}),
    "acwi": ("AFRICA", {"close": "acwi_close", "return_20d": "acwi_return_20d"}),
    "vix": ("MIDDLE EAST", {"close": "vix_spot_close"}), "vix3m": ("MIDDLE EAST", {"high": "vix3m_close"}),
}
HIGH = 1500.0


def _inputs(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").groupBy(F.to_date("o_orderdate").alias("date")).agg(
        (F.min("o_totalprice") / 1e5).alias("rate_2y"), (F.max("o_totalprice") / 1e5).alias("rate_10y"), (F.max("o_totalprice") / 1e4).alias("hy_oas"), F.bool_or(F.col("o_orderstatus") == "F").alias("rates_event_flag"))
    from pyspark.sql import Window

    rows = Window.partitionBy(F.lit(1)).orderBy("date").rowsBetween(-19, 0)  # one row a calendar day
    z = (F.col("hy_oas") - F.avg("hy_oas").over(rows)) / F.nullif(F.stddev("hy_oas").over(rows), F.lit(0.0))
    macro = o.withColumns({"curve_2s10s": F.round(F.col("rate_10y") - F.col("rate_2y"), 9), "hy_oas_z_20d": F.when(F.count("hy_oas").over(rows) == 20, F.round(z, 6))})
    return regime.inputs_daily(market.market_features(daily_bars(spark, d)), macro, SLICES, "vix_spot_close", "vix3m_close", HIGH)


def regime_inputs(spark: SparkSession, d: str) -> DataFrame:
    """Indexes side by side with macro inputs, by date, and whether all is there."""
    return _inputs(spark, d)


def publish_window(spark: SparkSession, d: str) -> DataFrame:
    """Through which date inputs are complete, and the dates behind it."""
    w = regime.publish_window(_inputs(spark, d), "date", "inputs_complete")
    return w.select("published_through", "input_through", F.array_join(F.transform("skipped", lambda x: F.date_format(x, "yyyy-MM-dd")), ",").alias("skipped"))


def _inputs_sql() -> str:
    picks = ", ".join(f"max(CASE WHEN symbol = '{s}' THEN {c} END) AS {n}" for s, cols in SLICES.values() for c, n in cols.items())
    names = [n for _, cols in SLICES.values() for n in cols.values()] + ["rate_2y", "rate_10y", "hy_oas", "rates_event_flag", "curve_2s10s", "hy_oas_z_20d", "vix_slope"]
    z = f"(hy_oas - {full('avg', 'hy_oas', 20, w='ORDER BY date')}) / nullif({full('stddev_samp', 'hy_oas', 20, w='ORDER BY date')}, 0.0)"
    return f"""
f AS ({market_plans._features_sql()}), w AS (SELECT date, {picks} FROM f GROUP BY 1),
o AS (SELECT o_orderdate::DATE AS date, min(o_totalprice) / 1e5 AS rate_2y, max(o_totalprice) / 1e5 AS rate_10y, max(o_totalprice) / 1e4 AS hy_oas, bool_or(o_orderstatus = 'F') AS rates_event_flag FROM orders GROUP BY 1),
m AS (SELECT *, round(rate_10y - rate_2y, 9) AS curve_2s10s, round({z}, 6) AS hy_oas_z_20d FROM o),
j AS (SELECT *, vix3m_close - vix_spot_close AS vix_slope, coalesce(vix_spot_close > {HIGH}, false) AS hit, row_number() OVER (ORDER BY date) AS rn FROM w FULL JOIN m USING (date)),
i AS (SELECT * EXCLUDE (hit, rn), CASE WHEN hit THEN (rn - coalesce(max(CASE WHEN NOT hit THEN rn END) OVER (ORDER BY date), 0))::INTEGER ELSE 0 END AS vix_streak, {' AND '.join(f'{n} IS NOT NULL' for n in names)} AS inputs_complete FROM j)"""


def silver_earnings(spark: SparkSession, d: str) -> DataFrame:
    """customers' reported orders as JSON payloads and planned ones as CSV calendars, an event each, figures rounded half up."""
    o = table(spark, d, "orders").withColumn("day", F.date_format("o_orderdate", "yyyy-MM-dd"))
    k = F.col("o_orderkey")
    row = F.struct(F.when(k % 7 != 0, F.col("day")).otherwise("").alias("fiscalDateEnding"), F.col("day").alias("reportedDate"), (F.col("o_totalprice") / 100000).cast("string").alias("reportedEPS"), F.lit("1.00005").alias("estimatedEPS"), (-(k % 1000) / 100000).cast("string").alias("surprise"))
    done = _texts(o.where("o_orderstatus <> 'O'"), ["o_custkey"], ["o_orderkey", "o_totalprice", "day"], row, lambda x: F.to_json(F.struct(x.alias("quarterlyEarnings"))))
    actual = P.earnings_history(done, "payload", ["o_custkey"]).select(F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("symbol"), F.col("date").alias("fiscal_date"), "report_date", "date", "reported_eps", "eps_estimate", "surprise", F.lit(0).alias("position"))
    line = F.concat_ws(",", F.concat(F.lit(" c"), F.col("o_custkey").cast("string")), F.col("day"), F.when(k % 5 == 0, F.lit("")).otherwise(F.col("day")), (F.col("o_totalprice") / 100000).cast("string"))
    plan = _texts(o.where("o_orderkey % 3 = 0"), ["o_custkey"], ["o_orderkey", "o_totalprice", "day"], line, lambda x: F.concat_ws("\n", F.lit("symbol,reportDate,fiscalDateEnding,estimate"), F.array_join(x, "\n")))
    rows = P.csv_fields(plan, "payload", ["o_custkey"], ["symbol", "report_date", "fiscal_date_ending", "estimate"])
    none = F.lit(None).cast("double")
    scheduled = rows.select(F.upper("symbol").alias("symbol"), P.day_of(F.col("fiscal_date_ending")).alias("fiscal_date"), P.day_of(F.col("report_date")).alias("report_date"), F.lit(None).cast("date").alias("date"),
                            none.alias("reported_eps"), P.number(F.col("estimate")).alias("eps_estimate"), none.alias("surprise"), "position")
    return fundamentals.silver_earnings(actual, scheduled)


_FOUR = "(({x} + 500) // 1000) / 10000.0::DOUBLE"
SILVER_EARNINGS = f"""
WITH o AS (SELECT 'C' || o_custkey AS symbol, o_orderdate::DATE AS day, o_orderkey AS k, o_totalprice AS p, round(o_totalprice * 100)::BIGINT AS cents, o_orderstatus AS s FROM orders),
a AS (SELECT * FROM o WHERE s <> 'O' QUALIFY row_number() OVER (PARTITION BY symbol, day ORDER BY k DESC, p DESC) = 1),
c AS (SELECT * FROM o WHERE k % 3 = 0 QUALIFY row_number() OVER (PARTITION BY symbol, day ORDER BY k DESC, p DESC) = 1)
SELECT symbol, day AS event_date, day AS fiscal_date, day AS report_date, {_FOUR.format(x='cents')} AS reported_eps, 1.0001::DOUBLE AS eps_estimate, -((k % 1000 + 5) // 10) / 10000.0::DOUBLE AS surprise, 'actual' AS record_type FROM a
UNION ALL SELECT symbol, day, CASE WHEN k % 5 <> 0 THEN day END, day, NULL, {_FOUR.format(x='cents')}, NULL, 'scheduled' FROM c WHERE (symbol, day) NOT IN (SELECT (symbol, day) FROM a)"""

_WORDS = ("1", "true", " T", "yes", "Y", "on", "0", "no", "off", "", "maybe", None)


def provider_symbols(spark: SparkSession, d: str) -> DataFrame:
    """Customers whose provider's flag says yes, in whatever words."""
    c = table(spark, d, "customer")
    flag = F.element_at(F.array(*map(F.lit, _WORDS)), (F.pmod("c_custkey", F.lit(len(_WORDS))) + 1).cast("int"))
    return clean.available(c.select(F.concat(F.lit("C"), F.col("c_custkey").cast("string")).alias("symbol"), flag.alias("flag")), "flag")


PROVIDERS = f"""SELECT 'C' || c_custkey AS symbol, (['1', 'true', ' T', 'yes', 'Y', 'on'])[c_custkey % {len(_WORDS)} + 1] AS flag FROM customer WHERE c_custkey % {len(_WORDS)} < 6"""


def table_stats(spark: SparkSession, d: str) -> DataFrame:
    """Rows, days and files of orders written by letter of their status; more than no bytes in as many files as there are letters at least."""
    path = f"{shared_folder(spark)}/stats-{uuid.uuid4().hex}"
    o = table(spark, d, "orders").select(F.col("o_orderstatus").alias("symbol"), F.to_date("o_orderdate").alias("date"), "o_orderkey")
    tables.write_buckets(o, path)
    s = tables.layer_stats(spark.read.parquet(path), "date")
    return s.select("rows", "first", "last", (F.col("files") >= o.select("symbol").distinct().count()).alias("a_file_each"), (F.col("bytes") > 0).alias("has_bytes"))


STATS = "SELECT count(*) AS rows, min(o_orderdate)::DATE AS first, max(o_orderdate)::DATE AS last, true AS a_file_each, true AS has_bytes FROM orders"


def register_all(register) -> None:
    register("regime_inputs", regime_inputs, f"WITH {_inputs_sql()} SELECT * FROM i")
    register("publish_window", publish_window, f"""WITH {_inputs_sql()}, p AS (SELECT max(date) FILTER (inputs_complete) AS t, max(date) AS m FROM i)
SELECT t AS published_through, m AS input_through, coalesce((SELECT string_agg(strftime(date, '%Y-%m-%d'), ',' ORDER BY date) FROM i WHERE t IS NULL OR date > t), '') AS skipped FROM p""")
    register("silver_earnings", silver_earnings, SILVER_EARNINGS)
    register("provider_symbols", provider_symbols, PROVIDERS)
    register("table_stats", table_stats, STATS)
