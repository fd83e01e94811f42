"""Bars and event series derived from the input tables, in Spark and as SQL text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeloom.session import table

_ORDER = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")


def _bars(spark: SparkSession, d: str, symbol: str, date) -> DataFrame:
    li = table(spark, d, "lineitem").select(*_ORDER, "l_quantity", "l_shipdate")
    su = table(spark, d, "supplier").select("s_suppkey", "s_nationkey")
    na = table(spark, d, "nation").select("n_nationkey", "n_name", "n_regionkey")
    j = li.join(su, F.col("l_suppkey") == F.col("s_suppkey")).join(na, F.col("s_nationkey") == F.col("n_nationkey"))
    if symbol == "r_name":
        re = table(spark, d, "region").select("r_regionkey", "r_name")
        j = j.join(re, F.col("n_regionkey") == F.col("r_regionkey"))
    px = F.col("l_extendedprice") / F.col("l_quantity")
    at = F.struct(*_ORDER)
    return j.groupBy(F.col(symbol).alias("symbol"), date.alias("date")).agg(
        F.min_by(px, at).alias("open"), F.max(px).alias("high"), F.min(px).alias("low"), F.max_by(px, at).alias("close"),
        F.sum("l_quantity").alias("volume"),
    )


def daily_bars(spark: SparkSession, d: str) -> DataFrame:
    return _bars(spark, d, "r_name", F.to_date("l_shipdate"))


def weekly_bars(spark: SparkSession, d: str) -> DataFrame:
    return _bars(spark, d, "n_name", F.to_date(F.date_trunc("week", "l_shipdate")))


def hourly_bars(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events")
    at = F.struct("ts", "event_id")
    return e.groupBy(F.col("event_type").alias("symbol"), F.date_trunc("hour", F.col("ts").cast("timestamp")).alias("ts")).agg(
        F.min_by("value", at).alias("open"), F.max("value").alias("high"), F.min("value").alias("low"), F.max_by("value", at).alias("close"),
        F.count(F.lit(1)).cast("double").alias("volume"),
    )


_PX = "l_extendedprice / l_quantity"
_ROW = "row(l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice)"
_OHLCV = f"""arg_min({_PX}, {_ROW}) AS open, max({_PX}) AS high, min({_PX}) AS low, arg_max({_PX}, {_ROW}) AS close, sum(l_quantity) AS volume"""

BD = f"""bars AS (
  SELECT r_name AS symbol, l_shipdate::DATE AS date, {_OHLCV}
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
  GROUP BY 1, 2
)"""
BW = f"""bars AS (
  SELECT n_name AS symbol, date_trunc('week', l_shipdate)::DATE AS date, {_OHLCV}
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey GROUP BY 1, 2
)"""
BH = """bars AS (
  SELECT event_type AS symbol, date_trunc('hour', ts) AS ts, arg_min(value, row(ts, event_id)) AS open, max(value) AS high, min(value) AS low,
    arg_max(value, row(ts, event_id)) AS close, count(*)::DOUBLE AS volume
  FROM events GROUP BY 1, 2
)"""


def orders_as_earnings(spark: SparkSession, d: str, today: str = "2001-06-30") -> DataFrame:
    """One reported figure per customer and day; later ones are only scheduled."""
    o = table(spark, d, "orders").select(F.concat(F.lit("C"), "o_custkey").alias("symbol"), F.to_date("o_orderdate").alias("date"), "o_totalprice", "o_orderkey")
    one = o.groupBy("symbol", "date").agg(F.max_by("o_totalprice", F.struct("o_orderkey", "o_totalprice")).alias("p"))
    from tapeloom.functions.frames import series

    eps = F.col("p") / 1e5
    return one.select(
        "symbol", "date", eps.alias("reported_eps"), F.lag(eps).over(series()).alias("eps_estimate"), F.col("date").alias("report_date"),
        F.when(F.col("date") > F.lit(today).cast("date"), "scheduled").otherwise("actual").alias("record_type"),
    )


EO = """eo AS (
  SELECT symbol, date, p / 1e5 AS reported_eps, lag(p / 1e5) OVER (PARTITION BY symbol ORDER BY date) AS eps_estimate, date AS report_date,
    CASE WHEN date > DATE '2001-06-30' THEN 'scheduled' ELSE 'actual' END AS record_type
  FROM (SELECT 'C' || o_custkey AS symbol, o_orderdate::DATE AS date, arg_max(o_totalprice, row(o_orderkey, o_totalprice)) AS p FROM orders GROUP BY 1, 2)
)"""


def statements(spark: SparkSession, d: str) -> DataFrame:
    """Quarterly figures per market segment, as fixed fractions of the orders' value."""
    o = table(spark, d, "orders").join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    q = F.last_day(F.add_months(F.date_trunc("quarter", "o_orderdate"), 2))
    return o.groupBy(F.col("c_mktsegment").alias("symbol"), q.alias("date")).agg(
        F.round(F.sum("o_totalprice"), 2).alias("revenue"), F.count(F.lit(1)).cast("double").alias("shares_outstanding"),
        F.round(F.sum(F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice")).otherwise(0.0)), 2).alias("gross_profit"),
        F.round(F.sum(F.when(F.col("c_acctbal") > 0, F.col("o_totalprice")).otherwise(0.0)), 2).alias("operating_cash_flow"),
    ).select(
        "symbol", "date", "revenue", "gross_profit", "operating_cash_flow", "shares_outstanding",
        (F.col("gross_profit") * 0.25).alias("net_income"), (F.col("revenue") * 2).alias("total_assets"),
        (F.col("gross_profit") * 0.5).alias("long_term_debt"), (F.col("operating_cash_flow") * 0.75).alias("current_assets"),
        (F.col("revenue") * 0.25).alias("current_liabilities"),
    )


ST = """st AS (
  SELECT *, gross_profit * 0.25 AS net_income, revenue * 2 AS total_assets, gross_profit * 0.5 AS long_term_debt,
    operating_cash_flow * 0.75 AS current_assets, revenue * 0.25 AS current_liabilities
  FROM (
    SELECT c_mktsegment AS symbol, last_day((date_trunc('quarter', o_orderdate) + INTERVAL 2 MONTH)::DATE) AS date,
      round(sum(o_totalprice), 2) AS revenue, count(*)::DOUBLE AS shares_outstanding,
      round(sum(CASE WHEN o_orderstatus = 'F' THEN o_totalprice ELSE 0.0 END), 2) AS gross_profit,
      round(sum(CASE WHEN c_acctbal > 0 THEN o_totalprice ELSE 0.0 END), 2) AS operating_cash_flow
    FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2
  )
)"""
