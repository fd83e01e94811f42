"""Provider payloads made of the input tables, parsed back: JSON histories, statements, earnings, listings, vendor batches and CSV texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeloom.plans.fixtures import BD, BH, daily_bars, hourly_bars
from tapeloom.session import table
from tapeloom.sources import payloads as P


def _texts(df: DataFrame, keys: list[str], order: list[str], row: Column, text) -> DataFrame:
    """One payload text per key; ``order`` is the rows' place in its list."""
    lists = df.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct(*order, row.alias("_r")))).alias("_l"))
    return lists.select(*keys, text(F.transform("_l", lambda x: x["_r"])).alias("payload"))


def _orders(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").withColumn("day", F.date_format("o_orderdate", "yyyy-MM-dd"))


def statement_json(spark: SparkSession, d: str) -> DataFrame:
    """Each customer's orders as a statements payload; two names for revenue, other rhythms and repeated dates inside."""
    frame = F.when(F.col("o_orderpriority").startswith("1"), " Quarterly").when(F.col("o_orderpriority").startswith("2"), "annual").otherwise("weekly")
    even = F.col("o_orderkey") % 2 == 0
    price = F.col("o_totalprice").cast("string")
    row = F.struct(F.col("day").alias("period_end"), frame.alias("timeframe"), F.when(even, price).alias("revenues"), F.when(~even, price).alias("Total Revenue"),
                   F.when(F.col("o_orderstatus") == "F", price).otherwise("None").alias("net_income"))
    texts = _texts(_orders(spark, d), ["o_custkey"], ["o_orderdate", "o_orderkey", "o_totalprice"], row, lambda x: F.to_json(F.struct(F.lit(2).alias("schema_version"), x.alias("rows"))))
    return P.report_rows(texts, "payload", ["o_custkey"], "rows", ["date", "period_end"], {"revenue": ["revenues", "total_revenue"], "net_income": ["net_income"]})


STATEMENT_JSON = """
WITH o AS (SELECT *, o_orderdate::DATE AS date, CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'quarterly' WHEN '2' THEN 'annual' END AS timeframe FROM orders)
SELECT o_custkey, date, timeframe, o_totalprice AS revenue, CASE WHEN o_orderstatus = 'F' THEN o_totalprice END AS net_income FROM o WHERE timeframe IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY o_custkey, date, timeframe ORDER BY o_orderdate DESC, o_orderkey DESC, o_totalprice DESC) = 1"""


def valuation_json(spark: SparkSession, d: str) -> DataFrame:
    """Each order's lines as daily ratios, the last per date."""
    li = table(spark, d, "lineitem").withColumn("day", F.date_format("l_shipdate", "yyyy-MM-dd"))
    odd = F.col("l_linenumber") % 2 == 1
    row = F.struct(F.when(odd, F.col("day")).alias("date"), F.when(~odd, F.col("day")).alias("as_of"), F.col("l_extendedprice").cast("string").alias("market_cap"),
                   F.when(F.col("l_tax") > 0.02, F.col("l_quantity").cast("string")).otherwise("n/a").alias("pe_ratio"))
    texts = _texts(li, ["l_orderkey"], ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_tax", "day"], row, lambda x: F.to_json(F.struct(x.alias("results"))))
    return P.report_rows(texts, "payload", ["l_orderkey"], "results", ["date", "as_of"], {"market_cap": ["market_cap"], "pe_ratio": ["price_to_earnings", "pe_ratio"]}, None)


VALUATION_JSON = """
SELECT l_orderkey, l_shipdate::DATE AS date, l_extendedprice AS market_cap, CASE WHEN l_tax > 0.02 THEN l_quantity END AS pe_ratio FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_shipdate::DATE ORDER BY l_linenumber DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC, l_quantity DESC, l_tax DESC) = 1"""


def history_json(spark: SparkSession, d: str) -> DataFrame:
    """Region bars as monthly histories; Decembers report that there is none, which is allowed."""
    b = daily_bars(spark, d).withColumn("month", F.date_format("date", "yyyy-MM"))
    row = F.struct(F.date_format("date", "yyyy-MM-dd").alias("date"), *[F.col(c).cast("string").alias(c) for c in ("open", "close", "volume")])
    empty = F.col("month").endswith("-12")
    texts = _texts(b, ["symbol", "month"], ["date"], row, lambda x: F.to_json(F.struct(F.when(empty, " NO_HISTORY").otherwise("").alias("status"), F.when(~empty, x).alias("rows"))))
    return P.history_rows(texts, "payload", ["symbol", "month"], ("open", "close", "volume"))


HISTORY_JSON = f"""
WITH {BD}, b AS (SELECT *, strftime(date, '%Y-%m') AS month FROM bars)
SELECT symbol, month, 'ok' AS status, date, open, close, volume FROM b WHERE month NOT LIKE '%-12'
UNION ALL SELECT DISTINCT symbol, month, 'no_history', NULL::DATE, NULL::DOUBLE, NULL::DOUBLE, NULL::DOUBLE FROM b WHERE month LIKE '%-12'"""


def reports_json(spark: SparkSession, d: str) -> DataFrame:
    """Finished orders as annual and others as quarterly reports of each customer."""
    o = _orders(spark, d)
    row = F.struct(F.col("day").alias("fiscalDateEnding"), F.col("o_totalprice").cast("string").alias("totalRevenue"), F.col("o_orderkey").cast("string").alias("reportedKey"), "o_orderstatus")

    def text(x: Column) -> Column:
        return F.to_json(F.struct(F.filter(x, lambda r: r["o_orderstatus"] == "F").alias("annualReports"), F.filter(x, lambda r: r["o_orderstatus"] != "F").alias("quarterlyReports")))

    texts = _texts(o, ["o_custkey"], ["o_orderkey", "o_totalprice", "day"], row, text)
    names = {"total_revenue": "totalRevenue", "reported_key": "reportedKey"}
    return P.listed_reports(texts, "payload", ["o_custkey"], "annualReports", names).unionByName(P.listed_reports(texts, "payload", ["o_custkey"], "quarterlyReports", names))


REPORTS_JSON = """
SELECT o_custkey, CASE WHEN o_orderstatus = 'F' THEN 'annualReports' ELSE 'quarterlyReports' END AS report_type, o_orderdate::DATE AS date, o_totalprice AS total_revenue, o_orderkey::DOUBLE AS reported_key FROM orders"""


def earnings_json(spark: SparkSession, d: str) -> DataFrame:
    """Each customer's orders as reported quarters; some without a fiscal date, surprises in percent or absolute."""
    k = F.col("o_orderkey")
    eps = (F.col("o_totalprice") / 100000).cast("string")
    row = F.struct(F.when(k % 7 != 0, F.col("day")).otherwise("").alias("fiscalDateEnding"), F.col("day").alias("reportedDate"), eps.alias("reportedEPS"),
                   F.when(k % 2 == 0, "1.5").otherwise("None").alias("estimatedEPS"), F.when(k % 3 == 0, F.lit("12.5")).alias("surprisePercentage"), (k % 10).cast("string").alias("surprise"))
    texts = _texts(_orders(spark, d), ["o_custkey"], ["o_orderkey", "o_totalprice", "day"], row, lambda x: F.to_json(F.struct(x.alias("quarterlyEarnings"))))
    return P.earnings_history(texts, "payload", ["o_custkey"])


EARNINGS_JSON = """
SELECT o_custkey, o_orderdate::DATE AS date, o_orderdate::DATE AS report_date, o_totalprice / 100000 AS reported_eps, CASE WHEN o_orderkey % 2 = 0 THEN 1.5::DOUBLE END AS eps_estimate,
  CASE WHEN o_orderkey % 3 = 0 THEN 0.125::DOUBLE ELSE (o_orderkey % 10)::DOUBLE END AS surprise, 'actual' AS record_type FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey, o_orderdate::DATE ORDER BY o_orderkey DESC, o_totalprice DESC) = 1"""


def adjusted_csv(spark: SparkSession, d: str) -> DataFrame:
    """Region bars as monthly adjusted-daily CSV texts; blanks and a line without a date inside."""
    b = daily_bars(spark, d).withColumn("month", F.date_format("date", "yyyy-MM"))
    ten = F.dayofmonth("date") % 10 == 0
    line = F.concat_ws(",", F.date_format("date", "yyyy-MM-dd"), F.col("close").cast("string"), F.when(ten, F.col("volume").cast("string")).otherwise(""), F.when(ten, "2.0").otherwise("None"))
    head = F.lit("timestamp,close,Dividend Amount,split_coefficient")
    texts = _texts(b, ["symbol", "month"], ["date"], line, lambda x: F.concat_ws("\n", head, F.array_join(x, "\n"), F.lit(",1,2,3\n")))
    return P.corporate_actions(texts, "payload", ["symbol"])


ADJUSTED_CSV = f"""
WITH {BD} SELECT symbol, date, CASE WHEN day(date) % 10 = 0 THEN volume ELSE 0.0 END AS dividend_amount, CASE WHEN day(date) % 10 = 0 THEN 2.0::DOUBLE ELSE 1.0 END AS split_coefficient FROM bars"""


def earnings_csv(spark: SparkSession, d: str) -> DataFrame:
    """Orders as calendar CSV lines of each customer and year, and per symbol whether the universe has it, its lines and last date."""
    o = _orders(spark, d).withColumn("year", F.substring("day", 1, 4))
    line = F.concat_ws(",", F.concat(F.lit(" c"), F.col("o_custkey").cast("string")), F.col("day"), F.col("o_totalprice").cast("string"))
    texts = _texts(o, ["o_custkey", "year"], ["o_orderkey", "o_totalprice", "day"], line, lambda x: F.concat_ws("\n", F.lit("symbol,reportDate,estimate"), F.array_join(x, "\n")))
    rows = P.csv_fields(texts, "payload", ["o_custkey", "year"], ["symbol", "report_date", "estimate"]).withColumn("symbol", F.upper("symbol")).where("symbol is not null")
    universe = table(spark, d, "customer").where("c_acctbal > 0").select(F.concat(F.lit("C"), F.col("c_custkey").cast("string")).alias("symbol"), F.lit(True).alias("matched")).distinct()
    per = rows.groupBy("symbol").agg(F.count(F.lit(1)).alias("n"), F.max(P.day_of(F.col("report_date"))).alias("last_report"), F.max(P.number(F.col("estimate"))).alias("highest"))
    return per.join(universe, "symbol", "left").withColumn("matched", F.coalesce("matched", F.lit(False)))


EARNINGS_CSV = """
SELECT 'C' || o_custkey AS symbol, count(*) AS n, max(o_orderdate)::DATE AS last_report, max(o_totalprice) AS highest, o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0) AS matched
FROM orders GROUP BY o_custkey"""


def ticker_json(spark: SparkSession, d: str) -> DataFrame:
    """Suppliers of each nation as pages of listing records; blank and repeated symbols inside."""
    s = table(spark, d, "supplier").withColumn("page", F.expr("s_suppkey div 100"))
    k = F.col("s_suppkey")
    row = F.struct(F.when(k % 11 == 0, " ").otherwise(F.concat(F.lit(" s"), (k % 50).cast("string"))).alias("ticker"), F.col("s_name").alias("name"), F.when(k % 2 == 0, "XNYS").otherwise(" ").alias("primary_exchange"),
                   F.lit("CS").alias("type"), F.when(F.col("s_acctbal") > 0, True).otherwise(False).alias("active"))
    texts = _texts(s, ["s_nationkey", "page"], ["s_suppkey", "s_name", "s_acctbal"], row, F.to_json)
    return P.ticker_list(texts, "payload", ["s_nationkey", "page"])


TICKER_JSON = """
SELECT 'S' || (s_suppkey % 50) AS symbol, s_name AS name, CASE WHEN s_suppkey % 2 = 0 THEN 'XNYS' END AS exchange, 'CS' AS asset_type, s_acctbal > 0 AS active FROM supplier WHERE s_suppkey % 11 <> 0
QUALIFY row_number() OVER (PARTITION BY s_suppkey % 50 ORDER BY s_nationkey, s_suppkey, s_name, s_acctbal) = 1"""


def vendor_batch(spark: SparkSession, d: str) -> DataFrame:
    """Each customer's orders as a vendor's batch; odd names, a field that tells the future, equal rows."""
    o = _orders(spark, d)
    row = F.create_map(F.lit("Ticker"), F.when(F.col("o_orderkey") % 2 == 0, F.concat(F.lit("c"), F.col("o_custkey").cast("string"))).otherwise(" "), F.lit("Holding Symbol"), F.lit(" h "),
                       F.lit("% Change"), F.col("o_orderstatus"), F.lit("ExcessReturn"), F.col("o_totalprice").cast("string"))
    texts = _texts(o.withColumn("r", row), ["o_custkey"], ["o_orderkey", "o_totalprice", "day"], F.to_json("r"), lambda x: F.concat(F.lit("["), F.array_join(x, ","), F.lit("]")))
    return P.vendor_batch(texts, "payload", "holdings", ["Ticker", "Holding Symbol"])


VENDOR_BATCH = """
WITH r AS (SELECT DISTINCT CASE WHEN o_orderkey % 2 = 0 THEN 'c' || o_custkey ELSE ' ' END AS t, o_orderstatus AS s FROM orders),
p AS (SELECT CASE WHEN t = ' ' THEN 'H' ELSE upper(t) END AS symbol, 'holdings' AS dataset, '{"pct_change":"' || s || '","holding_symbol":" h ","ticker":"' || t || '"}' AS payload FROM r)
SELECT *, sha256('holdings|' || payload) AS source_hash FROM p"""


def series_json(spark: SparkSession, d: str) -> DataFrame:
    """Hourly event bars as daily time-series payloads with numbered names."""
    b = hourly_bars(spark, d).withColumn("day", F.to_date("ts"))
    row = F.struct(F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("at"), *[F.col(c).cast("string").alias(c) for c in ("open", "volume")])

    def text(x: Column) -> Column:
        entries = F.transform(x, lambda y: F.struct(y["at"], F.create_map(F.lit("1. open"), y["open"], F.lit("5. volume"), y["volume"])))
        return F.to_json(F.create_map(F.lit("Time Series"), F.map_from_entries(entries)))

    texts = _texts(b, ["symbol", "day"], ["ts"], row, text)
    s = P.series_of(texts, "payload")
    return s.select("symbol", F.to_timestamp("moment").alias("ts"), *[P.number(F.col("values")[c]).alias(c) for c in ("open", "volume")])


SERIES_JSON = f"WITH {BH} SELECT symbol, ts, open, volume FROM bars"


def register_all(register) -> None:
    for name, fn, sql in (
        ("statement_json", statement_json, STATEMENT_JSON), ("valuation_json", valuation_json, VALUATION_JSON), ("history_json", history_json, HISTORY_JSON), ("reports_json", reports_json, REPORTS_JSON),
        ("earnings_json", earnings_json, EARNINGS_JSON), ("adjusted_csv", adjusted_csv, ADJUSTED_CSV), ("earnings_csv", earnings_csv, EARNINGS_CSV), ("ticker_json", ticker_json, TICKER_JSON),
        ("vendor_batch", vendor_batch, VENDOR_BATCH), ("series_json", series_json, SERIES_JSON),
    ):
        register(name, fn, sql)
