"""Tables that change by staged batches, scans that skip files, versions, summary documents, drift of columns, and views."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeloom.operators import gates, maintain, summary_states
from tapeloom.plans.fixtures import BD, daily_bars
from tapeloom.session import shared_folder, table
from tapeloom.sources import staged, tables


def _new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def _orders(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_orderstatus", "o_totalprice")


def staged_sink(spark: SparkSession, d: str) -> DataFrame:
    """Finished orders, then a restated half that speaks for two customers of three in full, the same batch again, and one more; the table read back, with what each batch did."""
    o = _orders(spark, d)
    target = staged.StagedTable(spark, _new_path(spark, "staged"), "o_custkey long, o_orderkey long, o_orderstatus string, o_totalprice double", ["o_custkey", "o_orderkey"])
    half = o.where("o_orderkey % 2 = 0").withColumn("o_totalprice", F.when(F.col("o_orderkey") % 3 == 0, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")))
    late = o.where("o_orderkey % 50 = 1").withColumn("o_orderstatus", F.lit(None).cast("string"))
    for name, batch, scope in (("first", o.where("o_orderstatus <> 'P'"), None), ("second", half, o.where("o_custkey % 3 <> 0")), ("second", half, o), ("third", late, None)):
        target.apply(batch, name, scope)
    rows = target.read().withColumn("batch", F.lit("table"))
    log = target.log().select("batch", F.expr("stack(4, 'inserted', inserted, 'updated', updated, 'deleted', deleted, 'unchanged', unchanged) as (o_orderstatus, o_orderkey)"))
    # a batch only counts rows of buckets it touches as unchanged, so that number is left out
    return rows.unionByName(log.where("o_orderstatus <> 'unchanged'"), allowMissingColumns=True)


STAGED = """
WITH a AS (SELECT o_custkey, o_orderkey, o_orderstatus AS s, o_totalprice AS p FROM orders WHERE o_orderstatus <> 'P'),
h AS (SELECT o_custkey, o_orderkey, o_orderstatus AS s, CASE WHEN o_orderkey % 3 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS p FROM orders WHERE o_orderkey % 2 = 0),
j AS (
  SELECT coalesce(a.o_custkey, h.o_custkey) AS o_custkey, coalesce(a.o_orderkey, h.o_orderkey) AS o_orderkey, coalesce(h.s, a.s) AS s, coalesce(h.p, a.p) AS p,
    CASE WHEN a.o_orderkey IS NULL THEN 'inserted' WHEN h.o_orderkey IS NULL THEN CASE WHEN a.o_custkey % 3 <> 0 THEN 'deleted' END WHEN a.s IS DISTINCT FROM h.s OR a.p IS DISTINCT FROM h.p THEN 'updated' END AS op
  FROM a FULL JOIN h ON a.o_custkey = h.o_custkey AND a.o_orderkey = h.o_orderkey
), b AS (SELECT * FROM j WHERE op IS DISTINCT FROM 'deleted'), l AS (SELECT o_custkey, o_orderkey, o_totalprice AS p FROM orders WHERE o_orderkey % 50 = 1),
k AS (
  SELECT coalesce(b.o_custkey, l.o_custkey) AS o_custkey, coalesce(b.o_orderkey, l.o_orderkey) AS o_orderkey, CASE WHEN l.o_orderkey IS NULL THEN b.s END AS s, coalesce(l.p, b.p) AS p,
    CASE WHEN b.o_orderkey IS NULL THEN 'inserted' WHEN l.o_orderkey IS NOT NULL THEN 'updated' END AS op
  FROM b FULL JOIN l ON b.o_custkey = l.o_custkey AND b.o_orderkey = l.o_orderkey
)
SELECT o_custkey, o_orderkey, s AS o_orderstatus, p AS o_totalprice, 'table' AS batch FROM k
UNION ALL SELECT NULL, count(*), 'inserted', NULL, 'first' FROM a UNION ALL SELECT NULL, 0, unnest(['updated', 'deleted']), NULL, 'first'
UNION ALL SELECT NULL, count_if(op = o), o, NULL, 'second' FROM j, (SELECT unnest(['inserted', 'updated', 'deleted']) AS o) GROUP BY o
UNION ALL SELECT NULL, count_if(op = o), o, NULL, 'third' FROM k, (SELECT unnest(['inserted', 'updated', 'deleted']) AS o) GROUP BY o"""


def symbol_index(spark: SparkSession, d: str) -> DataFrame:
    """A sorted index of customers' symbols in ranges; symbols inserted twice, then the index of some letters replaced in full."""
    c = table(spark, d, "customer").select(F.concat_ws(".", "c_mktsegment", F.lpad(F.col("c_custkey").cast("string"), 9, "0")).alias("symbol"), "c_custkey")
    rows = c.withColumn("bucket", maintain.bucket_letter(F.col("symbol")))
    index = staged.StagedTable(spark, _new_path(spark, "symbols"), "symbol string, bucket string", ["symbol"], splits=staged.prefix_splits(c, "symbol", 8))
    index.apply(rows.where("c_custkey % 2 = 0"), "even")
    index.apply(rows.where("c_custkey % 3 = 0"), "third")
    touched = rows.where("bucket in ('B', 'M')")
    index.apply(touched.where("c_custkey % 5 <> 0"), "letters", touched)
    return index.read()


INDEX = """
WITH c AS (SELECT c_mktsegment || '.' || lpad(c_custkey::VARCHAR, 9, '0') AS symbol, substr(c_mktsegment, 1, 1) AS bucket, c_custkey AS k FROM customer)
SELECT symbol, bucket FROM c WHERE CASE WHEN bucket IN ('B', 'M') THEN k % 5 <> 0 ELSE k % 2 = 0 OR k % 3 = 0 END"""

_BARS = "symbol string, date date, open double, high double, low double, close double, volume double"


def as_of_scan(spark: SparkSession, d: str) -> DataFrame:
    """Region bars in files by symbol and date; two columns of two symbols between two days, from the files that hold them."""
    path = _new_path(spark, "zoned")
    staged.write_zoned(daily_bars(spark, d).select(*[c.split()[0] for c in _BARS.split(", ")]), path, "date", files=24)
    return staged.scan_zoned(spark, path, _BARS, ["symbol", "date", "close"], "date", "1995-03-01", "1996-02-10", ["ASIA", "EUROPE", "NOWHERE"])


SCAN = f"WITH {BD} SELECT symbol, date, close FROM bars WHERE symbol IN ('ASIA', 'EUROPE') AND date BETWEEN DATE '1995-03-01' AND DATE '1996-02-10'"


def table_versions(spark: SparkSession, d: str) -> DataFrame:
    """An older version of a table with a filter and some columns, a newer one, and a table that is not there."""
    path = _new_path(spark, "versions")
    o = _orders(spark, d)
    tables.write_version(o.where("o_orderstatus = 'F'"), path, 0)
    tables.write_version(o.drop("o_orderstatus"), path, 1)
    declared = {"o_orderkey": "bigint", "o_orderstatus": "string", "o_totalprice": "double"}
    parts = [tables.read_version(spark, path, v, declared, F.col("o_totalprice") > 100000).withColumn("version", F.lit(v)) for v in (0, 1)]
    none = tables.table_or_none(spark, f"{path}/version=7", ", ".join(f"{k} {v}" for k, v in declared.items())).withColumn("version", F.lit(7))
    return maintain.union_all(*parts, none)


VERSIONS = """
SELECT o_orderkey, o_orderstatus, o_totalprice, 0 AS version FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 100000
UNION ALL SELECT o_orderkey, NULL, o_totalprice, 1 FROM orders WHERE o_totalprice > 100000"""


def summary_documents(spark: SparkSession, d: str) -> DataFrame:
    """States of each letter of customers' orders stored, merged into one summary, all written as JSON documents and read back."""
    path = _new_path(spark, "summaries")
    o = table(spark, d, "orders").join(table(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment"), "o_custkey")
    rows = o.select(maintain.bucket_letter(F.col("c_mktsegment")).alias("letter"), F.concat_ws(".", "c_mktsegment", F.col("o_custkey").cast("string")).alias("symbol"), F.to_date("o_orderdate").alias("date"),
                    "o_totalprice", F.when(F.col("c_mktsegment").startswith("B"), F.col("o_orderpriority")).alias("priority"), F.lit(None).cast("string").alias("note"))
    summary_states.bucket_states(rows, "letter", "symbol", "date", ["o_totalprice"]).write.parquet(f"{path}/states")
    states = spark.read.parquet(f"{path}/states")
    parts = summary_states.documents(summary_states.merged(states, "bucket", numbers=["o_totalprice"]), "bucket", "orders", "date", ["o_totalprice"])
    whole = summary_states.documents(summary_states.merged(states, numbers=["o_totalprice"]), "domain", "orders", "date", ["o_totalprice"])
    summary_states.write_documents(parts.unionByName(whole), f"{path}/documents")
    back = summary_states.read_documents(spark, f"{path}/documents")
    return back.select("scope", "bucket", "symbolCount", "rowCount", F.array_join("columns", ",").alias("columns"), "columnCount", "dateRange.min", "dateRange.max")


DOCUMENTS = """
WITH r AS (SELECT substr(c_mktsegment, 1, 1) AS bucket, o_custkey, o_orderdate::DATE AS date FROM orders JOIN customer ON c_custkey = o_custkey)
SELECT CASE WHEN grouping(bucket) = 1 THEN 'domain' ELSE 'bucket' END AS scope, bucket, count(DISTINCT o_custkey) AS "symbolCount", count(*) AS "rowCount",
  'symbol,date,o_totalprice' || CASE WHEN bool_or(bucket = 'B') THEN ',priority' ELSE '' END AS columns, (3 + bool_or(bucket = 'B')::INTEGER)::INTEGER AS "columnCount",
  strftime(min(date), '%Y-%m-%d') AS min, strftime(max(date), '%Y-%m-%d') AS max
FROM r GROUP BY GROUPING SETS ((bucket), ())"""


def column_drift(spark: SparkSession, d: str) -> DataFrame:
    """Q3, Q4: how orders and the bars made of lines differ from what is declared: missing, extra, retyped and moved columns, with how many rows each table has."""
    o = table(spark, d, "orders")
    want = {"o_custkey": "bigint", "o_orderkey": "string", "o_orderdate": "timestamp", "o_clerk": "string", "o_totalprice": "double"}
    found = [gates.schema_drift(df, w).withColumn("table", F.lit(n)).crossJoin(F.broadcast(df.agg(F.count(F.lit(1)).alias("rows"))))  # one row
             for n, df, w in (("orders", o.withColumn("o_orderdate", F.col("o_orderdate").cast("timestamp")), want), ("bars", daily_bars(spark, d), {c.split()[0]: c.split()[1] for c in _BARS.split(", ")}))]
    return found[0].unionByName(found[1])


DRIFT = """
SELECT 'orders' AS "table", c AS "column", k AS drift, (SELECT count(*) FROM orders) AS rows
FROM (VALUES ('o_clerk', 'missing'), ('o_orderstatus', 'extra'), ('o_orderpriority', 'extra'), ('o_orderkey', 'type'), ('o_orderkey', 'order'), ('o_custkey', 'order'), ('o_orderdate', 'order'), ('o_totalprice', 'order')) v(c, k)"""


def register_all(register) -> None:
    for name, fn, sql in (
        ("staged_sink", staged_sink, STAGED), ("symbol_index", symbol_index, INDEX), ("as_of_scan", as_of_scan, SCAN), ("table_versions", table_versions, VERSIONS),
        ("summary_documents", summary_documents, DOCUMENTS), ("column_drift", column_drift, DRIFT),
    ):
        register(name, fn, sql)
