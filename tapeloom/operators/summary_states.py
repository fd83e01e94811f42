"""Summaries of tables from stored states: one mergeable state per bucket, merged without reading rows again, told as JSON documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_DOCUMENT = (
    "scope string, table string, bucket string, symbolCount long, rowCount long, columns array<string>, columnCount int, "
    "dateRange struct<min:string, max:string, column:string, source:string>, estimatedValues map<string,double>"
)


def bucket_states(df: DataFrame, bucket: str, symbol: str, date: str, numbers: list[str] = ()) -> DataFrame:
    """A state per bucket: rows, symbols exactly and as a sketch, first and last day, filled columns, and quantile sketches.

    A column counts as filled if any of its values in the bucket is not null.
    Sketches are of fixed size, so a state is, whatever it sums up.
    """
    others = [c for c in df.columns if c != bucket]
    filled = F.array_compact(F.array(*[F.when(F.count(c) > 0, F.lit(c)) for c in others]))
    return df.groupBy(F.col(bucket).alias("bucket")).agg(
        F.count(F.lit(1)).alias("rows"), F.countDistinct(symbol).alias("symbols"), F.hll_sketch_agg(F.coalesce(F.col(symbol).cast("string"), F.lit(""))).alias("symbol_sketch"),
        F.min(date).alias("first"), F.max(date).alias("last"), filled.alias("columns"),
        *[F.kll_sketch_agg_double(F.col(c).cast("double")).alias(f"sketch_{c}") for c in numbers],
    )


def merged(states: DataFrame, *keys: str, numbers: list[str] = ()) -> DataFrame:
    """Final summaries from states: sums, extremes, the union of columns in their order, and merged sketches.

    ``symbols`` adds up the buckets' exact counts, which is right where a symbol
    lies in one bucket; ``symbols_estimated`` holds where they overlap, within
    two hundredths. No row of the table is read again.
    """
    columns = F.array_distinct(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("bucket", "columns"))), lambda x: x["columns"])))
    return states.groupBy(*keys).agg(
        F.sum("rows").alias("rows"), F.sum("symbols").alias("symbols"), F.hll_sketch_estimate(F.hll_union_agg("symbol_sketch")).alias("symbols_estimated"),
        F.min("first").alias("first"), F.max("last").alias("last"), columns.alias("columns"),
        *[F.kll_sketch_get_quantile_double(F.kll_merge_agg_double(f"sketch_{c}"), F.lit(0.5)).alias(f"median_{c}") for c in numbers],
    )


def documents(summary: DataFrame, scope: str, table: str, date: str, numbers: list[str] = ()) -> DataFrame:
    """Summaries as JSON documents of one layout; ``bucket`` is null in one of the whole table."""
    bucket = F.col("bucket") if "bucket" in summary.columns else F.lit(None).cast("string")
    numbers_told = F.create_map(*[x for c in numbers for x in (F.lit(c), F.col(f"median_{c}"))]) if numbers else F.lit(None).cast("map<string,double>")
    span = F.when(F.col("first").isNotNull(), F.struct(
        F.date_format("first", "yyyy-MM-dd").alias("min"), F.date_format("last", "yyyy-MM-dd").alias("max"), F.lit(date).alias("column"), F.lit("partition").alias("source")))
    told = F.struct(
        F.lit(scope).alias("scope"), F.lit(table).alias("table"), bucket.alias("bucket"), F.col("symbols").alias("symbolCount"), F.col("rows").alias("rowCount"),
        "columns", F.size("columns").alias("columnCount"), span.alias("dateRange"), numbers_told.alias("estimatedValues"))
    return summary.select(F.to_json(told).alias("value"))


def write_documents(documents: DataFrame, path: str) -> None:
    documents.write.mode("overwrite").text(path)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).select(F.from_json("value", _DOCUMENT).alias("d")).select("d.*")
