"""Table folders: bucketed and versioned Parquet, file helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeloom.operators.maintain import bucket_letter


def write_buckets(df: DataFrame, path: str, symbol: str = "symbol", codec: str = "snappy", mode: str = "overwrite") -> None:
    """Parquet by letter bucket; only touched buckets are replaced when ``mode`` is overwrite."""
    out = df.withColumn("bucket", bucket_letter(F.col(symbol)))
    out.write.mode(mode).option("compression", codec).option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(path)


def read_buckets(spark: SparkSession, path: str, buckets: list[str] | None = None, columns: dict[str, str] | None = None) -> DataFrame:
    """Buckets of a table (pruned by folder), projected to declared columns; missing ones are null."""
    df = spark.read.parquet(path)
    if buckets is not None:
        df = df.where(F.col("bucket").isin(*buckets))
    return declared(df, columns) if columns else df


def declared(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """The declared columns with their types; missing ones are null, others left out."""
    have = set(df.columns)
    return df.select([(F.col(c).cast(t) if c in have else F.lit(None).cast(t)).alias(c) for c, t in columns.items()])


def write_version(df: DataFrame, path: str, version: int) -> None:
    df.write.mode("errorifexists").parquet(f"{path}/version={version}")


def read_version(spark: SparkSession, path: str, version: int, columns: dict[str, str] | None = None, rows: Column | None = None) -> DataFrame:
    """A table as it was at a version: its declared columns, and the rows asked for; both reach the scan."""
    df = spark.read.parquet(f"{path}/version={version}")
    df = declared(df, columns) if columns else df
    return df if rows is None else df.where(rows)


def table_or_none(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The table, or an empty one of the declared schema where nothing is there."""
    from pyspark.errors import AnalysisException

    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def layer_stats(df: DataFrame, date: str | None = None) -> DataFrame:
    """Rows, files and bytes of what a table reads, and the first and last ``date`` if one is named."""
    at = F.col(date) if date else F.lit(None).cast("date")
    files = df.select(F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_size").alias("s"), at.alias("d"))
    per = files.groupBy("f").agg(F.first("s").alias("s"), F.count(F.lit(1)).alias("n"), F.min("d").alias("lo"), F.max("d").alias("hi"))
    out = per.agg(F.sum("n").alias("rows"), F.count(F.lit(1)).alias("files"), F.sum("s").alias("bytes"), F.min("lo").alias("first"), F.max("hi").alias("last"))
    return out if date else out.drop("first", "last")
