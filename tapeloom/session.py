"""Session defaults for local runs and the reader every query uses."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession


def local_session(app: str = "tapeloom", cpus: int | str = "*", **conf: str) -> SparkSession:
    """A single-JVM session for tests and benchmarks; a cluster job brings its own."""
    b = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "12g"))
        .config("spark.sql.adaptive.enabled", "true")
    )
    for k, v in conf.items():
        b = b.config(k.replace("__", "."), v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table; a Parquet file or a folder of Parquet files."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; where that is unset, a temporary one of this machine, but only in local mode."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if spark.sparkContext.getCheckpointDir() is None:
        import re
        import tempfile

        if re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master) is None:
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")

        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tapeloom-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it again: what follows sees fixed rows, and lost executors cost their tasks only."""
    import uuid

    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
