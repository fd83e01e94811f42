"""Tables that change by staged batches, all or nothing, and scans that open only the files they need.

Everything is written by Spark's own writers into folders that all executors
see. A batch becomes visible with one small log entry, so a batch that fails
leaves the table as it was, and a batch that comes again changes nothing.
"""

from __future__ import annotations

import zlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeloom.sources.tables import table_or_none

_LOG = "n long, batch string, buckets array<struct<bucket:int, folder:string, rows:long>>, inserted long, updated long, deleted long, unchanged long"


class StagedTable:
    """A table of ``schema`` with unique ``keys``, kept in buckets of which a batch rewrites the touched ones only.

    Buckets are ranges of ``bucket_by`` (one of the keys) between ``splits``
    where these are given, so the table is a list of sorted runs and a batch is
    merged into the runs it falls into; else hashes of ``bucket_by``, ``buckets``
    of them. Within a bucket rows are dealt by key range and sorted, so one with
    a large share of all rows is still several tasks and files.
    """

    def __init__(self, spark: SparkSession, path: str, schema: str, keys: Sequence[str], bucket_by: str | None = None, buckets: int = 16, splits: Sequence | None = None):
        self.spark, self.path, self.keys = spark, path.rstrip("/"), list(keys)
        self.bucket_by, self.buckets, self.splits = bucket_by or self.keys[0], buckets, None if splits is None else sorted(splits)
        self.fields = spark.createDataFrame([], schema).schema
        if self.bucket_by not in self.keys:
            raise ValueError(f"{self.bucket_by} is no key of the table")

    def bucket(self) -> Column:
        key = F.col(self.bucket_by)
        if self.splits is None:
            return F.pmod(F.xxhash64(key), F.lit(self.buckets)).cast("int")
        return F.size(F.filter(F.array(*[F.lit(s) for s in self.splits]).cast(f"array<{self.fields[self.bucket_by].dataType.simpleString()}>"), lambda s: s <= key)).cast("int")

    def log(self) -> DataFrame:
        """An entry per applied batch: what it did, and where every bucket lies after it."""
        return table_or_none(self.spark, f"{self.path}/log", _LOG)

    def _state(self) -> tuple[int, dict[int, tuple[str, int]]]:
        last = self.log().orderBy(F.desc("n")).limit(1).collect()
        return (last[0]["n"], {b["bucket"]: (b["folder"], b["rows"]) for b in last[0]["buckets"]}) if last else (0, {})

    def _rows(self, state: dict[int, tuple[str, int]], only: set[int] | None = None) -> DataFrame:
        folders = [f"{self.path}/data/{folder}/_bucket={b}" for b, (folder, _) in sorted(state.items()) if only is None or b in only]
        return self.spark.read.schema(self.fields).parquet(*folders) if folders else self.spark.createDataFrame([], self.fields)

    def read(self, only: set[int] | None = None) -> DataFrame:
        """The table as of its last entry, or some of its buckets."""
        return self._rows(self._state()[1], only)

    def apply(self, batch: DataFrame, name: str | int, scope: DataFrame | None = None) -> dict[str, int] | None:
        """Bring the table to what ``batch`` says, all or nothing; None where the batch of this name was applied before.

        New keys are inserted, others updated where any column differs (nulls
        compared as values). ``scope`` lists values of ``bucket_by`` that the
        batch speaks for in full: their rows that it lacks are deleted. Keys that
        are null or come twice end the batch before anything is seen of it.
        Other columns of ``batch`` are not read; the order of writers is kept by
        the entry's number, which only one of two can take.
        """
        name, log = str(name), self.log()
        if not log.where(F.col("batch") == name).isEmpty():
            return None
        number, state = self._state()
        folder = f"{number + 1:08d}-{zlib.crc32(name.encode()):08x}"
        columns = self.fields.names
        staged_at = f"{self.path}/stage/{folder}"
        batch.select(*[F.col(c).cast(self.fields[c].dataType).alias(c) for c in columns]).withColumn("_b", self.bucket()).write.mode("overwrite").parquet(staged_at)
        stage = self.spark.read.parquet(staged_at)
        missing = stage.where(" or ".join(f"`{k}` is null" for k in self.keys))
        if not missing.isEmpty() or not stage.groupBy(*self.keys).count().where("count > 1").isEmpty():
            raise ValueError(f"batch {name} has keys that are null or come twice")
        said = stage.select("_b")
        if scope is not None:
            scope = scope.select(F.col(self.bucket_by).cast(self.fields[self.bucket_by].dataType).alias(self.bucket_by)).distinct()
            said = said.unionByName(scope.select(self.bucket().alias("_b")))
        touched = {r["_b"] for r in said.distinct().collect()}  # as many as there are buckets at most
        values = [c for c in columns if c not in self.keys] or self.keys
        old = self._rows(state, touched).select(*self.keys, F.struct(*columns).alias("_old"))
        if scope is not None:
            old = old.join(scope.withColumn("_in", F.lit(True)), self.bucket_by, "left")
        both = old.join(stage.select(*self.keys, F.struct(*columns).alias("_new")), self.keys, "full_outer")
        gone = F.col("_new").isNull() & (F.coalesce("_in", F.lit(False)) if scope is not None else F.lit(False))
        same = F.col("_new").isNull() | F.struct(*[F.col("_new")[v] for v in values]).eqNullSafe(F.struct(*[F.col("_old")[v] for v in values]))
        both = both.withColumn("_op", F.when(F.col("_old").isNull(), "inserted").when(gone, "deleted").when(same, "unchanged").otherwise("updated"))
        after = both.where("_op <> 'deleted'").select("_op", F.coalesce("_new", "_old").alias("_r")).select("_op", "_r.*").withColumn("_bucket", self.bucket())
        filled: dict[int, dict[str, int]] = {}
        if touched:
            after.repartitionByRange("_bucket", *self.keys).sortWithinPartitions("_bucket", *self.keys).write.mode("overwrite").partitionBy("_bucket").parquet(f"{self.path}/data/{folder}")
            filled = self._counts(folder)
        did = {op: sum(n.get(op, 0) for n in filled.values()) for op in ("inserted", "updated", "unchanged")}
        did["deleted"] = sum(n for b, (_, n) in state.items() if b in touched) - did["updated"] - did["unchanged"]
        after_state = {b: v for b, v in state.items() if b not in touched} | {b: (folder, sum(n.values())) for b, n in filled.items()}
        entry = [(number + 1, name, [(b, f, n) for b, (f, n) in sorted(after_state.items())], *[did[op] for op in ("inserted", "updated", "deleted", "unchanged")])]
        self.spark.createDataFrame(entry, _LOG).coalesce(1).drop("n").write.mode("errorifexists").parquet(f"{self.path}/log/n={number + 1}")
        return did

    def _counts(self, folder: str) -> dict[int, dict[str, int]]:
        """How many rows of every bucket of the folder were inserted, updated or left; as many numbers as there are buckets, thrice, at most."""
        written = table_or_none(self.spark, f"{self.path}/data/{folder}", "_op string, _bucket int")
        out: dict[int, dict[str, int]] = {}
        for r in written.groupBy("_bucket", "_op").count().collect():
            out.setdefault(r["_bucket"], {})[r["_op"]] = r["count"]
        return out


def prefix_splits(df: DataFrame, column: str, runs: int, letters: int = 2) -> list[str]:
    """Prefixes between which about equally many values lie; the counts of prefixes reach the driver, one row each."""
    counts = df.groupBy(F.substring(column, 1, letters).alias("p")).count().where("p is not null").orderBy("p").collect()
    total, seen, out = sum(r["count"] for r in counts), 0, []
    for r in counts:
        if seen and seen * runs >= total * (len(out) + 1):
            out.append(r["p"])
        seen += r["count"]
    return out


def stream_into(stream: DataFrame, target: StagedTable, checkpoint: str) -> None:
    """Apply what a stream has, a batch at a time, each once by its number, and stop."""
    q = stream.writeStream.foreachBatch(lambda batch, number: target.apply(batch, number) and None).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()


_ZONE = "path string, low_as_of timestamp, high_as_of timestamp, low_symbol string, high_symbol string, rows long"


def write_zoned(df: DataFrame, path: str, as_of: str, symbol: str = "symbol", files: int | None = None) -> None:
    """Write a table ordered by symbol and time, with a table beside it of what each file spans."""
    order = [symbol, as_of]
    df.repartitionByRange(*([files] if files else []), *order).sortWithinPartitions(*order).write.mode("overwrite").parquet(f"{path}/rows")
    written = df.sparkSession.read.schema(df.schema).parquet(f"{path}/rows")
    at = F.col(as_of).cast("timestamp")
    zones = written.groupBy(F.col("_metadata.file_path").alias("path")).agg(
        F.min(at).alias("low_as_of"), F.max(at).alias("high_as_of"), F.min(symbol).alias("low_symbol"), F.max(symbol).alias("high_symbol"), F.count(F.lit(1)).alias("rows"))
    zones.write.mode("overwrite").parquet(f"{path}/zones")


def scan_zoned(spark: SparkSession, path: str, schema: str, columns: Sequence[str], as_of: str, start: str | None = None, end: str | None = None, symbols: Sequence[str] | None = None, symbol: str = "symbol") -> DataFrame:
    """Some columns of the rows whose time lies in [start, end] and whose symbol is asked for.

    Only files whose span can hold such rows are listed, so neither their footers
    nor their rows are read otherwise; in them the same conditions are pushed to
    the row groups. No ``symbols`` (None) asks for all; an empty list for none.
    """
    zones = table_or_none(spark, f"{path}/zones", _ZONE)
    rows = F.lit(True)
    if start is not None:
        zones, rows = zones.where(F.col("high_as_of") >= F.lit(start).cast("timestamp")), rows & (F.col(as_of) >= F.lit(start).cast("timestamp"))
    if end is not None:
        zones, rows = zones.where(F.col("low_as_of") <= F.lit(end).cast("timestamp")), rows & (F.col(as_of) <= F.lit(end).cast("timestamp"))
    if symbols is not None:
        wanted = F.array(*[F.lit(s) for s in symbols]).cast("array<string>")
        zones = zones.where(F.exists(wanted, lambda s: s.between(F.col("low_symbol"), F.col("high_symbol"))))
        rows = rows & F.col(symbol).isin(*symbols)
    found = sorted(r["path"] for r in zones.select("path").collect())  # file names, as any scan lists
    table = spark.read.schema(schema).parquet(*found) if found else spark.createDataFrame([], schema)
    return table.where(rows).select(*columns)
