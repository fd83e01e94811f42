"""Stable shards by jump consistent hashing, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Multiplier of the 64-bit linear congruential generator that jump
# consistent hashing draws from, and the width of the draws it uses.
LCG_MULTIPLIER = 2862933555777941757
DRAW_BITS = 31

_WORD = "cast(18446744073709551616 as decimal(38,0))"


def _state(key: Column) -> Column:
    """The key as an unsigned 64-bit number (null counts as 0)."""
    whole = F.coalesce(key.cast("decimal(38,0)"), F.lit(0).cast("decimal(38,0)"))
    return F.pmod(whole, F.expr(_WORD)).cast("decimal(20,0)")


def _step(state: Column) -> Column:
    """One step of the generator, modulo 2**64."""
    wide = state.cast("decimal(20,0)") * F.lit(LCG_MULTIPLIER).cast("decimal(19,0)")
    return F.pmod((wide + F.lit(1).cast("decimal(1,0)")).cast("decimal(38,0)"), F.expr(_WORD)).cast("decimal(20,0)")


def jump_hash(key: Column, counts: list[int]) -> Column:
    """Struct with one int field ``s<n>`` for every shard count in ``counts``.

    The walk of jump consistent hashing is the same for every count: the shard
    for ``n`` is the last landing place below ``n``. One walk up to the largest
    count therefore answers all of them; appending a shard moves only the rows
    whose walk lands on it.
    """
    most = max(counts)
    start = F.struct(
        F.lit(0).cast("long").alias("j"),
        _state(key).alias("k"),
        *[F.lit(0).cast("int").alias(f"s{n}") for n in counts],
    )

    def move(acc: Column, _: Column) -> Column:
        nxt = _step(acc["k"])
        draw = F.floor(nxt / F.lit(1 << (64 - DRAW_BITS)).cast("decimal(20,0)")).cast("long")
        jump = F.floor(
            (acc["j"] + 1).cast("double") * (F.lit(float(1 << DRAW_BITS)) / (draw + 1).cast("double"))
        ).cast("long")
        moved = F.struct(
            jump.alias("j"),
            nxt.alias("k"),
            *[F.when(acc["j"] < n, acc["j"].cast("int")).otherwise(acc[f"s{n}"]).alias(f"s{n}") for n in counts],
        )
        return F.when(acc["j"] >= most, acc).otherwise(moved)

    # a walk takes at most one step per shard; steps past the end change nothing
    return F.aggregate(F.sequence(F.lit(1), F.lit(most)), start, move)


def _bucket(key: Column, crc: Column, buckets: int) -> Column:
    """A stable sub-bucket of a shard, from middle bits of the first draw and the text's checksum, so that a repeated key is spread."""
    first = F.floor(_step(_state(key)) / F.lit(1 << 20).cast("decimal(20,0)")).cast("decimal(20,0)")
    return F.pmod(F.pmod(first, F.lit(buckets).cast("decimal(10,0)")).cast("long") + crc, F.lit(buckets)).cast("int")


def assign_shards(
    df: DataFrame,
    n_shards: int = 24,
    key_col: str = "doc_id",
    text_col: str = "text",
    slot_buckets: int = 256,
) -> DataFrame:
    """Shard and slot of every row.

    Returns ``key_col, size, text_crc32, law, shard, slot, grown_shard``; other
    columns of ``df`` are not read. ``law`` is ``key``: the key and the shard
    count alone decide the shard, and with one shard more (``grown_shard``) a
    row stays or moves to the new shard. ``size`` is the text's UTF-8 bytes
    plus 8.

    Slots number each shard's rows from 0 without gaps, by (bucket, key, crc,
    size). They are counted in two levels, ``n_shards * slot_buckets`` groups,
    so no task holds a whole shard; the table of group sizes has exactly that
    many rows at most, at any input size, and is the only thing broadcast. A
    key that very many rows share (or the null key) lies in one shard, as the
    law says, but in as many groups as its texts have checksums modulo that.

    Null keys count as key 0, null texts as empty (size 8, crc of nothing).
    Repeated rows get slots of their own. An empty table gives no rows.
    """
    cols = df.select(F.col(key_col).alias("_key"), F.col(text_col).alias("_text"))
    placed = cols.select(
        "_key",
        (F.coalesce(F.octet_length("_text"), F.lit(0)).cast("long") + F.lit(8)).alias("size"),
        F.crc32(F.coalesce(F.col("_text"), F.lit("")).cast("binary")).alias("text_crc32"),
        jump_hash(F.col("_key"), [n_shards, n_shards + 1]).alias("_at"),
        _bucket(F.col("_key"), F.crc32(F.coalesce(F.col("_text"), F.lit("")).cast("binary")), slot_buckets).alias("_bucket"),
    )
    where = F.col("_at")
    placed = placed.select(
        "_key", "size", "text_crc32", "_bucket",
        where[f"s{n_shards}"].alias("shard"), where[f"s{n_shards + 1}"].alias("grown_shard"),
    )
    sizes = placed.groupBy("shard", "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("shard").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("shard", "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    inside = Window.partitionBy("shard", "_bucket").orderBy("_key", "text_crc32", "size")
    return (
        placed.withColumn("_rank", F.row_number().over(inside))
        .join(F.broadcast(starts), ["shard", "_bucket"])
        .select(
            F.col("_key").alias(key_col),
            "size",
            "text_crc32",
            F.lit("key").alias("law"),
            "shard",
            (F.col("_start") + F.col("_rank") - 1).cast("long").alias("slot"),
            "grown_shard",
        )
    )
