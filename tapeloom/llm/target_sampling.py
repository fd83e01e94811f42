"""Importance resampling towards a target's word runs, drawn by a parallel sort by regular sampling.

Runs of one to three words fall into buckets by crc32. A bucket's gain tells how
much commoner it is in the target than in the source; a document's weight is the
sum of its gains, read from an array. Weight plus Gumbel noise ranks documents:
the highest are a draw without replacement in proportion to the weights.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapeloom.llm.bpe import slices
from tapeloom.llm.workspace import staged

BUCKETS = 10_000
LONGEST_RUN = 3
#: Texts above this are read in pieces.
PIECE_BYTES = 1_000_000
#: Sorted runs, samples over all runs, and segments of the parallel sort; none grows with the data.
RUNS, SAMPLES, SEGMENTS = 256, 1 << 16, 1024

# Fixed value: what stands between words, before A-Z are lower-cased.
_BETWEEN = re.compile(rb"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]")
_INSIDE = np.ones(256, dtype=bool)
_INSIDE[np.frombuffer(b"".join(_BETWEEN.findall(bytes(range(256)))), dtype=np.uint8)] = False
_LOWER = np.frombuffer(bytes(range(256)).lower(), dtype=np.uint8)


def _zero_bytes() -> tuple[np.ndarray, np.ndarray]:
    """Tables that carry a crc32 over n zero bytes: for n below 64, and for n = 2**k."""
    byte = np.array([zlib.crc32(bytes([b])) for b in range(256)], dtype=np.uint32)
    one = byte ^ byte[0]  # linear part: what a register's low byte becomes
    state = np.arange(256, dtype=np.uint32)[None, :] << (np.arange(4, dtype=np.uint32) * np.uint32(8))[:, None]
    short = [state]
    for _ in range(63):
        state = one[state & np.uint32(255)] ^ (state >> np.uint32(8))
        short.append(state)
    powers = [short[1]]
    for _ in range(31):
        powers.append(_carried(powers[-1], powers[-1]))
    return np.stack(short), np.stack(powers)


def _carried(crc: np.ndarray, table: np.ndarray) -> np.ndarray:
    mask = np.uint32(255)
    out = table[0][crc & mask]
    for i in (1, 2, 3):
        out = out ^ table[i][(crc >> np.uint32(8 * i)) & mask]
    return out


_SHORT, _POWERS = _zero_bytes()
_SHORT_FLAT = _SHORT.reshape(-1)


def joined_crc(left: np.ndarray, right: np.ndarray, right_bytes: np.ndarray) -> np.ndarray:
    """crc32 of strings put together, from those of their halves and the length of the right one."""
    n = np.minimum(right_bytes, 63).astype(np.int64) * 1024
    out = right.copy()
    for i in range(4):
        out ^= _SHORT_FLAT[n + (256 * i + ((left >> np.uint32(8 * i)) & np.uint32(255)))]
    for at in np.flatnonzero(right_bytes > 63).tolist():
        crc, rest = left[at : at + 1], int(right_bytes[at])
        for k in range(rest.bit_length()):
            if rest >> k & 1:
                crc = _carried(crc, _POWERS[k])
        out[at] = crc[0] ^ right[at]
    return out


class Runs:
    """The word runs of some texts: for every word, the buckets of the runs that end with it."""

    def __init__(self, raw: np.ndarray, stops: np.ndarray, skip: np.ndarray, buckets: int, longest: int):
        """``stops``: where each text ends in ``raw``; ``skip``: leading words that only begin runs."""
        inside = _INSIDE[raw]
        before = np.zeros(len(raw), dtype=bool)
        before[1:] = inside[:-1]
        edges = stops[stops < len(raw)]
        before[edges] = False
        first = np.flatnonzero(inside & ~before)
        letters = _LOWER[raw[inside]]
        offsets = np.append(np.cumsum(inside)[first] - 1, len(letters)).astype(np.int64)
        words = pa.Array.from_buffers(pa.large_binary(), len(first), [None, pa.py_buffer(offsets), pa.py_buffer(letters)]).dictionary_encode()
        known = words.dictionary.to_pylist()
        which = words.indices.to_numpy()
        alone = np.fromiter((zlib.crc32(w) for w in known), dtype=np.uint32, count=len(known))[which]
        behind = np.fromiter((zlib.crc32(b" " + w) for w in known), dtype=np.uint32, count=len(known))[which]
        size = np.diff(offsets) + 1
        last = np.searchsorted(first, stops, side="left")
        start = np.concatenate(([0], last[:-1])).astype(np.int64)
        self.n_words = last - start - skip
        place = np.arange(len(first)) - np.repeat(start, last - start)
        new = place >= np.repeat(skip, last - start)
        #: for each run length, the words that end such a run, and its bucket
        self.ends: list[tuple[np.ndarray, np.ndarray]] = []
        crc = alone
        for n in range(longest):
            if n:
                far = np.zeros_like(crc)
                far[1:] = joined_crc(crc[:-1], behind[1:], size[1:])
                crc = far
            at = np.flatnonzero(new & (place >= n))
            self.ends.append((at, (crc[at] % np.uint32(buckets)).astype(np.int64)))
        self.start, self.last, self.total = start, last, len(first)

    def counts(self, buckets: int) -> np.ndarray:
        out = np.zeros(buckets, dtype=np.int64)
        for _, found in self.ends:
            out += np.bincount(found, minlength=buckets)
        return out

    def sums(self, gains: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each text: how many runs it has, and the sum of their gains."""
        each = np.zeros(self.total, dtype=np.int64)
        many = np.zeros(self.total, dtype=np.int64)
        for at, found in self.ends:
            each[at] += gains[found]
            many[at] += 1
        upto = [np.concatenate(([0], np.cumsum(x))) for x in (many, each)]
        return tuple(x[self.last] - x[self.start] for x in upto)


def _pieces(data: bytes, longest: int) -> Iterator[tuple[bytes, int]]:
    """A long text in pieces that end between words; each begins with the words that runs still need, told by their number."""
    at, carried = 0, []
    while at < len(data):
        border = _BETWEEN.search(data, at + PIECE_BYTES)
        stop = border.end() if border else len(data)
        yield b" ".join([*carried, data[at:stop]]), len(carried)
        if border:
            # the last words of the piece, found from behind
            tail, back = [], stop
            while back > at and len(tail) < longest - 1:
                while back > at and not _INSIDE[data[back - 1]]:
                    back -= 1
                end = back
                while back > at and _INSIDE[data[back - 1]]:
                    back -= 1
                if end > back:
                    tail.insert(0, data[back:end])
            carried = [*carried, *tail][-(longest - 1) :] if longest > 1 else []
        at = stop


def _text_runs(batch: pa.RecordBatch, column: int, buckets: int, longest: int) -> Iterator[tuple[Runs, np.ndarray]]:
    """The runs of a slice's texts, with the row of each text; a long text comes in several pieces."""
    texts = pc.fill_null(batch.column(column).cast(pa.large_string()), "")
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.array([], dtype=np.uint8)
    if len(texts) == 1 and len(raw) > PIECE_BYTES:
        for piece, skip in _pieces(raw.tobytes(), longest):
            yield Runs(np.frombuffer(piece, dtype=np.uint8), np.array([len(piece)]), np.array([skip]), buckets, longest), np.array([0])
    else:
        yield Runs(raw, offsets[1:] - offsets[0], np.zeros(len(texts), dtype=np.int64), buckets, longest), np.arange(len(texts))


def bucket_counts(df: DataFrame, text_col: str = "text", buckets: int = BUCKETS, longest: int = LONGEST_RUN) -> np.ndarray:
    """How often each bucket is met in all whole texts of a table.

    Every task adds up its own texts and sends ``buckets`` rows at most. Null
    texts have no words; an empty table gives zeros.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, dtype=np.int64)
        for batch in slices(batches, 0):
            for runs, _ in _text_runs(batch, 0, buckets, longest):
                total += runs.counts(buckets)
        met = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(met, pa.int64()), pa.array(total[met], pa.int64())], names=["bucket", "n"])

    rows = df.select(F.col(text_col).cast("string").alias("text")).mapInArrow(run, "bucket long, n long")
    out = np.zeros(buckets, dtype=np.int64)
    for bucket, n in rows.groupBy("bucket").agg(F.sum("n")).collect():
        out[bucket] = n
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * ln of the smoothed ratio target / source) of every bucket, in doubles."""
    buckets, all_s, all_t = len(source), float(source.sum()), float(target.sum())
    return np.array(
        [math.floor(1000 * math.log(((t + 1.0) * (all_s + buckets)) / ((s + 1.0) * (all_t + buckets)))) for s, t in zip(source.tolist(), target.tolist(), strict=True)],
        dtype=np.int64,
    )


def weigh(df: DataFrame, gain: np.ndarray, id_col: str = "doc_id", text_col: str = "text", longest: int = LONGEST_RUN) -> DataFrame:
    """``id_col, n_words, n_features, weight`` of every whole text; the gains are an array of fixed size in each task."""
    key, buckets = df.schema[id_col].dataType.simpleString(), len(gain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            words, many, weight = (np.zeros(batch.num_rows, dtype=np.int64) for _ in range(3))
            for runs, rows in _text_runs(batch, 1, buckets, longest):
                n, w = runs.sums(gain)
                words[rows] += runs.n_words
                many[rows] += n
                weight[rows] += w
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(x) for x in (words, many, weight)]], names=[id_col, "n_words", "n_features", "weight"])

    picked = df.select(id_col, F.col(text_col).cast("string").alias(text_col))
    return picked.mapInArrow(run, f"`{id_col}` {key}, n_words long, n_features long, weight long")


def gumbel(key: Column, seed: int) -> Column:
    """floor of 1000 times Gumbel noise that the seed and the key decide."""
    first = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256).substr(1, 8)
    unit = (F.conv(first, 16, 10).cast("double") + F.lit(0.5)) / F.lit(4294967296.0)
    return F.floor(F.lit(-1000.0) * F.log(-F.log(unit))).cast("long")


def _order_key(score: np.ndarray, key: pa.Array, row: np.ndarray) -> np.ndarray:
    """Byte strings that sort as (score descending, key ascending with nulls first, row) does."""
    sign = np.uint64(1 << 63)
    ids = pc.fill_null(key, 0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
    parts = np.zeros(len(score), dtype=[("score", ">u8"), ("known", "u1"), ("key", ">u8"), ("row", ">u8"), ("end", "u1")])
    parts["score"] = ~(score.astype(np.int64).view(np.uint64) ^ sign)
    parts["known"] = pc.is_valid(key).to_numpy(zero_copy_only=False)
    parts["key"] = ids ^ sign
    parts["row"] = row.astype(np.int64).view(np.uint64)
    parts["end"] = 1  # numpy ignores zeros at the end
    return parts.view("S26").reshape(-1)


def draw(df: DataFrame, most: int, id_col: str = "doc_id", score_col: str = "score") -> DataFrame:
    """``df`` with ``rank``: 1, 2, 3... of the ``most`` rows with the highest scores, ties to the smaller id; null for others.

    Rows with a null score are not drawn. A parallel sort by regular sampling:
    each of at most RUNS partitions sorts its rows and gives every n-th one, so
    SAMPLES + RUNS come together in all; sorted, they give regular splitters, by
    which every row knows its segment. Counts of segments say which segments
    the draw reaches and what comes before each. Only those are exchanged; each
    is ordered by itself, and the prefix count makes its ranks exact. A segment
    holds N / SEGMENTS + N * RUNS / SAMPLES rows at most: equal scores and ids
    are told apart by the row's place, so no tie can fill one.

    ``df`` is staged once, which fixes those places. Repeated ids are rows of
    their own; an empty table or ``most`` of 0 draws nothing.
    """
    rows = staged(df.withColumns({"_row": F.monotonically_increasing_id(), "_key": F.col(id_col).cast("long"), "_score": F.col(score_col).cast("long")}), "scored")
    able = rows.where(F.col("_score").isNotNull())
    total = able.count()
    if not total or most <= 0:
        return rows.select(*df.columns, F.lit(None).cast("long").alias("rank"))
    order = [F.col("_score").desc(), F.col("_key").asc_nulls_first(), F.col("_row")]
    stride = -(-total // SAMPLES)

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = 0
        for batch in batches:
            at = np.arange(-seen % stride, batch.num_rows, stride)
            seen += batch.num_rows
            picked = batch.take(pa.array(at))
            keys = _order_key(picked.column(0).to_numpy(), picked.column(1), picked.column(2).to_numpy())
            yield pa.RecordBatch.from_arrays([pa.array(keys.tolist(), pa.binary())], names=["sample"])

    keyed = able.select("_score", "_key", "_row")
    taken = keyed.coalesce(RUNS).sortWithinPartitions(*order).mapInArrow(sample, "sample binary").toArrow()
    taken = np.sort(np.array(taken.column("sample").to_pylist(), dtype="S26"))
    splitters = taken[np.unique(np.arange(1, SEGMENTS) * len(taken) // SEGMENTS)]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            head = batch.num_columns - 3
            score = batch.column(head + 2)
            keys = _order_key(pc.fill_null(score, 0).to_numpy(zero_copy_only=False), batch.column(head + 1), batch.column(head).to_numpy())
            segment = pa.array(np.searchsorted(splitters, keys, side="right"), pa.int32(), mask=pc.is_null(score).to_numpy(zero_copy_only=False))
            yield pa.RecordBatch.from_arrays([*batch.columns, segment], names=[*batch.schema.names, "_segment"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    placed = staged(rows.mapInArrow(place, f"{kinds}, _segment int"), "segments")
    sizes = placed.where("_segment is not null").groupBy("_segment").count().orderBy("_segment").collect()  # SEGMENTS rows at most
    before, reached = [0] * SEGMENTS, -1
    upto = 0
    for segment, n in sizes:
        before[segment] = upto
        if upto < most:
            reached = segment
        upto += n
    near = F.coalesce(F.col("_segment") <= reached, F.lit(False))
    inside = F.row_number().over(Window.partitionBy("_segment").orderBy(*order))
    base = F.element_at(F.expr(f"array({', '.join(map(str, before[: reached + 1]))})").cast("array<long>"), F.col("_segment") + 1)
    ranked = placed.where(near).withColumn("rank", base + inside)
    return ranked.select(*df.columns, F.when(F.col("rank") <= most, F.col("rank")).alias("rank")).unionByName(
        placed.where(~near).select(*df.columns, F.lit(None).cast("long").alias("rank"))
    )


def resample(
    docs: DataFrame,
    target: DataFrame,
    percent: int = 5,
    least_words: int = 20,
    seed: int = 42,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_text_col: str = "text",
    buckets: int = BUCKETS,
    longest: int = LONGEST_RUN,
) -> DataFrame:
    """``id_col, n_words, n_features, weight, score, rank`` of every document.

    Words are runs of 0-9, a-z (A-Z lower-cased) and all characters beyond
    ASCII; features are runs of up to ``longest`` of them, repeats counted. Of
    the N documents with ``least_words`` words or more, floor(percent * N / 100)
    are drawn: those of the highest scores, ties to the smaller id.

    Null and empty texts have no words and a weight of 0. Null ids count as an
    empty string in the noise and come first in ties; repeated rows are drawn by
    themselves. Empty tables give no rows; an empty target leaves the smoothing
    alone. Other columns are not read. Both passes over the texts need no exchange
    of them; counts of buckets and their gains are arrays of fixed size.
    """
    source = bucket_counts(docs, text_col, buckets, longest)
    gain = gains(source, bucket_counts(target, target_text_col, buckets, longest))
    weighed = weigh(docs, gain, id_col, text_col, longest).withColumn("score", F.col("weight") + gumbel(F.col(id_col), seed))
    able = F.col("n_words") >= least_words
    weighed = staged(weighed.withColumn("_drawable", F.when(able, F.col("score"))), "weights")
    most = percent * weighed.where("_drawable is not null").count() // 100
    return draw(weighed, most, id_col, "_drawable").drop("_drawable")
