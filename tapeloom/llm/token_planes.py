"""Token ids in binary files: fixed-size blocks as bit or byte planes, each plane a zstd frame, with a chunk index.

A file is ``MAGIC``, the planes of its chunks, the chunk index, the document
index, a tail of fixed size and one line feed (the end of the row that Spark's
text writer committed). A chunk is a block of ``block_ids`` ids (the last one of
a file may be shorter): its ids are written as little-endian 32-bit numbers and
transposed, so that all lowest bits (or bytes) lie together, then all second
ones, and so on; planes above the largest id are left out. The chunk index has
a row per chunk (offset, ids, kind, crc32 of the ids, bytes of every plane), the
document index a row per document (key, ids); both are Arrow streams.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tapeloom.llm.bpe import slices
from tapeloom.llm.rank_bpe import loaded_ranks

MAGIC = b"IDPLANE1"
KINDS = ("byte", "bit")
BLOCK_IDS = 1 << 16
#: A file ends with the document that brings it to so many ids.
FILE_IDS = 1 << 24
#: Ids that a reader gives out at a time.
BATCH_IDS = 1 << 21
#: part, ids of the part before this file, ids here, bytes of both indexes, crc32 of the two, MAGIC
TAIL = struct.Struct("<QQQQQI8s")


def to_planes(block: np.ndarray, kind: str) -> list[bytes]:
    """The planes of a block, lowest first, without those above its largest id."""
    bits = int(block.max(initial=0)).bit_length()
    octets = block.astype("<u4").view(np.uint8).reshape(-1, 4)
    if kind == "byte":
        return [octets[:, i].tobytes() for i in range(-(-bits // 8))]
    spread = np.unpackbits(octets, axis=1, bitorder="little")
    return [np.packbits(spread[:, i], bitorder="little").tobytes() for i in range(bits)]


def from_planes(planes: list[bytes], n: int, kind: str) -> np.ndarray:
    """The ``n`` ids of a block; ValueError where a plane has another length."""
    if kind == "byte":
        octets = np.zeros((n, 4), dtype=np.uint8)
        for i, plane in enumerate(planes):
            octets[:, i] = _exactly(plane, n)
        return octets.view("<u4").reshape(-1)
    spread = np.zeros((n, 32), dtype=np.uint8)
    for i, plane in enumerate(planes):
        spread[:, i] = np.unpackbits(_exactly(plane, (n + 7) // 8), bitorder="little", count=n)
    return np.packbits(spread, axis=1, bitorder="little").view("<u4").reshape(-1)


def _exactly(plane: bytes, n: int) -> np.ndarray:
    if len(plane) != n:
        raise ValueError(f"a plane holds {len(plane)} bytes instead of {n}")
    return np.frombuffer(plane, dtype=np.uint8)


def _stream(table: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as out:
        out.write_batch(table)
    return zstandard.ZstdCompressor().compress(sink.getvalue().to_pybytes())


def _unstream(data: bytes) -> pa.Table:
    return pa.ipc.open_stream(zstandard.ZstdDecompressor().decompress(data)).read_all()


class FileWriter:
    """Gathers documents' ids and gives the file; only compressed chunks and one block are held."""

    def __init__(self, part: int, base: int, kind: str = "byte", block_ids: int = BLOCK_IDS, level: int = 3):
        if kind not in KINDS:
            raise ValueError(f"planes are {' or '.join(KINDS)}, not {kind}")
        self.part, self.base, self.kind, self.block_ids = part, base, kind, block_ids
        self.pack = zstandard.ZstdCompressor(level=level, write_content_size=True)
        self.done: list[bytes] = []
        self.at = len(MAGIC)
        self.chunks: list[tuple[int, int, int, int, list[int]]] = []
        self.keys: list = []
        self.sizes: list[int] = []
        self.open: list[np.ndarray] = []
        self.n_open = self.n_ids = 0

    def add(self, key: object, ids: np.ndarray) -> None:
        self.keys.append(key)
        self.sizes.append(len(ids))
        self.open.append(ids)
        self.n_open += len(ids)
        self.n_ids += len(ids)
        if self.n_open >= self.block_ids:
            flat = np.concatenate(self.open)
            whole = len(flat) // self.block_ids * self.block_ids
            for i in range(0, whole, self.block_ids):
                self._chunk(flat[i : i + self.block_ids])
            self.open, self.n_open = [flat[whole:].copy()], len(flat) - whole

    def _chunk(self, block: np.ndarray) -> None:
        planes = [self.pack.compress(p) for p in to_planes(block, self.kind)]
        self.chunks.append((self.at, len(block), KINDS.index(self.kind), zlib.crc32(block.astype("<u4").tobytes()), [len(p) for p in planes]))
        self.done += planes
        self.at += sum(map(len, planes))

    def close(self, key_type: pa.DataType) -> bytes:
        if self.n_open:
            self._chunk(np.concatenate(self.open))
        kinds = (pa.int64(), pa.int64(), pa.int8(), pa.int64(), pa.list_(pa.int64()))
        columns = list(zip(*self.chunks, strict=True)) or [()] * len(kinds)
        index = _stream(pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["offset", "ids", "kind", "crc32", "planes"]))
        docs = _stream(pa.RecordBatch.from_arrays([pa.array(self.keys, key_type), pa.array(self.sizes, pa.int64())], names=["key", "ids"]))
        tail = TAIL.pack(self.part, self.base, self.n_ids, len(index), len(docs), zlib.crc32(index + docs), MAGIC)
        return b"".join([MAGIC, *self.done, index, docs, tail])


def tail_of(content: bytes) -> tuple[int, ...]:
    """What a file's tail tells; ValueError where there is none, or it cannot be right."""
    data = memoryview(content)
    end = len(data) - TAIL.size - 1
    if end < len(MAGIC) or bytes(data[: len(MAGIC)]) != MAGIC or data[-1] != 10:
        raise ValueError("no file of token planes, or cut off")
    *told, mark = TAIL.unpack(data[end:-1])
    if mark != MAGIC or told[3] + told[4] > end - len(MAGIC):
        raise ValueError("the tail is damaged")
    return tuple(told)


class FileReader:
    """One file's indexes; chunks are decompressed when ids in them are asked for."""

    def __init__(self, content: bytes):
        data = memoryview(content)
        self.part, self.base, self.n_ids, n_index, n_docs, told = tail_of(content)
        end = len(data) - TAIL.size - 1
        indexes = bytes(data[end - n_index - n_docs : end])
        if zlib.crc32(indexes) != told:
            raise ValueError("an index is damaged")
        self.data, self.chunks, docs = data, _unstream(indexes[:n_index]), _unstream(indexes[n_index:])
        self.keys, sizes = docs.column("key"), docs.column("ids").to_numpy()
        self.stops = np.cumsum(sizes)
        self.starts = self.stops - sizes
        self.chunk_stops = np.cumsum(self.chunks.column("ids").to_numpy())
        if self.n_ids != int(sizes.sum()) or self.n_ids != (int(self.chunk_stops[-1]) if len(self.chunk_stops) else 0):
            raise ValueError("the indexes disagree about the number of ids")
        self.unpack = zstandard.ZstdDecompressor()

    def chunk(self, i: int) -> np.ndarray:
        """The ids of chunk ``i``, checked."""
        row = self.chunks.slice(i, 1).to_pylist()[0]
        planes, at = [], row["offset"]
        for n in row["planes"]:
            planes.append(self.unpack.decompress(self.data[at : at + n]))
            at += n
        ids = from_planes(planes, row["ids"], KINDS[row["kind"]])
        if zlib.crc32(ids.tobytes()) != row["crc32"]:
            raise ValueError(f"chunk {i} does not have its checksum")
        return ids

    def ids(self, start: int, stop: int) -> np.ndarray:
        """Ids ``start`` to ``stop`` of this file; only the chunks that hold them are read."""
        if start >= stop:
            return np.array([], dtype="<u4")
        first = int(np.searchsorted(self.chunk_stops, start, side="right"))
        last = int(np.searchsorted(self.chunk_stops, stop, side="left"))
        before = int(self.chunk_stops[first - 1]) if first else 0
        return np.concatenate([self.chunk(i) for i in range(first, last + 1)])[start - before : stop - before]


def write_ids(
    df: DataFrame,
    path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    separator: int = 0,
    planes: str = "byte",
    vocabulary: str | None = None,
    block_ids: int = BLOCK_IDS,
    file_ids: int = FILE_IDS,
    partitions: int | None = None,
    level: int = 3,
) -> None:
    """Encode every row's whole text, append ``separator``, and write all ids below ``path`` in ascending order of ``id_col``.

    Rows are dealt to ranges of (id, hash of the text, place in the input), the
    one exchange there is, so a repeated id, however often it occurs, is spread
    over as many tasks as its rows ask for. A range is sorted, encoded and
    written as one or more files; each tells its range and how many ids of the
    range came before it. A task holds one file's compressed chunks at most.
    Spark's own writer commits the files, so a lost executor costs its tasks only.

    Null texts count as empty (the separator alone); null ids come first;
    repeated ids and rows are all written, by their texts' hashes. No rows leave
    no files. Other columns are not read. A document is never split over files.
    """
    rows = df.select(F.col(id_col).alias("key"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), F.monotonically_increasing_id().alias("row"))
    order = [F.col("key"), F.xxhash64("text"), F.col("row")]
    dealt = rows.repartitionByRange(*([partitions] if partitions else []), *order).sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, part, base = loaded_ranks(vocabulary), TaskContext.get().partitionId(), 0
        end = np.array([separator], dtype=np.uint32)
        file, kind = None, None

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([file.close(kind)], pa.binary())], names=["file"])

        for batch in slices(batches, 1):
            kind = batch.schema.field(0).type
            for key, ids in zip(batch.column(0).to_pylist(), bpe.encode(batch.column(1).to_pylist()), strict=True):
                file = file or FileWriter(part, base, planes, block_ids, level)
                file.add(key, np.concatenate((ids.astype(np.uint32), end)))
                if file.n_ids >= file_ids:
                    yield out()
                    file, base = None, base + file.n_ids
        if file is not None:
            yield out()

    files = dealt.select("key", "text").mapInArrow(run, "file binary")
    files.select(F.col("file").cast("string").alias("value")).write.option("maxRecordsPerFile", 1).text(path)


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).where("length > 0").select("content")


def part_starts(spark: SparkSession, path: str) -> DataFrame:
    """``part, first``: ids of all documents before each range; a row per range, of which a job has ``partitions`` at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                part, base, n, *_ = tail_of(content.as_buffer())
                yield pa.RecordBatch.from_arrays([pa.array([part], pa.int64()), pa.array([base + n], pa.int64())], names=["part", "stop"])

    sizes = _files(spark, path).mapInArrow(run, "part long, stop long").groupBy("part").agg(F.max("stop").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))


def read_ids(spark: SparkSession, path: str, id_col: str = "doc_id", id_type: str = "long", with_ids: bool = True) -> DataFrame:
    """Documents of the files below ``path``: ``id_col, start, n_tokens, ids_crc32`` and, ``with_ids``, ``ids``.

    ``start`` counts the ids of all documents before this one, over all files.
    ``ids_crc32`` is that of the ids as little-endian unsigned 32-bit numbers.
    Every chunk is checked against its index; a damaged file ends the job with
    the reason. No files give no rows.
    """
    names = ["key", "part", "at", "n_tokens", "ids_crc32", *["ids"] * with_ids]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                file = FileReader(content.as_buffer())
                first = 0
                while first < len(file.starts):
                    until = int(np.searchsorted(file.stops, int(file.starts[first]) + BATCH_IDS, side="right"))
                    last = max(first + 1, until)
                    begin, end = int(file.starts[first]), int(file.stops[last - 1])
                    ids = file.ids(begin, end)
                    cuts = (file.starts[first:last] - begin).tolist() + [end - begin]
                    crcs = [zlib.crc32(ids[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]
                    n = last - first
                    arrays = [
                        file.keys.slice(first, n).combine_chunks(), pa.array([file.part] * n, pa.int64()), pa.array(file.starts[first:last] + file.base, pa.int64()),
                        pa.array(file.stops[first:last] - file.starts[first:last], pa.int64()), pa.array(crcs, pa.int64()),
                    ]
                    if with_ids:
                        arrays.append(pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(ids.astype(np.int32))))
                    yield pa.RecordBatch.from_arrays(arrays, names=names)
                    first = last

    rows = _files(spark, path).mapInArrow(run, f"key {id_type}, part long, at long, n_tokens long, ids_crc32 long" + ", ids array<int>" * with_ids)
    return rows.join(F.broadcast(part_starts(spark, path)), "part").select(
        F.col("key").alias(id_col), (F.col("first") + F.col("at")).alias("start"), "n_tokens", "ids_crc32", *["ids"] * with_ids
    )
