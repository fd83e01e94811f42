"""Exact self-join of shingle sets at a Jaccard similarity, by universe partition.

Two sets of sizes a and b reach the similarity only if at most
``(a + b) * (1 - s) / (1 + s)`` shingles lie in just one of them. Each
shingle is a segment; in large bands they may be hashed into segments of about
four. Taking the segments in a fixed order, the first ``budget + 1`` that hold anything
cannot all differ, so one of them is equal in both sets and serves as a key
(pigeonhole). Where the allocation finds it cheaper, a segment counts twice:
it then also gives the keys of all its subsets with one shingle deleted, which
meet when the segments differ by one. Segments of common shingles come last in
the order and are used only by sets that have too little else.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapeloom.llm.bpe import slices
from tapeloom.llm.components import connected_components
from tapeloom.llm.shingles import mixed, shingle_sets
from tapeloom.llm.workspace import staged

#: Counters of the shingle sketch (a power of two) and the blocks it is summed in.
SKETCH_BITS, SKETCH_BLOCK_BITS = 20, 14
#: Least and most bytes of a set's signature: counts of its shingles by bucket.
SIGNATURE, LONGEST_SIGNATURE = 128, 4096
#: Leading bits of ids or nodes in the bitmaps that spare work; they bound what is broadcast.
LEAD_BITS = 18
#: Ratio of the sizes that a band covers.
BAND_RATIO = 3
#: Bands up to this size do not count double: there a set's shingles may fall into too few hashed segments.
OWN_SEGMENTS = 81
#: Up to so many sets behind one key are paired outright; more are tied to the first of them.
SMALL_RUN = 8
#: Sets of one block, and their shingles together; a task compares two blocks.
BLOCK, BLOCK_SHINGLES = 2048, 2_000_000
#: Plausible pairs for each set of two blocks beyond which they are compared in full instead.
CROWD = 4
#: Tasks among which the rows of a pivot with more than one block are dealt before they go to their blocks.
SALTS = 64
#: Sets a task remembers so as to index equal ones once.
SEEN_SETS = 400_000


@dataclass(frozen=True)
class Bound:
    """Similarity as a ratio of whole numbers: ``den * shared >= num * united``."""

    num: int = 75
    den: int = 100

    def budget(self, a: np.ndarray | int, b: np.ndarray | int) -> np.ndarray | int:
        """Shingles that may lie in just one of two sets."""
        return (a + b) * (self.den - self.num) // (self.den + self.num)

    def largest_partner(self, n: int) -> int:
        return n * self.den // self.num

    def lead(self, n: int) -> int:
        """So many of a set's ``n`` shingles, the first in an order that all sets share, hold one that any partner has among its own."""
        return n - (n * self.num + self.den - 1) // self.den + 1


@dataclass(frozen=True)
class Band:
    """Sizes below ``upper``; ``segments`` of uncommon shingles; ``double`` if they count twice."""

    upper: int
    segments: int
    double: bool


def band_uppers(largest: int) -> list[int]:
    out = [BAND_RATIO]
    while out[-1] <= largest:
        out.append(out[-1] * BAND_RATIO)
    return [*out, out[-1] * BAND_RATIO]


def allocate(upper: int, population: int, rate: float, bound: Bound) -> Band:
    """The cheaper of two allocations for a band.

    Single counting takes each shingle as a segment of its own and
    pays a key for each of the first ``lead``; double counting takes segments of
    about four shingles and pays five keys for two. Each key also costs the sets
    that share it by chance: ``population * rate ** shingles`` of them.
    """
    need = bound.budget(upper, bound.largest_partner(upper)) + 1
    single = bound.lead(upper) * (1 + population * rate)
    wide = max(1, upper // 4)
    each = upper / wide
    double = -(-need // 2) * (1 + each) * (1 + population * rate ** max(1.0, each - 1))
    if upper > OWN_SEGMENTS and 2 * wide >= need and double < single:
        return Band(upper, wide, True)
    return Band(upper, upper, False)


def signature_of(s: np.ndarray) -> bytes:
    """Counts by bucket, a bucket for about three shingles; the number of buckets is a power of two."""
    n = min(LONGEST_SIGNATURE, max(SIGNATURE, 1 << max(0, (len(s) // 4)).bit_length()))
    return np.minimum(np.bincount((s >> np.uint64(40)).astype(np.int64) % n, minlength=n), 255).astype(np.uint8).tobytes()


def _folded(signatures: np.ndarray, width: int) -> np.ndarray:
    """Signatures of one length as counts in fewer buckets; counts that reached 255 stay marked by a large number."""
    wide = signatures.astype(np.int32)
    wide[signatures == 255] = 1 << 20
    return wide.reshape(len(wide), -1, width).sum(axis=1)


def nodes_of(sets: list[np.ndarray], clashing: frozenset[int] = frozenset()) -> tuple[np.ndarray, np.ndarray]:
    """Each set's own number (its shingles' sum after mixing, mixed with its size) and a second, independent one.

    Where two different sets have the same number (``clashing``), the second takes its place.
    """
    size = np.fromiter(map(len, sets), dtype=np.int64, count=len(sets))
    out = []
    if not len(sets) or not size.any():
        return np.zeros(len(sets), dtype=np.int64), np.zeros(len(sets), dtype=np.int64)
    flat = np.concatenate(sets)
    full = np.flatnonzero(size)
    begin = (np.cumsum(size) - size)[full]
    for salt in (0xA5A5A5A5, 0x3C6EF372FE94F82B):
        got = np.zeros(len(sets), dtype=np.uint64)
        got[full] = mixed(np.add.reduceat(mixed(flat ^ np.uint64(salt)), begin) + size[full].astype(np.uint64))
        out.append(got.view(np.int64))
    if clashing:
        hit = np.isin(out[0], np.array(list(clashing), dtype=np.int64))
        out[0][hit] = out[1][hit]
    return out[0], out[1]


def describe(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One pass over the texts: a row per document (size, node, check, signature) and each task's part of the sketch.

    Sketch rows have a null ``n``; ``block`` and ``counts`` hold counters of one block.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = np.zeros(1 << SKETCH_BITS, dtype=np.int64)
        for batch in slices(batches, 1):
            sets = shingle_sets(batch.column(1).to_pylist())
            everything = np.concatenate([*sets, np.array([], dtype=np.uint64)])
            sketch += np.bincount((everything >> np.uint64(64 - SKETCH_BITS)).astype(np.int64), minlength=len(sketch))
            m, n = len(sets), np.fromiter(map(len, sets), dtype=np.int64, count=len(sets))
            node, check = nodes_of(sets)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n), pa.array(node, mask=n == 0), pa.array(check, mask=n == 0),
                 pa.array([signature_of(s) if len(s) else None for s in sets], pa.binary()),
                 pa.nulls(m, pa.int32()), pa.nulls(m, pa.binary())],
                names=["id", "n", "node", "check", "signature", "block", "counts"],
            )
        blocks = sketch.reshape(-1, 1 << SKETCH_BLOCK_BITS)
        used = np.flatnonzero(blocks.any(axis=1))
        packed = [zlib.compress(blocks[i].astype("<i8").tobytes(), 1) for i in used.tolist()]
        none = [pa.nulls(len(used), t) for t in (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())]
        yield pa.RecordBatch.from_arrays(
            [*none, pa.array(used.astype(np.int32)), pa.array(packed, pa.binary())],
            names=["id", "n", "node", "check", "signature", "block", "counts"],
        )

    picked = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return picked.mapInArrow(run, "id long, n long, node long, check long, signature binary, block int, counts binary")


def common_shingles(described: DataFrame) -> tuple[np.ndarray, float]:
    """Which counters are far above the mean, and the chance that a set has a given shingle.

    Tasks' counters are summed by block; what reaches the driver is the sketch,
    of one size for any input.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                part = np.frombuffer(zlib.decompress(counts), dtype="<i8")
                sums[block] = sums[block] + part if block in sums else part
        if sums:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(sums), pa.int32()), pa.array([v.tobytes() for v in sums.values()], pa.binary())], names=["block", "counts"]
            )

    blocks = 1 << (SKETCH_BITS - SKETCH_BLOCK_BITS)
    parts = described.where("n is null").select("block", "counts").repartition(blocks, "block").mapInArrow(run, "block int, counts binary")
    sketch = np.zeros((blocks, 1 << SKETCH_BLOCK_BITS), dtype=np.int64)
    for row in parts.toArrow().to_pylist():
        sketch[row["block"]] += np.frombuffer(row["counts"], dtype="<i8")
    sketch = sketch.reshape(-1)
    mean = sketch.mean()
    common = sketch > mean + max(64.0, 8 * np.sqrt(mean))
    docs = max(1, described.where("n > 0").count())
    rest = sketch[~common].astype(float)
    spread = max(0.0, float((rest**2).sum()) / max(1.0, float(rest.sum())) - mean)
    return np.packbits(common), max(1.0, spread) / docs


def keys_of(s: np.ndarray, common: np.ndarray, bands: list[Band], bound: Bound) -> np.ndarray:
    """The index keys of one set, in its own band and where it may have larger partners in the next."""
    n = len(s)
    need = bound.budget(n, bound.largest_partner(n)) + 1
    first = next(i for i, b in enumerate(bands) if n < b.upper)
    use = [first, first + 1] if bound.largest_partner(n) >= bands[first].upper else [first]
    slot = (s >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)
    hot = (common[slot >> 3] >> (7 - (slot & 7)).astype(np.uint8) & 1).astype(np.int64)
    weight = mixed(s + np.uint64(0x632BE59BD9B4E019))
    out = []
    for i in use:
        band = bands[i]
        if not band.double:
            # each shingle is a segment of its own, so both sets number them in the same order
            order = np.lexsort((s, hot))[: bound.lead(n)]
            out.append(mixed(weight[order] ^ mixed(s[order] + np.uint64(band.upper))))
            continue
        m = band.segments
        spread = (s * np.uint64(0xFF51AFD7ED558CCD) >> np.uint64(33)).astype(np.int64)
        segment = np.where(hot == 1, m + spread % band.upper, spread % m)
        order = np.argsort(segment, kind="stable")
        seg = segment[order]
        begin = np.flatnonzero(np.concatenate(([True], seg[1:] != seg[:-1])))
        sums = np.add.reduceat(weight[order], begin)
        number = seg[begin]
        size = np.diff(np.concatenate((begin, [n])))
        worth = np.where((number < m) & (size > 1), 2, 1)
        last = int(np.searchsorted(np.cumsum(worth), need)) + 1
        used = np.minimum(last, len(begin))
        salt = mixed(number.astype(np.uint64) * np.uint64(2654435761) + np.uint64(band.upper))
        out.append(mixed(sums[:used] ^ salt[:used]))
        group = np.repeat(np.arange(len(begin)), size)
        drop = (group < used) & (worth[group] == 2)
        out.append(mixed((sums[group] - weight[order])[drop] ^ salt[group][drop]))
    return np.concatenate(out)


class _Fresh:
    """Sets of a slice of texts that a task has not met yet, with their nodes."""

    def __init__(self, clashing: frozenset[int]):
        self.clashing = clashing
        self.seen: set[int] = set()

    def of(self, texts: list[str | None]) -> tuple[list[int], list[np.ndarray]]:
        nodes, sets = [], []
        found = shingle_sets(texts)
        for s, node in zip(found, nodes_of(found, self.clashing)[0].tolist(), strict=True):
            if len(s) and node not in self.seen:
                if len(self.seen) < SEEN_SETS:
                    self.seen.add(node)
                nodes.append(node)
                sets.append(s)
        return nodes, sets


def index_keys(df: DataFrame, text_col: str, common: np.ndarray, bands: list[Band], bound: Bound, clashing: frozenset[int] = frozenset()) -> DataFrame:
    """``key, node`` rows of all sets; sets that a task has met already are passed over."""
    shared = df.sparkSession.sparkContext.broadcast(common)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fresh = _Fresh(clashing)
        for batch in slices(batches, 0):
            nodes, sets = fresh.of(batch.column(0).to_pylist())
            if nodes:
                keys = [keys_of(s, shared.value, bands, bound) for s in sets]
                node = np.repeat(np.array(nodes, dtype=np.int64), [len(k) for k in keys])
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys).view(np.int64)), pa.array(node)], names=["key", "node"])

    return df.select(F.col(text_col).alias("text")).mapInArrow(run, "key long, node long")


def runs_to_pairs(index: DataFrame) -> DataFrame:
    """Candidates of sorted index rows: ``key, a, b``.

    Sets behind one key are paired outright if they are few (``key`` null);
    of more, each is tied to the first, and ``key`` tells that the run is long.
    Runs are read as a stream; of a long one only the head is held.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head_key: int | None = None
        head: list[int] = []
        long_run = False
        for batch in batches:
            key, node = (batch.column(i).to_numpy() for i in (0, 1))
            if len(key) > 1:
                fresh = np.concatenate(([True], (key[1:] != key[:-1]) | (node[1:] != node[:-1])))
                key, node = key[fresh], node[fresh]
            edge = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1], [True])))
            size = np.diff(edge)
            a, b, k = [], [], []

            def close(members: list[int]) -> None:
                for i, x in enumerate(members):  # noqa: B023
                    for y in members[i + 1 :]:
                        a.append(x), b.append(y), k.append(None)  # noqa: B023

            # runs of two inside the batch are most of all; the rest go one by one
            inner = np.zeros(len(size), dtype=bool)
            inner[1:-1] = True
            twos = np.flatnonzero(inner & (size == 2))
            quick = (node[edge[twos]], node[edge[twos] + 1])
            for i in np.flatnonzero((size > 1) & ~(inner & (size == 2)) | ~inner).tolist():
                lo, hi = int(edge[i]), int(edge[i + 1])
                members = node[lo:hi].tolist()
                if head_key is not None and int(key[lo]) == head_key:
                    members = members[1:] if head and members[0] == head[-1] else members
                else:
                    if head_key is not None and not long_run:
                        close(head)
                    head_key, head, long_run = int(key[lo]), [], False
                if not long_run and len(head) + len(members) > SMALL_RUN:
                    members, long_run = head + members, True
                    head = members[:1]
                    k.append(head_key), a.append(head[0]), b.append(head[0])
                    members = members[1:]
                if long_run:
                    a += [head[0]] * len(members)
                    b += members
                    k += [head_key] * len(members)
                    head = [head[0]]
                else:
                    head += members
            if len(quick[0]):
                yield pa.RecordBatch.from_arrays(
                    [pa.nulls(len(twos), pa.int64()), pa.array(quick[0]), pa.array(quick[1])], names=["key", "a", "b"]
                )
            if a:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (k, a, b)], names=["key", "a", "b"])
                a, b, k = [], [], []
        if head_key is not None and not long_run and len(head) > 1:
            pairs = [(x, y) for i, x in enumerate(head) for y in head[i + 1 :]]
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(len(pairs), pa.int64()), *[pa.array([p[j] for p in pairs], pa.int64()) for j in (0, 1)]], names=["key", "a", "b"]
            )

    return index.repartition("key").sortWithinPartitions("key", "node").mapInArrow(run, "key long, a long, b long")


def _fits(n1: np.ndarray, n2: np.ndarray, bound: Bound) -> np.ndarray:
    return bound.den * np.minimum(n1, n2) >= bound.num * np.maximum(n1, n2)


def _close_enough(n1: np.ndarray, n2: np.ndarray, s1: np.ndarray, s2: np.ndarray, bound: Bound) -> np.ndarray:
    """False where folded signatures show that two sets are too far apart; never for a link.

    Every shingle in just one of the sets changes one count by one. Counts that
    are not known are left out.
    """
    known = (s1 < 1 << 20) & (s2 < 1 << 20)
    return (np.abs(s1 - s2) * known).sum(axis=-1) <= bound.budget(n1, n2)


def plausible(pairs: DataFrame, nodes: DataFrame, bound: Bound) -> DataFrame:
    """Those of the distinct pairs that sizes and signatures do not rule out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n1, n2 = (batch.column(i).to_numpy() for i in (2, 3))
            sig = [batch.column(i).to_pylist() for i in (4, 5)]
            size = [np.fromiter(map(len, x), dtype=np.int64, count=len(x)) for x in sig]
            good = _fits(n1, n2, bound)
            for w1, w2 in {(int(x), int(y)) for x, y in zip(*size, strict=True)}:
                pick = np.flatnonzero(good & (size[0] == w1) & (size[1] == w2))
                for part in (pick[i : i + 4096] for i in range(0, len(pick), 4096)):
                    s1, s2 = (
                        _folded(np.frombuffer(b"".join([x[i] for i in part.tolist()]), dtype=np.uint8).reshape(-1, w), min(w1, w2))
                        for x, w in zip(sig, (w1, w2), strict=True)
                    )
                    good[part] = _close_enough(n1[part], n2[part], s1, s2, bound)
            mask = pa.array(good)
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(mask), batch.column(1).filter(mask)], names=["a", "b"])

    left = nodes.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("signature").alias("sa"))
    right = nodes.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("signature").alias("sb"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "na", "nb", "sa", "sb").mapInArrow(run, "a long, b long")


def sets_of(df: DataFrame, id_col: str, text_col: str, wanted: DataFrame, clashing: frozenset[int] = frozenset()) -> DataFrame:
    """``node, members`` of the sets in ``wanted`` (``node`` and ``rep``, the id of a document that has it).

    Texts are read once more. The buckets of the wanted ids, of a fixed number
    and broadcast, keep most other documents from being split into words; nodes
    are told apart exactly afterwards.
    """

    def bucket(c: str):
        return F.pmod(F.xxhash64(F.col(c).cast("long")), F.lit(1 << LEAD_BITS)).cast("int")

    buckets = wanted.select(bucket("rep").alias("_bucket")).distinct()
    texts = df.select(F.col(text_col).alias("text"), bucket(id_col).alias("_bucket")).join(F.broadcast(buckets), "_bucket", "left_semi")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fresh = _Fresh(clashing)
        for batch in slices(batches, 0):
            nodes, sets = fresh.of(batch.column(0).to_pylist())
            if nodes:
                ends = np.concatenate(([0], np.cumsum([len(s) for s in sets]))).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(nodes, pa.int64()), pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(sets).view(np.int64)))],
                    names=["node", "members"],
                )

    marks = wanted.select(F.shiftrightunsigned("node", 64 - LEAD_BITS).cast("int").alias("_mark")).distinct()
    found = texts.select("text").mapInArrow(run, "node long, members array<long>")
    found = found.withColumn("_mark", F.shiftrightunsigned("node", 64 - LEAD_BITS).cast("int")).join(F.broadcast(marks), "_mark", "left_semi")
    return found.join(wanted.select("node"), "node", "left_semi").groupBy("node").agg(F.first("members").alias("members"))


def verified(pairs: DataFrame, sets: DataFrame, bound: Bound) -> DataFrame:
    """The pairs that reach the similarity, counted shingle by shingle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = batch.column(2), batch.column(3)
            flat = [c.values.to_numpy() for c in (x, y)]
            off = [c.offsets.to_numpy() for c in (x, y)]
            good = np.zeros(batch.num_rows, dtype=bool)
            for i in range(batch.num_rows):
                s, t = (f[o[i] : o[i + 1]] for f, o in zip(flat, off, strict=True))
                both = np.sort(np.concatenate((s, t)))
                shared = int((both[1:] == both[:-1]).sum())
                good[i] = bound.den * shared >= bound.num * (len(s) + len(t) - shared)
            mask = pa.array(good)
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(mask), batch.column(1).filter(mask)], names=["a", "b"])

    left = sets.select(F.col("node").alias("a"), F.col("members").alias("ma"))
    right = sets.select(F.col("node").alias("b"), F.col("members").alias("mb"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "ma", "mb").mapInArrow(run, "a long, b long")


class _Family:
    """Two blocks of sets that share keys with one pivot: each pair of them is looked at once, however many keys it shares."""

    def __init__(self, same: bool, bound: Bound):
        self.same, self.bound = same, bound
        self.members: list[tuple] = []
        self.todo: np.ndarray | None = None
        self.found: list[np.ndarray] = []
        self.count = 0

    def prepare(self) -> None:
        part, node, component, n, sig = zip(*self.members, strict=True)
        self.at = {x: i for i, x in enumerate(node)}
        self.node, self.n, self.part = np.array(node), np.array(n), np.array(part)
        component = np.array(component)
        self.width = np.fromiter(map(len, sig), dtype=np.int64, count=len(sig))
        self.sig = [np.frombuffer(x, dtype=np.uint8) for x in sig]
        self.members = []
        m = len(node)
        self.todo = np.zeros((m, m), dtype=bool)
        for lo in range(0, m, 256):
            r = slice(lo, min(m, lo + 256))
            new = (component[r, None] != component[None, :]) & _fits(self.n[r, None], self.n[None, :], self.bound)
            self.todo[r] = new & (np.arange(m)[None, :] > np.arange(lo, r.stop)[:, None] if self.same else self.part[r, None] < self.part[None, :])

    @property
    def crowded(self) -> bool:
        """More plausible pairs than a few for each set: signatures do not tell these sets apart."""
        return self.todo is not None and self.count > CROWD * len(self.node)

    def compare(self, nodes: list[int]) -> None:
        """Note the new plausible pairs of one run."""
        if self.todo is None:
            self.prepare()
        every = np.sort(np.array([self.at[x] for x in nodes]))
        for rows in (every[i : i + 64] for i in range(0, len(every), 64)):
            if self.crowded:
                self.found = []
                return
            x, y = np.nonzero(self.todo[np.ix_(rows, every)])
            x, y = rows[x], every[y]
            self.todo[x, y] = False
            both = np.minimum(self.width[x], self.width[y])
            for w in np.unique(both).tolist():
                pick = np.flatnonzero(both == w)
                for part in (pick[i : i + 4096] for i in range(0, len(pick), 4096)):
                    u, v = x[part], y[part]
                    ends = [np.unique(e, return_inverse=True) for e in (u, v)]
                    s1, s2 = (np.concatenate([_folded(self.sig[i][None, :], w) for i in own.tolist()])[at] for own, at in ends)
                    good = _close_enough(self.n[u], self.n[v], s1, s2, self.bound)
                    self.found.append(np.stack((self.node[u[good]], self.node[v[good]]), axis=1))
                    self.count += int(good.sum())


def spanning_links(left: list[tuple], right: list[tuple] | None, bound: Bound) -> list[tuple[int, int]]:
    """Links that connect all of ``(node, component, set)`` which exact links between the two sides connect.

    ``right`` is None to compare ``left`` with itself. A set is counted against
    the others' shingles only while one of another component is left that its
    size allows, and a link is given only if it joins two components, so there
    are fewer links than sets.
    """
    others = left if right is None else right
    sizes = np.array([len(s) for _, _, s in others])
    flat = np.concatenate([s for _, _, s in others])
    owner = np.repeat(np.arange(len(others)), sizes)
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    labels = {c: i for i, c in enumerate(dict.fromkeys(c for _, c, _ in [*left, *others]))}
    of_left, of_other = (np.array([labels[c] for _, c, _ in side]) for side in (left, others))
    out = []
    for i, (node, _, s) in enumerate(left):
        may = (of_other != of_left[i]) & _fits(sizes, len(s), bound)
        if right is None:
            may[: i + 1] = False
        if not may.any():
            continue
        lo = np.searchsorted(flat, s, side="left")
        count = np.searchsorted(flat, s, side="right") - lo
        at = np.repeat(lo - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))
        shared = np.bincount(owner[at], minlength=len(others))
        for j in np.flatnonzero(may & (bound.den * shared >= bound.num * (len(s) + sizes - shared))).tolist():
            old, new = of_other[j], of_left[i]
            if old != new:
                out.append((node, others[j][0]))
                of_other[of_other == old] = new
                of_left[of_left == old] = new
    return out


def across_components(members: DataFrame, nodes: DataFrame, found: DataFrame, bound: Bound) -> tuple[DataFrame, DataFrame]:
    """What may still connect the sets of long runs: plausible pairs, and blocks of sets to compare in full.

    Runs whose sets all belong together need nothing more. The others meet by
    their least node, the pivot, so runs of one group of near copies come
    together and a pair is looked at once. What is not of the pivot's component
    is cut into blocks of about BLOCK sets, and so is the rest; each of the
    first blocks is compared with every block, by itself, so no task holds a
    whole group and no pair is left out. Where signatures leave more pairs than
    CROWD for each set, the two blocks are given instead: ``node, component``
    of every set by ``pivot, i, j``.
    """
    label = members.join(found, "node", "left").select("key", "node", F.coalesce("component", "node").alias("component"))
    mixed_runs = (
        label.groupBy("key").agg(F.min(F.struct("node", "component")).alias("head"), F.min("component").alias("lo"), F.max("component").alias("hi"))
        .where("lo != hi").select("key", F.col("head.node").alias("pivot"), F.col("head.component").alias("home"))
    )
    runs = staged(label.join(mixed_runs, "key").withColumn("away", F.col("component") != F.col("home")), "mixed-runs")
    who = runs.select("pivot", "node", "component", "away").distinct().join(nodes.select("node", "n", "signature"), "node")
    size = F.greatest(F.count(F.lit(1)) / BLOCK, F.sum("n") / BLOCK_SHINGLES)
    parts = who.groupBy("pivot", "away").agg(F.ceil(size).cast("int").alias("parts")).groupBy("pivot").agg(
        F.coalesce(F.max(F.when(F.col("away"), F.col("parts"))), F.lit(0)).alias("out"), F.coalesce(F.max(F.when(~F.col("away"), F.col("parts"))), F.lit(0)).alias("in_"),
    )
    who = who.select("pivot", F.lit(0).cast("long").alias("key"), "node", "component", "away", "n", "signature", F.lit(0).alias("kind"))
    rows = who.unionByName(runs.select("pivot", "key", "node", "away", F.lit(1).alias("kind")), allowMissingColumns=True)
    # every pivot has something away, and itself; only large ones have more than a block of either, and their rows are spread
    large = parts.where("out > 1 or in_ > 1").withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    rows = rows.withColumn("salt", F.pmod(F.xxhash64("node", "key"), F.lit(SALTS)).cast("int")).join(large, ["pivot", "salt"], "left")
    rows = rows.withColumns({"out": F.coalesce("out", F.lit(1)), "in_": F.coalesce("in_", F.lit(1))})
    # blocks of what is away come first, then those of the pivot's component
    part = F.when(F.col("away"), F.pmod(F.col("node"), F.col("out"))).otherwise(F.col("out") + F.pmod(F.col("node"), F.col("in_"))).cast("int")
    meets = F.when(F.col("away"), F.sequence(F.lit(0), F.col("out") + F.col("in_") - 1)).otherwise(F.sequence(F.lit(0), F.col("out") - 1))
    rows = rows.withColumn("part", part).withColumn("other", F.explode(meets))
    rows = rows.select("pivot", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"), "kind", "key", "part", "node", "component", "n", "signature")
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where, family = None, None
        key, nodes_here = None, []
        pairs: list[np.ndarray] = []
        crowds: list[tuple[int, int, int]] = []

        def close() -> None:
            if len(nodes_here) > 1:
                family.compare(nodes_here)

        def leave() -> None:
            close()
            if family is not None and family.crowded:
                crowds.append(where)
            elif family is not None:
                pairs.extend(family.found)

        def told() -> pa.RecordBatch:
            a, b = np.concatenate([*pairs, np.zeros((0, 2), dtype=np.int64)]).T
            n, m = len(a), len(crowds)
            columns = [pa.concat_arrays([pa.nulls(n, t), pa.array([c[k] for c in crowds], t)]) for k, t in enumerate((pa.int64(), pa.int32(), pa.int32()))]
            ends = [pa.concat_arrays([pa.array(f(a, b)), pa.nulls(m, pa.int64())]) for f in (np.minimum, np.maximum)]
            pairs.clear(), crowds.clear()
            return pa.RecordBatch.from_arrays([*columns, *ends], names=["pivot", "i", "j", "a", "b"])

        for batch in batches:
            for pivot, i, j, kind, k, part_, node, component, n, sig in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if (pivot, i, j) != where:
                    leave()
                    where, family, key, nodes_here = (pivot, i, j), _Family(i == j, bound), None, []
                if kind == 0:
                    family.members.append((part_, node, component, n, sig))
                    continue
                if k != key:
                    close()
                    key, nodes_here = k, []
                nodes_here.append(node)
            if pairs or crowds:
                yield told()
        leave()
        if pairs or crowds:
            yield told()

    dealt = rows.repartition("pivot", "i", "j").sortWithinPartitions("pivot", "i", "j", "kind", "key")
    got = staged(dealt.mapInArrow(run, "pivot long, i int, j int, a long, b long"), "across")
    crowds = got.where("pivot is not null").select("pivot", "i", "j")
    blocks = rows.where("kind = 0").select("pivot", "i", "j", "part", "node", "component").join(crowds, ["pivot", "i", "j"])
    return got.where("pivot is null").select("a", "b").distinct(), blocks


def compared_in_full(blocks: DataFrame, sets: DataFrame, bound: Bound) -> DataFrame:
    """Exact links of every two blocks, no more than connect them; a task holds the sets of two blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where, sides = None, {}

        def close() -> pa.RecordBatch:
            left, *more = [sides[k] for k in sorted(sides)]
            links = [] if where[1] != where[2] and not more else spanning_links(left, more[0] if more else None, bound)
            return pa.RecordBatch.from_arrays([pa.array([f(x) for x in links], pa.int64()) for f in (min, max)], names=["a", "b"])

        for batch in batches:
            column = batch.column(6)
            flat, off = column.values.to_numpy(), column.offsets.to_numpy()
            for row, (pivot, i, j, part, node, component) in enumerate(zip(*[c.to_pylist() for c in batch.columns[:6]], strict=True)):
                if (pivot, i, j) != where:
                    if where is not None:
                        yield close()
                    where, sides = (pivot, i, j), {}
                sides.setdefault(part, []).append((node, component, flat[off[row] : off[row + 1]].view(np.uint64).copy()))
        if where is not None:
            yield close()

    rows = blocks.join(sets, "node").select("pivot", "i", "j", "part", "node", "component", "members")
    return rows.repartition("pivot", "i", "j").sortWithinPartitions("pivot", "i", "j", "node").mapInArrow(run, "a long, b long").distinct()


def _linked(df: DataFrame, id_col: str, text_col: str, bound: Bound) -> tuple[DataFrame, frozenset[int]]:
    """``id, n, node, group, component`` of every row, and the numbers that two different sets share."""
    described = staged(describe(df, id_col, text_col), "described")
    common, rate = common_shingles(described)
    docs = described.where("n is not null").withColumn("node", F.expr("case when id is not null then node end"))
    # of N different sets about N * N / 2**65 pairs share a number, few enough to be told to every task
    shared = docs.where("node is not null").groupBy("node").agg(F.min("check").alias("lo"), F.max("check").alias("hi")).where("lo != hi")
    clashing = frozenset(r["node"] for r in shared.select("node").collect())
    if clashing:
        docs = docs.withColumn("node", F.when(F.col("node").isin(*clashing), F.col("check")).otherwise(F.col("node")))
    classes = staged(
        docs.where("node is not null").groupBy("node").agg(F.min("id").alias("rep"), F.max("n").alias("n"), F.any_value("signature").alias("signature")),
        "classes",
    )
    largest = classes.agg(F.coalesce(F.max("n"), F.lit(0))).first()[0]
    uppers = band_uppers(largest)
    band = F.lit(0)
    for u in uppers:
        band = F.when(F.col("n") < u, band).otherwise(F.lit(u))
    population = {r["band"]: r["count"] for r in classes.groupBy(band.alias("band")).count().collect()}
    bands = [allocate(u, population.get(0 if i == 0 else uppers[i - 1], 0), rate, bound) for i, u in enumerate(uppers)]
    texts = df.where(F.col(id_col).isNotNull())
    candidates = staged(runs_to_pairs(index_keys(texts, text_col, common, bands, bound, clashing)), "candidates")
    members = candidates.where("key is not null").select("key", F.col("b").alias("node"))
    pairs = plausible(candidates.where("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), classes, bound)
    pairs = staged(pairs, "plausible")

    def sets_for(ends: DataFrame) -> DataFrame:
        wanted = staged(ends.distinct().join(classes.select("node", "rep"), "node"), "wanted")
        return staged(sets_of(texts, id_col, text_col, wanted, clashing), "sets")

    def ends_of(some: DataFrame) -> DataFrame:
        return some.select(F.col("a").alias("node")).union(some.select("b"))

    links = staged(verified(pairs, sets_for(ends_of(pairs)), bound), "similar")
    found = connected_components(links)
    more, blocks = across_components(members, classes, found, bound)
    more, blocks = staged(more, "more"), staged(blocks, "blocks")
    if not (more.isEmpty() and blocks.isEmpty()):
        sets = sets_for(ends_of(more).union(blocks.select("node")))
        links = staged(links.union(verified(more, sets, bound)).union(compared_in_full(blocks, sets, bound)), "similar")
        found = connected_components(links)
    groups = staged(classes.select("node", "rep").join(found, "node", "left").select("node", "rep", F.coalesce("component", "node").alias("group")), "groups")
    least = groups.groupBy("group").agg(F.min("rep").alias("component"))
    where = groups.join(least, "group").select(F.col("node").cast("string").alias("at"), "group", "component")
    # rows without a node get keys of their own, so that they do not meet in one task
    at = F.coalesce(F.col("node").cast("string"), F.concat(F.lit("?"), F.monotonically_increasing_id().cast("string")))
    keyed = docs.select("id", "n", "node", at.alias("at")).join(where, "at", "left")
    return keyed.select("id", "n", "node", "group", F.coalesce("component", "id").alias("component")), clashing


def link_documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", bound: Bound = Bound()) -> DataFrame:
    """``id_col, n_shingles, component_id`` of every row, from exact links between whole texts.

    Documents link when ``den * shared >= num * united`` holds for their shingle
    sets; the component is the smallest id reachable, the row's own included.
    Equal sets are one node throughout, so copies are never paired. Shingles are
    told apart by 64-bit hashes, sets by two. Texts without words, and rows with a
    null id, link with nothing and are their own component. Repeated ids are
    rows of their own. An empty table gives no rows. Other columns are not read.
    """
    rows, _ = _linked(df, id_col, text_col, bound)
    return rows.select(F.col("id").cast(df.schema[id_col].dataType).alias(id_col), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"))


def _with_nodes(df: DataFrame, text_col: str, clashing: frozenset[int]) -> DataFrame:
    """All columns of ``df`` and ``_node``; 0 for texts without words."""
    at = df.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, at):
            node = nodes_of(shingle_sets(batch.column(at).to_pylist()), clashing)[0]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(node)], names=[*batch.schema.names, "_node"])

    return df.mapInArrow(run, df.withColumn("_node", F.lit(0).cast("long")).schema)


def keep_one_of_each(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", bound: Bound = Bound()) -> DataFrame:
    """One row of every group of near copies, that of its smallest id, with all columns of ``df``.

    Rows with a null id and rows without words all stay. Rows that share an id
    are judged each by its own text.
    """
    rows, clashing = _linked(df, id_col, text_col, bound)
    linked = staged(rows.where("id is not null"), "linked")
    again = staged(linked.groupBy("id").count().where("count > 1").select(F.col("id").alias(id_col)), "repeated")
    gone = linked.where("id != component").select(F.col("id").alias(id_col))
    if again.isEmpty():
        return df.join(gone, id_col, "left_anti").select(*df.columns)
    from pyspark.sql import Window

    once = df.join(gone.unionByName(again), id_col, "left_anti").select(*df.columns)
    where = linked.where("id = component").select(F.col("id").alias(id_col), F.coalesce("node", F.lit(0)).alias("_node"), F.col("group").alias("_group")).distinct()
    each = _with_nodes(df.join(again, id_col, "left_semi").select(*df.columns), text_col, clashing).join(where, [id_col, "_node"])
    first = F.row_number().over(Window.partitionBy(id_col, "_group").orderBy("_node", F.xxhash64(text_col)))
    each = each.where("_node = 0").withColumn("_first", F.lit(1)).unionByName(each.where("_node != 0").withColumn("_first", first))
    return once.unionByName(each.where("_first = 1").select(*df.columns))
