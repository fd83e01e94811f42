"""Order-preserving packing of documents into fixed windows by dynamic programming."""

from __future__ import annotations

import zlib
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from tapeloom.llm.bpe import ByteBpe, slices
from tapeloom.llm.rank_bpe import RankBpe, loaded_ranks

# Marks that end a sentence when white space follows.
SENTENCE_ENDS = (b".", b"!", b"?", b":", b";", "。".encode(), "！".encode(), "？".encode(), "…".encode())


@dataclass(frozen=True)
class Costs:
    """Window size and what a cut costs, in padding tokens.

    A cut between documents is free. ``sentence`` is the price of a cut behind a
    sentence inside a document, ``forced`` of one inside a sentence; such places
    exist only in stretches over ``stretch`` tokens, every ``step`` tokens.
    """

    window: int = 1024
    sentence: int = 1
    forced: int = 6
    stretch: int = 48
    step: int = 8


class Boundaries:
    """Which tokens end a sentence, by vocabulary lookup."""

    def __init__(self, bpe: ByteBpe | RankBpe):
        self.ends = np.array([s.endswith(SENTENCE_ENDS) for s in bpe.spelled])
        self.line = np.array([b"\n" in s for s in bpe.spelled])
        self.space = np.array([s[:1] in (b" ", b"\n", b"\t", b"\r") for s in bpe.spelled])

    def places(self, tokens: np.ndarray, doc_ends: np.ndarray, costs: Costs) -> tuple[np.ndarray, np.ndarray]:
        """Positions where a window may end (ascending, from 0) and the price of each."""
        n = len(tokens)
        price = np.full(n + 1, -1, dtype=np.int64)
        inner = self.line[tokens[:-1]] | (self.ends[tokens[:-1]] & self.space[tokens[1:]])
        price[1:n][inner] = costs.sentence
        price[doc_ends] = 0
        price[0] = 0
        known = np.flatnonzero(price >= 0)
        if known[-1] != n:
            known = np.append(known, n)
        gap = np.diff(known)
        for a, g in zip(known[:-1][gap > costs.stretch].tolist(), gap[gap > costs.stretch].tolist(), strict=True):
            price[a + costs.step : a + g : costs.step] = costs.forced
        at = np.flatnonzero(price >= 0)
        return at, price[at]


def best_cuts(at: np.ndarray, price: np.ndarray, window: int, final: bool) -> list[int]:
    """Indexes into ``at`` where windows end, at the least padding plus price.

    ``cost[i] = min(cost[j] + window - (at[i] - at[j])) + price[i]`` over the
    places ``j`` at most ``window`` before ``i``. As padding is linear, only
    ``cost[j] + at[j]`` matters; a queue keeps it in ascending order over the
    sliding range, so every place enters and leaves once. Unless ``final``, what
    lies behind the best place within a window of the end stays open.
    """
    where, prices = at.tolist(), price.tolist()
    n = len(where)
    back = [0] * n
    cost = [0] * n
    queue: deque[tuple[int, int]] = deque([(where[0], 0)])
    for i in range(1, n):
        here = where[i]
        low = here - window
        while where[queue[0][1]] < low:
            queue.popleft()
        key, j = queue[0]
        c = key + window - here + prices[i]
        cost[i], back[i] = c, j
        key = c + here
        while queue and queue[-1][0] >= key:
            queue.pop()
        queue.append((key, i))
    end = n - 1
    if not final:
        low = where[-1] - window
        end = min((i for i in range(n - 1, -1, -1) if where[i] >= low), key=lambda i: (cost[i], -i))
    cuts = []
    while end > 0:
        cuts.append(end)
        end = back[end]
    return cuts[::-1]


class _Packer:
    """Packs one partition's documents in their order, a block at a time."""

    def __init__(self, bpe: ByteBpe | RankBpe, costs: Costs, separator: int, first: int, with_ids: bool):
        self.bpe, self.costs, self.separator, self.with_ids = bpe, costs, separator, with_ids
        self.bounds = Boundaries(bpe)
        self.next_sequence = first
        self.tokens = np.array([], dtype="<u4")
        # open stretches of documents: key, tokens before, tokens here, tokens of the document
        self.open: list[tuple[object, int, int, int]] = []

    def add(self, keys: list, texts: list[str]) -> None:
        parts = [self.tokens]
        for key, ids in zip(keys, self.bpe.encode(texts), strict=True):
            parts += [ids.astype("<u4"), np.array([self.separator], dtype="<u4")]
            self.open.append((key, 0, len(ids) + 1, len(ids) + 1))
        self.tokens = np.concatenate(parts)

    def pack(self, final: bool) -> list[tuple]:
        """Pieces of the windows that are now settled; the rest stays open."""
        if not len(self.tokens):
            return []
        ends = np.cumsum([n for _, _, n, _ in self.open])
        at, price = self.bounds.places(self.tokens, ends, self.costs)
        stops = at[best_cuts(at, price, self.costs.window, final)]
        if not len(stops):
            return []
        starts = np.concatenate(([0], stops[:-1]))
        done = int(stops[-1])
        edges = np.unique(np.concatenate((starts, ends[ends <= done], stops)))
        edges = np.unique(np.concatenate(([0], edges)))
        left, right = edges[:-1], edges[1:]
        doc = np.searchsorted(ends, left, side="right")
        seq = np.searchsorted(stops, left, side="right")
        doc_start = np.concatenate(([0], ends[:-1]))
        rows = []
        for a, b, d, q in zip(left.tolist(), right.tolist(), doc.tolist(), seq.tolist(), strict=True):
            key, before, _, total = self.open[d]
            ids = self.tokens[a:b]
            rows.append((
                key, before + a - int(doc_start[d]), b - a, zlib.crc32(ids.tobytes()), total,
                self.next_sequence + q, a - int(starts[q]), ids if self.with_ids else None,
            ))
        self.next_sequence += len(stops)
        rest = []
        for (key, before, n, total), end in zip(self.open, ends.tolist(), strict=True):
            if end > done:
                used = max(0, done - (end - n))
                rest.append((key, before + used, n - used, total))
        self.open, self.tokens = rest, self.tokens[done:]
        return rows


def pack_documents(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    costs: Costs = Costs(),
    separator: int = 0,
    vocabulary: str | None = None,
    with_ids: bool = False,
) -> DataFrame:
    """Pack whole documents, in their order, into sequences of at most ``costs.window`` tokens.

    Returns one row per piece: ``id_col, start, length, ids_crc32, doc_tokens,
    sequence_id, offset`` and, ``with_ids``, the piece's ``ids``. A document is
    its ids followed by ``separator``. Cuts lie at document or sentence ends
    (inside very long sentences at fixed steps) and minimise padding plus the
    prices of cuts.

    Each partition is packed by itself in the order of its rows, so nothing is
    shuffled and memory is bounded by one block of texts; a partition leaves one
    sequence open at its end at most. Sequence ids are the partition's number
    times 2**33 plus a counter. A task that runs again gives the same pieces for
    the same rows.

    Null texts count as empty: one piece that holds the separator. Null and
    repeated ids are packed row by row. No rows give no pieces. Other columns
    are not read.
    """
    key = df.schema[id_col].dataType.simpleString()
    picked = df.select(id_col, text_col)
    arrow = {"names": [id_col, "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]}
    schema = f"`{id_col}` {key}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    if with_ids:
        arrow["names"].append("ids")
        schema += ", ids array<int>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer, kind = None, None

        def out(rows: list[tuple]) -> pa.RecordBatch:
            cols = list(zip(*rows, strict=True))
            arrays = [pa.array(cols[0], kind), *[pa.array(c, pa.int64()) for c in cols[1:7]]]
            if with_ids:
                arrays.append(pa.array([x.astype(np.int32) for x in cols[7]], pa.list_(pa.int32())))
            return pa.RecordBatch.from_arrays(arrays, **arrow)

        for batch in slices(batches, 1):
            if packer is None:
                first = TaskContext.get().partitionId() << 33
                packer, kind = _Packer(loaded_ranks(vocabulary), costs, separator, first, with_ids), batch.schema.field(0).type
            packer.add(batch.column(0).to_pylist(), [t or "" for t in batch.column(1).to_pylist()])
            if rows := packer.pack(final=False):
                yield out(rows)
        if packer is not None and (rows := packer.pack(final=True)):
            yield out(rows)

    return picked.mapInArrow(run, schema)
