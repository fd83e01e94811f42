"""Byte-level BPE whose merges are found by a segment tree over pair ranks.

A leaf of the tree stands for the pair that starts at a position and holds
``rank * width + position`` (or NONE where the pair cannot merge). The root is
then the leftmost pair of lowest rank; a merge changes three leaves and their
ancestors. Words that fit in ``WIDEST`` bytes are merged many at a time, one
tree per row of a matrix; longer ones have a tree of their own.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame

NONE = 1 << 60
WIDEST = 64
#: Chunks of text that a worker caches; beyond it a new cache begins, and what is met again moves over from the old one.
CACHE_CHUNKS = 100_000
#: Chunks longer than this are encoded each time.
CACHE_CHARS = 64

# Fixed value: the pattern that splits text into words before any merge.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Characters that form one word when they follow letters.
_TAIL = ".,;:!?#$%&*"
# White space beyond ASCII as UTF-8 bytes, by first byte.
_WIDE_SPACES = (
    (0xC2, (b"\x85", b"\xa0")),
    (0xE1, (b"\x9a\x80",)),
    (0xE2, (*(b"\x80" + bytes([x]) for x in (*range(0x80, 0x8B), 0xA8, 0xA9, 0xAF)), b"\x81\x9f")),
    (0xE3, (b"\x80\x80",)),
)


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in the vocabulary file."""
    keep = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return [chr(b) if b in keep else chr(next(spare)) for b in range(256)]


class ByteBpe:
    """Encoder and decoder for one vocabulary file of the tokenizers library."""

    def __init__(self, path: str | None = None):
        with open(path or default_vocabulary(), encoding="utf-8") as f:
            spec = json.load(f)
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        letters = byte_letters()
        byte_of = {c: b for b, c in enumerate(letters)}
        self.specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special_split = re.compile("|".join(map(re.escape, self.specials))) if self.specials else None
        size = max([*vocab.values(), *self.specials.values()]) + 1
        spelled = [b""] * size
        for token, i in vocab.items():
            spelled[i] = bytes(byte_of[c] for c in token)
        for token, i in self.specials.items():
            spelled[i] = token.encode()
        self.spelled = spelled
        self.byte_ids = np.array([vocab[c] for c in letters], dtype=np.int64)
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in merges]
        left = np.array([vocab[a] for a, _ in pairs], dtype=np.int64)
        right = np.array([vocab[b] for _, b in pairs], dtype=np.int64)
        self.merged = np.array([vocab[a + b] for a, b in pairs], dtype=np.int64)
        # an open-addressing table of the pairs: half empty, linear probing
        keys = (left << 20) | right
        self.bits = int(np.ceil(np.log2(len(keys)))) + 2
        self.slots = np.full(1 << self.bits, -1, dtype=np.int64)
        self.slot_rank = np.full(1 << self.bits, -1, dtype=np.int64)
        todo, at = np.arange(len(keys)), self._slot(keys)
        while len(todo):
            free = self.slots[at] < 0
            _, first = np.unique(at[free], return_index=True)
            won = np.flatnonzero(free)[first]
            self.slots[at[won]], self.slot_rank[at[won]] = keys[todo[won]], todo[won]
            left_over = np.ones(len(todo), dtype=bool)
            left_over[won] = False
            todo, at = todo[left_over], (at[left_over] + 1) & ((1 << self.bits) - 1)
        lengths = np.array([len(s) for s in spelled], dtype=np.int64)
        self.spelled_length = lengths
        self.spelled_start = np.concatenate(([0], np.cumsum(lengths)[:-1]))
        self.spelled_bytes = np.frombuffer(b"".join(spelled), dtype=np.uint8)
        self.split = regex.compile(SPLIT)
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        table = np.zeros(256, dtype=bool)
        table[[*range(65, 91), *range(97, 123)]] = True
        self.letter = table

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Merge rank of each pair, -1 where the pair never merges."""
        keys = (left << 20) | right
        at = self._slot(keys)
        found = self.slots[at]
        out = np.where(found == keys, self.slot_rank[at], -1)
        open_ = np.flatnonzero((found != keys) & (found >= 0))
        while len(open_):
            at[open_] = (at[open_] + 1) & ((1 << self.bits) - 1)
            found = self.slots[at[open_]]
            hit = found == keys[open_]
            out[open_[hit]] = self.slot_rank[at[open_[hit]]]
            open_ = open_[~hit & (found >= 0)]
        return out

    # -- one tree per row ---------------------------------------------------
    def _merge_rows(self, ids: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """``ids``: one word per row, padded with -1; returned with -1 where a piece was swallowed.

        Rows lie behind each other in flat arrays: ``tree`` has ``2 * width``
        places a row with the root at 1, the others have ``width``.
        """
        n, width = ids.shape
        shift = width.bit_length() - 1
        none = np.int32(1 << 30)
        where = np.arange(width, dtype=np.int64)
        tree = np.full((n, 2 * width), none, dtype=np.int32)
        r, c = np.nonzero(where[None, :-1] + 1 < lengths[:, None])
        rank = self.ranks(ids[r, c], ids[r, c + 1])
        ok = rank >= 0
        tree[r[ok], width + c[ok]] = (rank[ok] << shift) | c[ok]
        for level in range(shift - 1, -1, -1):
            a, b = 1 << level, 2 << level
            tree[:, a:b] = np.minimum(tree[:, b : 2 * b : 2], tree[:, b + 1 : 2 * b : 2])
        tree, flat = tree.reshape(-1), ids.reshape(-1)
        nxt = np.tile(where + 1, n)
        prv = np.tile(where - 1, n)

        rows = np.flatnonzero(tree[1 :: 2 * width] < none)
        while len(rows):
            base, top, length = rows * width, rows * (2 * width), lengths[rows]
            root = tree[top + 1].astype(np.int64)
            i, rank = root & (width - 1), root >> shift
            at = base + i
            j = nxt[at]
            k = nxt[base + j]
            new = self.merged[rank]
            flat[at] = new
            flat[base + j] = -1
            nxt[at] = k
            inside = k < length
            prv[base[inside] + k[inside]] = i[inside]
            p = prv[at]
            some = p >= 0
            # the three changed leaves: the swallowed one, the merged one, the one before
            mine = np.full(len(rows), none, dtype=np.int64)
            pair = np.concatenate((flat[base[some] + p[some]], new[inside]))
            then = np.concatenate((new[some], flat[base[inside] + k[inside]]))
            spot = np.concatenate((p[some], i[inside]))
            got = self.ranks(pair, then)
            value = np.where(got >= 0, (got << shift) | spot, none)
            cut = int(some.sum())
            mine[inside] = value[cut:]
            ups = np.concatenate((top, top, top[some]))
            pos = np.concatenate((j, i, p[some])) + width
            tree[ups + pos] = np.concatenate((np.full(len(rows), none, dtype=np.int64), mine, value[:cut]))
            for _ in range(shift):
                pos >>= 1
                child = ups + 2 * pos
                tree[ups + pos] = np.minimum(tree[child], tree[child + 1])
            rows = rows[tree[top + 1] < none]
        return ids

    # -- one tree for one long word -----------------------------------------
    def _merge_long(self, word: bytes) -> list[int]:
        n = len(word)
        width = 1 << max(1, (n - 1).bit_length())
        ids = [int(x) for x in self.byte_ids[np.frombuffer(word, dtype=np.uint8)]]
        none = int(NONE)
        tree = [none] * (2 * width)
        start = self.ranks(np.array(ids[:-1], dtype=np.int64), np.array(ids[1:], dtype=np.int64)).tolist()
        for i, r in enumerate(start):
            if r >= 0:
                tree[width + i] = r * width + i
        for at in range(width - 1, 0, -1):
            tree[at] = min(tree[2 * at], tree[2 * at + 1])
        nxt, prv = list(range(1, n + 1)), list(range(-1, n - 1))
        pairs = self._pairs()

        def put(pos: int, value: int) -> None:
            at = pos + width
            tree[at] = value
            at >>= 1
            while at:
                low = min(tree[2 * at], tree[2 * at + 1])
                if tree[at] == low:
                    break
                tree[at] = low
                at >>= 1

        while tree[1] < none:
            rank, i = divmod(tree[1], width)
            j = nxt[i]
            k = nxt[j]
            ids[i] = int(self.merged[rank])
            ids[j] = -1
            nxt[i] = k
            put(j, none)
            r = -1
            if k < n:
                prv[k] = i
                r = pairs.get((ids[i] << 20) | ids[k], -1)
            put(i, r * width + i if r >= 0 else none)
            p = prv[i]
            if p >= 0:
                r = pairs.get((ids[p] << 20) | ids[i], -1)
                put(p, r * width + p if r >= 0 else none)
        return [x for x in ids if x >= 0]

    def _pairs(self) -> dict[int, int]:
        if not hasattr(self, "_pair_rank"):
            full = self.slots >= 0
            self._pair_rank = dict(zip(self.slots[full].tolist(), self.slot_rank[full].tolist(), strict=True))
        return self._pair_rank

    # -- words, chunks, texts -------------------------------------------------
    def encode_words(self, words: list[bytes]) -> list[bytes]:
        """Ids of each word (a piece that the split pattern gives), packed as :attr:`dtype`."""
        out: list[bytes] = [b""] * len(words)
        size = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        each = np.dtype(self.dtype).itemsize
        width, low = 2, 0
        while low < WIDEST:
            pick = np.flatnonzero((size > low) & (size <= width))
            for part in (pick[a : a + (1 << 15)] for a in range(0, len(pick), 1 << 15)):
                lens = size[part]
                flat = np.frombuffer(b"".join([words[i] for i in part.tolist()]), dtype=np.uint8)
                ids = np.full((len(part), width), -1, dtype=np.int64)
                ids[np.arange(width)[None, :] < lens[:, None]] = self.byte_ids[flat]
                ids = self._merge_rows(ids, lens)
                alive = ids >= 0
                packed = ids[alive].astype(self.dtype).tobytes()
                at = 0
                for i, end in zip(part.tolist(), (np.cumsum(alive.sum(axis=1)) * each).tolist(), strict=True):
                    out[i] = packed[at:end]
                    at = end
            low, width = width, width * 2
        for i in np.flatnonzero(size > WIDEST).tolist():
            out[i] = np.array(self._merge_long(words[i]), dtype=self.dtype).tobytes()
        return out

    def _words(self, chunk: str) -> list[str]:
        """What the split pattern finds; letters with a tail of punctuation need no pattern."""
        core = chunk.rstrip(_TAIL)
        if (core[1:] if core[:1] == " " else core).isalpha():
            return [core, chunk[len(core) :]] if len(core) < len(chunk) else [core]
        return self.split.findall(chunk)

    def _chunk_ids(self, chunks: list[str]) -> list[bytes]:
        """Ids of each of the distinct chunks, packed as :attr:`dtype`; what was met before is taken from the cache."""
        known, older = self.known, self.older
        out = list(map(known.get, chunks))
        open_ = []
        for i in [i for i, ids in enumerate(out) if ids is None]:
            out[i] = ids = older.get(chunks[i])
            if ids is None:
                open_.append(i)
            else:
                known[chunks[i]] = ids
        found = [self._words(chunks[i]) for i in open_]
        unseen = list(set().union(*found).difference(known))
        fresh = dict(zip(unseen, self.encode_words([w.encode() for w in unseen]), strict=True))
        for i, ws in zip(open_, found, strict=True):
            out[i] = b"".join([fresh[w] if w in fresh else known[w] for w in ws])
            if len(ws) > 1:
                fresh[chunks[i]] = out[i]
        known.update((c, ids) for c, ids in fresh.items() if len(c) <= CACHE_CHARS)
        if len(known) > CACHE_CHUNKS:
            self.known, self.older = {}, known
        return out

    @property
    def dtype(self) -> str:
        return "<u2" if len(self.spelled) <= 1 << 16 else "<u4"

    def _borders(self, raw: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Byte positions where a chunk begins, and which texts need the full pattern.

        ``raw`` are the texts behind each other, ``ends`` where each ends. A word
        always ends where a single space or line break follows, and where an
        ASCII letter is followed by another kind of ASCII character, so these
        begin a chunk, and so does what follows a line break. Texts with other
        white space, or with two of it in a row or at an end, are marked.
        """
        begin = np.zeros(len(raw) + 1, dtype=bool)
        starts = np.concatenate(([0], ends[:-1]))
        line = np.flatnonzero(raw == 10)
        white = raw == 32
        letter = self.letter[raw]
        begin[1:-1] = letter[:-1] & ~letter[1:] & (raw[1:] < 128)
        begin[:-1] |= white
        begin[starts] = True
        begin[line] = True
        begin[line + 1] = True
        white[line] = True
        odd = (raw < 32) & ~white
        odd[1:] |= white[1:] & white[:-1]
        full = starts < ends
        odd[starts[full]] |= white[starts[full]]
        odd[ends[full] - 1] |= white[ends[full] - 1]
        for lead, follow in _WIDE_SPACES:
            at = np.flatnonzero(raw == lead)
            for more in follow:
                hit = at[at + len(more) < len(raw)]
                for i, byte in enumerate(more):
                    hit = hit[raw[hit + 1 + i] == byte]
                odd[hit] = True
        slow = np.zeros(len(ends), dtype=bool)
        slow[np.searchsorted(ends, np.flatnonzero(odd), side="right")] = True
        return begin[:-1], slow

    def encode(self, texts: Iterable[str]) -> list[np.ndarray]:
        """Ids of every text, as the tokenizers library gives them without special tokens of its own.

        A special token's string inside a text becomes that token's id.
        """
        given = list(texts)
        # stretches of text to be split, and in between (number of the stretch) the special tokens
        parts: list[str] = []
        plans: list[list[int]] = []
        for text in given:
            plan: list[int] = []
            if self.special_split is not None and any(s in text for s in self.specials):
                at = 0
                for m in self.special_split.finditer(text):
                    if m.start() > at:
                        plan.append(len(parts))
                        parts.append(text[at : m.start()])
                    plan.append(-1 - self.specials[m[0]])
                    at = m.end()
                if at < len(text):
                    plan.append(len(parts))
                    parts.append(text[at:])
            elif text:
                plan.append(len(parts))
                parts.append(text)
            plans.append(plan)
        got = self._encode_parts(parts)
        out = []
        for plan in plans:
            if len(plan) == 1 and plan[0] >= 0:
                out.append(got[plan[0]])
            else:
                each = [np.array([-1 - p], dtype=self.dtype) if p < 0 else got[p] for p in plan]
                out.append(np.concatenate([*each, np.array([], dtype=self.dtype)]))
        return out

    def _encode_parts(self, parts: list[str]) -> list[np.ndarray]:
        """Ids of stretches without special tokens: distinct chunks are encoded once, all ids are gathered at a time."""
        if not parts:
            return []
        spelled = [p.encode() for p in parts]
        size = np.fromiter(map(len, spelled), dtype=np.int64, count=len(spelled))
        data = b"".join(spelled)
        raw, ends = np.frombuffer(data, dtype=np.uint8), np.cumsum(size)
        begin, slow = self._borders(raw, ends)
        marked = np.flatnonzero(slow).tolist()
        for i in marked:
            # words tile the text
            begin[ends[i] - size[i] : ends[i]] = False
            at = np.fromiter((len(w.encode()) for w in self.split.findall(parts[i])), dtype=np.int64)
            begin[ends[i] - size[i] + np.concatenate(([0], np.cumsum(at)[:-1]))] = True
        where = np.flatnonzero(begin)
        offsets = np.append(where, len(raw)).astype(np.int64)
        chunks = pa.LargeStringArray.from_buffers(len(where), pa.py_buffer(offsets), pa.py_buffer(data)).dictionary_encode()
        ids = self._chunk_ids(chunks.dictionary.to_pylist())
        length = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids)) // np.dtype(self.dtype).itemsize
        flat = np.frombuffer(b"".join(ids), dtype=self.dtype)
        which = chunks.indices.to_numpy()
        count = length[which]
        stop = np.cumsum(count)
        first = (np.cumsum(length) - length)[which]
        out = flat[np.repeat(first - (stop - count), count) + np.arange(int(stop[-1]))]
        # a text's ids end with its last chunk's
        cut = stop[np.searchsorted(where, ends, side="left") - 1]
        return np.split(out, cut[:-1])

    def decode_bytes(self, ids: np.ndarray) -> bytes:
        """The bytes that the ids spell."""
        ids = ids.astype(np.int64)
        lengths = self.spelled_length[ids]
        total = int(lengths.sum())
        shift = self.spelled_start[ids] - (np.cumsum(lengths) - lengths)
        return self.spelled_bytes[np.repeat(shift, lengths) + np.arange(total)].tobytes()


_LOADED: dict[str, ByteBpe] = {}


def loaded(path: str | None = None) -> ByteBpe:
    """The worker's own copy for a vocabulary file; workers are used again."""
    key = path or ""
    if key not in _LOADED:
        _LOADED[key] = ByteBpe(path)
    return _LOADED[key]


def slices(batches: Iterator[pa.RecordBatch], text: int, most_chars: int = 1_000_000) -> Iterator[pa.RecordBatch]:
    """Cut batches so that each holds about ``most_chars`` characters of column ``text``, one row at least.

    At the end Arrow's free memory goes back to the system: workers are used again, and several share an executor.
    """
    for batch in batches:
        size = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(size)
        at = 0
        while at < batch.num_rows:
            base = ends[at - 1] if at else 0
            stop = max(at + 1, int(np.searchsorted(ends, base + most_chars, side="right")))
            yield batch.slice(at, stop - at)
            at = stop
    pa.default_memory_pool().release_unused()


def encode_documents(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None
) -> DataFrame:
    """``id_col, ids array<int>`` of every row's whole text.

    Null texts count as empty and give no ids; null or repeated keys are kept as
    they are; other columns are not read; an empty table gives no rows. The
    vocabulary's path must exist on every executor.
    """
    key = df.schema[id_col].dataType.simpleString()
    picked = df.select(id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = loaded(vocabulary)
        for batch in slices(batches, 1):
            got = bpe.encode([t or "" for t in batch.column(1).to_pylist()])
            ends = np.concatenate(([0], np.cumsum([len(x) for x in got]))).astype(np.int32)
            flat = np.concatenate([*got, np.array([], dtype=bpe.dtype)]).astype(np.int32)
            ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))
            yield pa.RecordBatch.from_arrays([batch.column(0), ids], names=[id_col, "ids"])

    return picked.mapInArrow(run, f"`{id_col}` {key}, ids array<int>")


def decode_documents(df: DataFrame, id_col: str = "doc_id", ids_col: str = "ids", vocabulary: str | None = None) -> DataFrame:
    """``id_col, text`` spelled by ``ids_col``; special tokens stay, bytes that are no UTF-8 become U+FFFD.

    Null or empty id lists give an empty text.
    """
    key = df.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = loaded(vocabulary)
        for batch in batches:
            texts = [
                bpe.decode_bytes(np.array(x.values.to_numpy() if x.is_valid else [], dtype=np.int64)).decode("utf-8", "replace")
                for x in batch.column(1)
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=[id_col, "text"])

    return df.select(id_col, ids_col).mapInArrow(run, f"`{id_col}` {key}, text string")


def round_trip_digests(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None
) -> DataFrame:
    """``id_col, n_tokens, ids_sha256, decoded_sha256``: encode, decode and digest in one pass.

    Does what :func:`encode_documents` and :func:`decode_documents` do, without
    carrying the ids out of the worker. Nulls as there.
    """
    import hashlib

    key = df.schema[id_col].dataType.simpleString()
    picked = df.select(id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = loaded(vocabulary)
        for batch in slices(batches, 1):
            got = bpe.encode([t or "" for t in batch.column(1).to_pylist()])
            n = [len(x) for x in got]
            first = [hashlib.sha256(x.astype("<u4").tobytes()).hexdigest() for x in got]
            second = []
            for x in got:
                spelled = bpe.decode_bytes(x)
                try:
                    spelled.decode("utf-8")
                except UnicodeDecodeError:
                    spelled = spelled.decode("utf-8", "replace").encode()
                second.append(hashlib.sha256(spelled).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(first, pa.string()), pa.array(second, pa.string())],
                names=[id_col, "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return picked.mapInArrow(run, f"`{id_col}` {key}, n_tokens long, ids_sha256 string, decoded_sha256 string")
