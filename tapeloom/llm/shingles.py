"""Sets of five-word shingles as 64-bit hashes, for whole texts."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np

WIDTH = 5
_ODD = np.uint64(0x9E3779B97F4A7C15)
#: Bytes of text that are hashed at a time.
SLICE_BYTES = 500_000


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


_BORDER = re.compile(rb"[\x20\x09-\x0D]")
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, *range(9, 14)]] = True
#: A random number for every byte; white space counts nothing.
_BYTE = np.where(_SPACE, np.uint64(0), mixed(np.arange(1, 257, dtype=np.uint64) * _ODD))


def _powers(n: int) -> np.ndarray:
    return np.cumprod(np.concatenate(([np.uint64(1)], np.full(max(0, n - 1), np.uint64(0xD1342543DE82EF95)))), dtype=np.uint64)


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts, and how many words each text has.

    A-Z are lower-cased; words are separated by 20 and 09 to 0D only. A word's
    hash is a polynomial over random numbers of its bytes, mixed with its length.
    """
    raw = np.frombuffer(b"\n".join([*texts, b""]).lower(), dtype=np.uint8)
    ends = np.cumsum(np.fromiter((len(t) + 1 for t in texts), dtype=np.int64, count=len(texts)))
    inside = ~_SPACE[raw]
    edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    if len(raw) and inside[0]:
        edge = np.concatenate(([0], edge))
    start, stop = edge[::2], edge[1::2]
    if not len(start):
        return np.array([], dtype=np.uint64), np.zeros(len(texts), dtype=np.int64)
    # every byte's place behind the start of its word; white space behind a word counts nothing
    reach = np.diff(np.concatenate((start, [len(raw)])))
    place = np.arange(start[0], len(raw)) - np.repeat(start, reach)
    power = _powers(int((stop - start).max()) + 1)
    terms = _BYTE[raw[start[0] :]] * power[np.minimum(place, len(power) - 1)]
    words = mixed(np.add.reduceat(terms, start - start[0]) + (stop - start).astype(np.uint64) * _ODD)
    return words, np.diff(np.concatenate(([0], np.searchsorted(start, ends))))


def shingle_sets(texts: list[str | None], width: int = WIDTH) -> list[np.ndarray]:
    """For each text its distinct shingles, ascending.

    A text of fewer than ``width`` words is one shingle, one without words none.
    """
    spelled = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    out: list[np.ndarray] = []
    at = 0
    while at < len(spelled):
        stop, size = at, 0
        while stop < len(spelled) and (stop == at or size + len(spelled[stop]) <= SLICE_BYTES):
            size += len(spelled[stop])
            stop += 1
        if size > SLICE_BYTES:  # one long text: its words are hashed in pieces that end at white space
            words = np.concatenate([word_hashes([piece])[0] for piece in _pieces(spelled[at])])
            out += _sets(words, np.array([len(words)]), width)
        else:
            out += _sets(*word_hashes(spelled[at:stop]), width)
        at = stop
    return out


def _pieces(text: bytes) -> Iterator[bytes]:
    at = 0
    while at < len(text):
        border = _BORDER.search(text, at + SLICE_BYTES)
        stop = border.start() if border else len(text)
        yield text[at:stop]
        at = stop


def _sets(words: np.ndarray, sizes: np.ndarray, width: int) -> list[np.ndarray]:
    ends = np.cumsum(sizes)
    rolled = np.zeros(max(0, len(words) - width + 1), dtype=np.uint64)
    for i in range(width):
        rolled = rolled * _ODD + words[i : i + len(rolled)]
    rolled = mixed(rolled)
    out = []
    for n, end in zip(sizes.tolist(), ends.tolist(), strict=True):
        start = end - n
        if n >= width:
            found = np.sort(rolled[start : end - width + 1])
            keep = np.ones(len(found), dtype=bool)
            np.not_equal(found[1:], found[:-1], out=keep[1:])
            out.append(found[keep])
        elif n:
            h = np.full(1, n, dtype=np.uint64)
            for w in words[start:end]:
                h = h * _ODD + w
            out.append(mixed(h ^ np.uint64(0x5BD1E995)))
        else:
            out.append(np.array([], dtype=np.uint64))
    return out
