"""The same ids as :mod:`tapeloom.llm.bpe`, by the tiktoken library, for operators whose method is not the encoding itself."""

from __future__ import annotations

import json
from collections.abc import Iterable

import numpy as np
import tiktoken

from tapeloom.llm.bpe import SPLIT, ByteBpe, byte_letters, default_vocabulary, loaded


class RankBpe:
    """A vocabulary file whose ids ascend with the ranks of their merges; an id is then its own rank."""

    def __init__(self, spec: dict):
        byte_of = {c: b for b, c in enumerate(byte_letters())}
        spelled = {i: bytes(byte_of[c] for c in token) for token, i in spec["model"]["vocab"].items()}
        specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        ranks = {word: i for i, word in spelled.items() if i not in specials.values()}
        self.coding = tiktoken.Encoding("vocabulary", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens=specials)
        self.spelled = [b""] * (max([*spelled, *specials.values()]) + 1)
        for i, word in spelled.items():
            self.spelled[i] = word
        for token, i in specials.items():
            self.spelled[i] = token.encode()

    def encode(self, texts: Iterable[str]) -> list[np.ndarray]:
        """Ids of every text; a special token's string inside a text becomes that token's id."""
        return [self.coding.encode_to_numpy(t, allowed_special="all") for t in texts]


def _ranked(spec: dict) -> bool:
    """Whether ids ascend with merges, behind those of the single bytes."""
    vocab = spec["model"]["vocab"]
    pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in spec["model"]["merges"]]
    made = [vocab[a + b] for a, b in pairs]
    return made == sorted(made) and len(set(made)) == len(made) and all(vocab[c] < min(made, default=1 << 60) for c in byte_letters())


_LOADED: dict[str, RankBpe | ByteBpe] = {}


def loaded_ranks(path: str | None = None) -> RankBpe | ByteBpe:
    """The worker's own encoder for a vocabulary file; where ids do not follow ranks, the segment-tree one."""
    key = path or ""
    if key not in _LOADED:
        with open(path or default_vocabulary(), encoding="utf-8") as f:
            spec = json.load(f)
        _LOADED[key] = RankBpe(spec) if _ranked(spec) else loaded(path)
    return _LOADED[key]
