"""Quality rules: boosted trees over document statistics, scored from flat node arrays."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapeloom.llm.bpe import slices

#: Labelled rows the trees are grown on, at most: those whose ids hash lowest.
TRAINING_ROWS = 20_000

# The characters that count as symbols, and white space between words.
SYMBOLS = b"#*$%&|<>"
SPACES = " \t\n\v\f\r"

#: Features in the order of the matrix, and the direction in which the verdict
#: may move with each (+1 only up, -1 only down, 0 free).
FEATURES: dict[str, int] = {
    "log_words": 0,
    "chars_per_word": 0,
    "symbols_per_word": -1,
    "dup_line_share": -1,
    "repeat_word_share": -1,
    "distinct_word_share": 0,
    "capital_share": -1,
    "digit_share": 0,
    "bangs_per_word": -1,
    "stops_per_word": 0,
    "lines_per_word": 0,
    "other_byte_share": 0,
    "short_word_share": 0,
    "longest_word": 0,
}

_UPPER = np.arange(65, 91)
_LOWER = np.arange(97, 123)
_DIGIT = np.arange(48, 58)


def statistics(text: str) -> tuple[tuple[int, int, int, int, int], list[float]]:
    """Exact counts of one text and the features made from them.

    Counts: words, code points in words, symbols, lines with a word equal to an
    earlier line, words inside 3-word windows that occur twice or more.
    """
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()  # on bytes: space and 09 to 0D only
    n = len(words)
    word_chars = len(text) - sum(map(text.count, SPACES))
    histogram = np.bincount(np.frombuffer(raw, dtype=np.uint8), minlength=256)
    symbols = int(histogram[list(SYMBOLS)].sum())
    lines = [x for x in raw.split(b"\n") if x and not x.isspace()]
    dup_lines = len(lines) - len(set(lines))
    local: dict[bytes, int] = {}
    codes = np.fromiter((local.setdefault(w, len(local)) for w in words), dtype=np.int64, count=n)
    repeat_words = 0
    if n >= 4:
        v = len(local)
        if v < 1 << 20:
            windows = (codes[:-2] * v + codes[1:-1]) * v + codes[2:]
        else:
            _, pairs = np.unique(codes[:-1] * v + codes[1:], return_inverse=True)
            windows = pairs[:-1] * v + codes[2:]
        order = np.argsort(windows, kind="stable")
        equal = windows[order[1:]] == windows[order[:-1]]
        again = np.zeros(n - 2, dtype=bool)
        again[order[1:][equal]] = True
        again[order[:-1][equal]] = True
        covered = np.zeros(n, dtype=bool)
        covered[:-2] |= again
        covered[1:-1] |= again
        covered[2:] |= again
        repeat_words = int(covered.sum())
    counts = (n, word_chars, symbols, dup_lines, repeat_words)
    per, letters = max(n, 1), max(int(histogram[_UPPER].sum() + histogram[_LOWER].sum()), 1)
    lengths = [len(w) for w in local]
    features = [
        float(np.log1p(n)), word_chars / per, symbols / per, dup_lines / max(len(lines), 1), repeat_words / per,
        len(local) / per, int(histogram[_UPPER].sum()) / letters, int(histogram[_DIGIT].sum()) / max(word_chars, 1),
        int(histogram[33]) / per, int(histogram[46]) / per, len(lines) / per, int(histogram[128:].sum()) / max(len(raw), 1),
        sum(x <= 3 for x in lengths) / max(len(lengths), 1), float(np.log1p(max(lengths, default=0))),
    ]
    return counts, features


@dataclass
class Trees:
    """All nodes of all trees behind each other; a leaf is its own child."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    depth: int
    base: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Probability of the good class for each row: every tree walks down at once."""
        if not len(self.roots) or not len(x):
            return np.full(len(x), 1 / (1 + np.exp(-self.base)))
        rows = np.arange(len(x))[:, None]
        at = np.broadcast_to(self.roots, (len(x), len(self.roots)))
        for _ in range(self.depth):
            go = x[rows, self.feature[at]] <= self.threshold[at]
            at = np.where(go, self.left[at], self.right[at])
        return 1 / (1 + np.exp(-(self.base + self.value[at].sum(axis=1))))


def grow(
    x: np.ndarray,
    y: np.ndarray,
    directions: list[int],
    n_trees: int = 60,
    depth: int = 4,
    rate: float = 0.15,
    bins: int = 64,
    least_rows: int = 20,
    ridge: float = 1.0,
) -> Trees:
    """Gradient-boosted trees for the logistic loss, monotone in the constrained features.

    Features are binned by quantiles. A split on a constrained feature is taken
    only if its two leaf values are in order; the children then stay on their
    side of the middle between them, so no deeper split can break the order.
    """
    n, width = x.shape
    p = float(np.clip(y.mean(), 1e-6, 1 - 1e-6)) if n else 0.5
    base = float(np.log(p / (1 - p)))
    nodes: list[list[float]] = []  # feature, threshold, left, right, value
    roots: list[int] = []
    if n < 2 * least_rows or p in (1e-6, 1 - 1e-6):
        empty = np.array([], dtype=np.int64)
        return Trees(empty, empty.astype(float), empty, empty, empty.astype(float), empty, 0, base)
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(width)]
    binned = np.stack([np.searchsorted(c, x[:, f], side="left") for f, c in enumerate(cuts)], axis=1)
    score = np.full(n, base)

    def leaf(g: float, h: float, low: float, high: float) -> float:
        return float(min(max(g / (h + ridge), low), high))

    for _ in range(n_trees):
        q = 1 / (1 + np.exp(-score))
        grad, hess = y - q, np.maximum(q * (1 - q), 1e-9)
        roots.append(len(nodes))
        nodes.append([0, 0.0, len(nodes), len(nodes), leaf(grad.sum(), hess.sum(), -1e9, 1e9)])
        level = [(len(nodes) - 1, np.arange(n), -1e9, 1e9)]
        for _ in range(depth):
            following = []
            for node, rows, low, high in level:
                if len(rows) < 2 * least_rows:
                    continue
                g_all, h_all = grad[rows].sum(), hess[rows].sum()
                best = (1e-6, -1, 0, 0.0, 0.0)
                for f in range(width):
                    b = binned[rows, f]
                    size = len(cuts[f]) + 1
                    g = np.cumsum(np.bincount(b, grad[rows], size))[:-1]
                    h = np.cumsum(np.bincount(b, hess[rows], size))[:-1]
                    c = np.cumsum(np.bincount(b, minlength=size))[:-1]
                    if not len(g):
                        continue
                    vl = np.clip(g / (h + ridge), low, high)
                    vr = np.clip((g_all - g) / (h_all - h + ridge), low, high)
                    gain = g * vl - 0.5 * (h + ridge) * vl**2 + (g_all - g) * vr - 0.5 * (h_all - h + ridge) * vr**2
                    v0 = np.clip(g_all / (h_all + ridge), low, high)
                    gain = gain - (g_all * v0 - 0.5 * (h_all + ridge) * v0**2)
                    bad = (c < least_rows) | (len(rows) - c < least_rows)
                    if directions[f]:
                        bad |= (vr - vl) * directions[f] < 0
                    gain = np.where(bad, -np.inf, gain)
                    k = int(np.argmax(gain))
                    if gain[k] > best[0]:
                        best = (float(gain[k]), f, k, float(vl[k]), float(vr[k]))
                _, f, k, vl, vr = best
                if f < 0:
                    continue
                here = binned[rows, f] <= k
                bounds = [(low, high), (low, high)]
                if directions[f]:
                    mid = (vl + vr) / 2
                    bounds = [(low, mid), (mid, high)] if directions[f] > 0 else [(mid, high), (low, mid)]
                kids = []
                for side, (lo, hi) in ((rows[here], bounds[0]), (rows[~here], bounds[1])):
                    nodes.append([0, 0.0, len(nodes), len(nodes), leaf(grad[side].sum(), hess[side].sum(), lo, hi)])
                    kids.append(len(nodes) - 1)
                    following.append((len(nodes) - 1, side, lo, hi))
                nodes[node] = [f, float(cuts[f][k]), kids[0], kids[1], 0.0]
            level = following
        for item in range(roots[-1], len(nodes)):
            nodes[item][4] *= rate
        one = _flat(nodes, roots[-1:], depth, 0.0)
        score = score + _walk(one, x)
    return _flat(nodes, roots, depth, base)


def _flat(nodes: list[list[float]], roots: list[int], depth: int, base: float) -> Trees:
    f, t, left, right, v = (np.array(c) for c in zip(*nodes, strict=True))
    whole = np.int64
    return Trees(f.astype(whole), t.astype(float), left.astype(whole), right.astype(whole), v.astype(float), np.array(roots, dtype=whole), depth, base)


def _walk(trees: Trees, x: np.ndarray) -> np.ndarray:
    at = np.full(len(x), trees.roots[0])
    for _ in range(trees.depth):
        at = np.where(x[np.arange(len(x)), trees.feature[at]] <= trees.threshold[at], trees.left[at], trees.right[at])
    return trees.value[at]


def document_features(df: DataFrame, keep: list[str], text_col: str = "text") -> DataFrame:
    """``keep`` columns and ``features array<double>`` of every row's whole text."""
    schema = ", ".join([f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keep] + ["features array<double>"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, len(keep)):
            x = [statistics(t or "")[1] for t in batch.column(len(keep)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], pa.array(x, pa.list_(pa.float64()))], names=[*keep, "features"])

    return df.select(*keep, F.col(text_col).alias("_text")).mapInArrow(run, schema)


def fit(
    documents: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    training_rows: int = TRAINING_ROWS,
) -> Trees:
    """Grow the trees on at most ``training_rows`` labelled documents (the lowest hashes of the id).

    The sample is joined by broadcast, so the texts are read where they lie.
    Labels other than 0 and 1 and null ids are passed over; without both labels
    the verdict is the labels' share alone (0.5 without any).
    """
    sample = (
        labels.where(F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1))
        .select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("_y"))
        .orderBy(F.xxhash64("_id"), "_id", "_y").limit(training_rows)
    )
    rows = documents.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).join(F.broadcast(sample), "_id")
    got = document_features(rows, ["_id", "_y"], "_text").toArrow()
    y = got["_y"].to_numpy().astype(float)
    x = np.array(got["features"].to_pylist(), dtype=float).reshape(len(y), len(FEATURES))
    order = np.lexsort([*x.T[::-1], y, got["_id"].to_numpy()])
    return grow(x[order], y[order], list(FEATURES.values()))


def _judged(texts: list[str | None], trees: Trees) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Counts, base verdict, score and final verdict of texts."""
    both = [statistics(t or "") for t in texts]
    counts = np.array([c for c, _ in both], dtype=np.int64).reshape(len(both), 5)
    score = trees.scores(np.array([f for _, f in both], dtype=float).reshape(len(both), len(FEATURES)))
    failed = (counts[:, 0] < 50) | (100 * counts[:, 4] > 50 * counts[:, 0])
    return counts, failed, score, ~failed & (score >= 0.5)


def judge_documents(df: DataFrame, trees: Trees, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts and verdict of every row.

    Returns ``id_col, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, score, kept``. Null texts have no words and
    fail. Null and repeated ids are kept; other columns are not read; an empty
    table gives no rows.
    """
    shared = df.sparkSession.sparkContext.broadcast(trees)
    key = df.schema[id_col].dataType.simpleString()
    names = [id_col, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "score", "kept"]
    schema = f"`{id_col}` {key}, " + ", ".join(f"{c} long" for c in names[1:6]) + ", base_failed boolean, score double, kept boolean"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            counts, failed, score, kept = _judged(batch.column(1).to_pylist(), shared.value)
            columns = [batch.column(0), *[pa.array(counts[:, i]) for i in range(5)], pa.array(failed), pa.array(score), pa.array(kept)]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return df.select(id_col, text_col).mapInArrow(run, schema)


def drop_low_quality(df: DataFrame, trees: Trees, text_col: str = "text") -> DataFrame:
    """The rows of ``df`` that are kept, with all their columns."""
    shared = df.sparkSession.sparkContext.broadcast(trees)
    at = df.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, at):
            yield batch.filter(pa.array(_judged(batch.column(at).to_pylist(), shared.value)[3]))

    return df.mapInArrow(run, df.schema)
