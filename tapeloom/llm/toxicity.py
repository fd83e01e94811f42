"""Toxicity by two class-conditional Kneser-Ney models that share their backoff.

A word is a sequence of letters behind a run of start marks. Each class has its
own counts of letters behind the ``ORDER - 1`` before them; what absolute
discounting takes away goes to one Kneser-Ney model of shorter contexts, whose
continuation counts come from both classes. Rare expressions thus look alike to
both classes and say nothing; inflected forms of a toxic stem share its contexts.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapeloom.llm.bpe import slices
from tapeloom.llm.workspace import staged

#: Letters of the class models' n-grams and of the longest shared context.
ORDER, SHARED_ORDER = 5, 4
#: Counts taken off each class n-gram and each continuation count.
DISCOUNT, SHARED_DISCOUNT = 0.75, 0.75
#: Log-likelihood ratio a word must exceed before it speaks for a class.
MARGIN = 3.0
#: Labelled rows the two numbers of the calibration are fitted on, about this many at most.
CALIBRATION_ROWS = 20_000
#: Words a task remembers so as to list them once.
SEEN_WORDS = 250_000
#: Telling words that are broadcast, those that most tasks met; all others are joined.
HOT_WORDS = 100_000
#: Buckets of the telling words that are joined; they spare other words the shuffle.
REST_BITS = 20
#: Buckets of n-grams with the most that one of them says for toxic; words that cannot exceed MARGIN by them are not joined.
BOUND_BITS = 20
#: Logarithms and weights are summed as whole numbers, so that sums do not depend on their order.
LOG_UNIT, WEIGHT_UNIT = 1e9, 1e6
#: Added to the evidence before its logarithm, and the curve without labels to fit it on.
FLOOR, DEFAULT_CALIBRATION = 1e-3, (2.0, 8.0)
#: Characters of text that a worker splits into words at a time.
SLICE_CHARS = 600_000
#: Buckets of labelled ids that are broadcast to spare unlabelled texts the shuffle.
ID_BUCKETS = 1 << 20
#: Longer words are cut into stretches of this many letters.
WORD_LETTERS = 64

# Fixed value: marks stripped from both ends of a word.
STRIP = ".,;:!?#$%&*|\"'()[]{}<>-_=+~`/\\"

_START, _STOP = 1, 2


def words_of(text: str) -> list[str]:
    """Lower-case words without marks at their ends."""
    return [w for w in [x.strip(STRIP) for x in text.lower().split()] if w]


def grams_of(words: list[str]) -> tuple[np.ndarray, list[str]]:
    """For each letter (and the end) of each word the ``ORDER`` letters that end there, and the word they are of."""
    pad = chr(_START) * (ORDER - 1)
    spelled = [pad + w[i : i + WORD_LETTERS] + chr(_STOP) for w in words for i in range(0, len(w), WORD_LETTERS)]
    owner = [n for n, w in enumerate(words) for _ in range(0, len(w), WORD_LETTERS)]
    size = np.fromiter((len(x) - ORDER + 1 for x in spelled), dtype=np.int64, count=len(spelled))
    return np.repeat(np.array(owner, dtype=np.int64), size), [x[i : i + ORDER] for x in spelled for i in range(len(x) - ORDER + 1)]


def count_words(df: DataFrame, text_col: str, label_col: str, part_col: str) -> DataFrame:
    """``word`` and its counts ``n0a, n1a, n0b, n1b`` by class and part of the training rows.

    Each task sums a batch before the shuffle, so a hot word is one row a batch.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 0, SLICE_CHARS):
            seen: dict[str, list[int]] = {}
            for text, label, part in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                at = 2 * part + label
                for w in words_of(text or ""):
                    row = seen.get(w)
                    if row is None:
                        seen[w] = row = [0, 0, 0, 0]
                    row[at] += 1
            columns = list(zip(*seen.values(), strict=True)) or [[], [], [], []]
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(seen), pa.string()), *[pa.array(c, pa.int64()) for c in columns]], names=["word", "n0a", "n1a", "n0b", "n1b"]
            )

    counted = df.select(text_col, F.col(label_col).cast("int"), F.col(part_col).cast("int")).mapInArrow(
        run, "word string, n0a long, n1a long, n0b long, n1b long"
    )
    return counted.groupBy("word").agg(*[F.sum(c).alias(c) for c in ("n0a", "n1a", "n0b", "n1b")])


def count_grams(words: DataFrame) -> DataFrame:
    """One row per distinct class n-gram: its ``ORDER`` letters and its counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            word, letters = grams_of(batch.column(0).to_pylist())
            counts = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(1, 5)]
            told = pa.array(letters, pa.string()).dictionary_encode()
            at = told.indices.to_numpy()
            sums = [np.bincount(at, weights=c[word], minlength=len(told.dictionary)).astype(np.int64) for c in counts]
            yield pa.RecordBatch.from_arrays([told.dictionary, *map(pa.array, sums)], names=["gram", "n0a", "n1a", "n0b", "n1b"])

    rows = words.mapInArrow(run, "gram string, n0a long, n1a long, n0b long, n1b long")
    return rows.groupBy("gram").agg(*[F.sum(c).alias(c) for c in ("n0a", "n1a", "n0b", "n1b")])


def _tables(grams: DataFrame, totals: dict[str, int]) -> dict:
    """The exact tables of two models (of part a, and of all rows), keyed by letters.

    In each model the larger class is scaled to the smaller, so that both lose
    the same share to the discount. ``grams`` has what is left of each class
    n-gram (``d``), ``contexts`` their sums before (``c``) and after; columns 0
    and 1 are of part a, 2 and 3 of all rows. ``shared`` and ``before`` have the
    continuation counts by order. Only two rows reach the driver.
    """

    def scaled(n0: Column, n1: Column, t0: int, t1: int) -> list[Column]:
        ratio = t1 / t0 if t0 and t1 else 1.0
        return [n0 * min(1.0, ratio), n1 * min(1.0, 1 / ratio)]

    a = [F.col(c).cast("double") for c in ("n0a", "n1a")]
    both = [F.col(f"n{c}a").cast("double") + F.col(f"n{c}b") for c in (0, 1)]
    counts = [*scaled(*a, totals["n0a"], totals["n1a"]), *scaled(*both, totals["n0a"] + totals["n0b"], totals["n1a"] + totals["n1b"])]
    g = grams.select("gram", *[c.alias(f"c{i}") for i, c in enumerate(counts)])
    g = g.withColumns({f"d{i}": F.greatest(F.col(f"c{i}") - DISCOUNT, F.lit(0.0)) for i in range(4)})
    told = F.greatest(*[f"d{i}" for i in range(4)]) > 0
    contexts = g.groupBy(F.substring("gram", 1, ORDER - 1).alias("context")).agg(
        *[F.sum(f"c{i}").alias(f"c{i}") for i in range(4)], *[F.sum(f"d{i}").alias(f"k{i}") for i in range(4)]
    )
    contexts = staged(contexts.where(F.greatest(*[f"k{i}" for i in range(4)]) > 0), "toxic-contexts")
    longer, shared, before = grams.select(F.col("gram").alias("key")), {}, {}
    for k in range(SHARED_ORDER, 0, -1):
        # how many distinct longer n-grams end in each of order k
        longer = longer.groupBy(F.right("key", F.lit(k)).alias("key")).agg(F.count(F.lit(1)).alias("seen"))
        longer = shared[k] = staged(longer, f"toxic-shared{k}")
        before[k] = longer.groupBy(F.substring("key", 1, k - 1).alias("prefix")).agg(F.sum("seen").alias("total"), F.count(F.lit(1)).alias("types"))
    first = before.pop(1).agg(F.sum("total").alias("total"), F.sum("types").alias("types")).first()
    return {
        "grams": g.where(told).select("gram", *[f"d{i}" for i in range(4)]), "contexts": contexts, "shared": shared, "before": before,
        "total": first["total"] or 0, "letters": first["types"] or 0,
    }


def _backoff(ends: DataFrame, tables: dict) -> DataFrame:
    """``key, p``: the shared model's probability of the last letter of each distinct ``key`` of SHARED_ORDER letters."""
    keys = {SHARED_ORDER: ends}
    for k in range(SHARED_ORDER - 1, 0, -1):
        keys[k] = keys[k + 1].select(F.right("key", F.lit(k)).alias("key")).distinct()
    p = None
    for k in range(1, SHARED_ORDER + 1):
        rows = keys[k].join(tables["shared"][k], "key", "left")
        if p is None:
            rows = rows.withColumns({"total": F.lit(tables["total"]), "types": F.lit(tables["letters"]), "q": F.lit(1.0 / max(1, tables["letters"]))})
        else:
            rows = rows.withColumns({"prefix": F.substring("key", 1, k - 1), "rest": F.right("key", F.lit(k - 1))})
            rows = rows.join(tables["before"][k], "prefix", "left").join(p.select(F.col("key").alias("rest"), F.col("p").alias("q")), "rest")
        seen = F.greatest(F.coalesce("seen", F.lit(0)) - SHARED_DISCOUNT, F.lit(0.0))
        p = rows.select("key", F.when(F.col("total") > 0, (seen + SHARED_DISCOUNT * F.col("types") * F.col("q")) / F.col("total")).otherwise(F.col("q")).alias("p"))
    return p


def distinct_words(df: DataFrame, text_col: str) -> DataFrame:
    """``word, n`` of all texts; ``n`` is how often a task listed it, which tells common words from rare ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[str] = set()
        for batch in slices(batches, 0, SLICE_CHARS):
            fresh = set().union(*[words_of(t or "") for t in batch.column(0).to_pylist()]) - seen
            if len(seen) < SEEN_WORDS:
                seen |= fresh
            yield pa.RecordBatch.from_arrays([pa.array(sorted(fresh), pa.string())], names=["word"])

    return df.select(text_col).mapInArrow(run, "word string").groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def word_ratios(words: DataFrame, model: dict, least: float | None = None) -> DataFrame:
    """``word, ratio``: toxic minus ordinary log-likelihood of each of the distinct ``words``, by joins with the exact tables.

    A letter whose context no class knows says nothing; words of such letters
    only are left out, and of those whose ratio is ``least`` or below some too.
    """
    t, i, shared = model["tables"], model["columns"], None

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            word, letters = grams_of(batch.column(0).to_pylist())
            if shared is not None:
                at = np.fromiter((zlib.crc32(x.encode()) >> (32 - BOUND_BITS) for x in letters), dtype=np.int64, count=len(letters))
                able = (np.bincount(word, weights=shared.value[at], minlength=batch.num_rows) > least * LOG_UNIT - 1)[word]
                word, letters = word[able], [x for x, ok in zip(letters, able.tolist(), strict=True) if ok]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(word)), pa.array(letters, pa.string())], names=["word", "gram"])

    def once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(sorted(set(grams_of(batch.column(0).to_pylist())[1])), pa.string())], names=["gram"])

    contexts = t["contexts"].select("context", *[F.col(f"{x}{i + c}").alias(f"{x}{c}") for x in "ck" for c in (0, 1)]).where("k0 > 0 or k1 > 0")
    own = t["grams"].select("gram", *[F.col(f"d{i + c}").alias(f"d{c}") for c in (0, 1)])
    met = words.select("word").mapInArrow(once, "gram string").distinct().withColumn("context", F.substring("gram", 1, ORDER - 1))
    met = met.join(own, "gram", "left").join(contexts, "context")
    # a class's own probability is a + b x p
    part = [F.when(F.col(f"k{c}") > 0, F.coalesce(f"d{c}", F.lit(0.0)) / F.col(f"c{c}")).otherwise(F.lit(0.0)).alias(f"a{c}") for c in (0, 1)]
    part += [F.when(F.col(f"k{c}") > 0, 1 - F.col(f"k{c}") / F.col(f"c{c}")).otherwise(F.lit(1.0)).alias(f"b{c}") for c in (0, 1)]
    met = staged(met.select("gram", F.right("gram", F.lit(SHARED_ORDER)).alias("key"), *part), "toxic-met")
    met = met.join(_backoff(met.select("key").distinct(), t), "key")
    logs = [F.log(F.greatest(F.col(f"a{c}") + F.col(f"b{c}") * F.col("p"), F.lit(1e-30))) for c in (0, 1)]
    says = met.select("gram", F.round((logs[1] - logs[0]) * LOG_UNIT).cast("long").alias("says")).where("says <> 0")
    if least is not None:
        says = staged(says, "toxic-says")
        bucket = F.shiftrightunsigned(F.crc32(F.col("gram").cast("binary")).cast("long"), 32 - BOUND_BITS).cast("int")
        most = says.where("says > 0").groupBy(bucket.alias("b")).agg(F.max("says").alias("says")).toArrow()
        bound = np.zeros(1 << BOUND_BITS, dtype=np.int64)
        bound[most["b"].to_numpy()] = most["says"].to_numpy()
        shared = words.sparkSession.sparkContext.broadcast(bound)

    rows = words.select("word").mapInArrow(listed, "word string, gram string")
    return rows.join(says, "gram").groupBy("word").agg((F.sum("says") / LOG_UNIT).alias("ratio"))


def telling_words(df: DataFrame, model: dict, text_col: str) -> DataFrame:
    """``word, weight, n`` of the words in ``df`` whose ratio exceeds MARGIN; no other word counts in a score."""
    words = staged(distinct_words(df, text_col), "toxic-met-words")
    weight = F.round((F.col("ratio") - MARGIN) * WEIGHT_UNIT).cast("long")
    ratios = word_ratios(words, model, MARGIN).select("word", weight.alias("weight")).where("weight > 0")
    return staged(ratios.join(words, "word"), "toxic-telling")


def _digest(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256)


def _rest_bucket(word: Column) -> Column:
    return F.shiftrightunsigned(F.crc32(word.cast("binary")).cast("long"), 32 - REST_BITS).cast("int")


def _spread(x: np.ndarray) -> np.ndarray:
    """Evidence on a logarithmic scale: it is sparse, and its smallest amounts decide."""
    return np.log(x + FLOOR)


def _calibration(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a logistic curve over the spread evidence, by damped Newton steps; the slope is never negative."""
    if not len(x) or y.min() == y.max():
        return DEFAULT_CALIBRATION
    u = _spread(x)
    a = np.array([1.0, 3.0])
    for _ in range(80):
        p = 1 / (1 + np.exp(-np.clip(a[0] * u + a[1], -500, 500)))
        w = p * (1 - p) + 1e-9
        grad = np.array([((y - p) * u).sum(), (y - p).sum()]) - 1e-3 * a
        hess = np.array([[(w * u * u).sum() + 1e-3, (w * u).sum()], [(w * u).sum(), w.sum() + 1e-3]])
        step = np.clip(np.linalg.solve(hess, grad), -2, 2)
        a = a + step
        if np.abs(step).max() < 1e-7:
            break
    return float(max(a[0], 0.0)), float(a[1])


def fit(labelled: DataFrame, text_col: str = "text", label_col: str = "toxic", part_col: str = "part") -> dict:
    """Fit both models on all rows of ``labelled`` with a label.

    ``part_col`` deals the rows in two (0 and 1): models of part 0 score rows of
    part 1 to calibrate the score (on about CALIBRATION_ROWS rows, chosen by the
    hash of their text), then the counts of both parts make the final model. Its
    tables stay in Spark; no count is merged with another.
    """
    rows = labelled.where(F.col(label_col).isin(0, 1)).select(
        F.col(text_col).alias("text"), F.col(label_col).cast("int").alias("y"), F.col(part_col).cast("int").alias("part")
    )
    grams = staged(count_grams(staged(count_words(rows, "text", "y", "part"), "toxic-words")), "toxic-grams")
    totals = grams.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("n0a", "n1a", "n0b", "n1b")]).first().asDict()
    tables = _tables(grams, totals)
    half, full = ({"tables": tables, "columns": i, "calibration": DEFAULT_CALIBRATION} for i in (0, 2))
    held = rows.where("part = 1")
    share = min(1.0, CALIBRATION_ROWS / max(1, held.count()))
    held = staged(held.where(F.pmod(F.xxhash64("text"), F.lit(1 << 20)) < int(share * (1 << 20))).select("text", "y"), "toxic-held")
    got = evidence(held, half, ["y"], "text").toArrow()
    x, y = got["evidence"].to_numpy(), got["y"].to_numpy()
    order = np.lexsort((y, x))
    full["calibration"] = _calibration(x[order], y[order].astype(float))
    return full


def evidence(df: DataFrame, model: dict, keep: list[str], text_col: str = "text") -> DataFrame:
    """``keep`` columns and ``evidence`` of every row: what its words' ratios exceed MARGIN by, summed and divided by the number of words.

    The HOT_WORDS most common telling words are looked up in the workers. Of
    all others each text lists its own, and these are joined; equal texts are
    joined once.
    """
    telling = telling_words(df, model, text_col)
    hot = telling.orderBy(F.desc("n"), "word").limit(HOT_WORDS).select("word", "weight").toArrow()
    weights = dict(zip(hot["word"].to_pylist(), hot["weight"].to_pylist(), strict=True))
    rest = open_buckets = None
    if telling.count() > len(weights):
        common = df.sparkSession.createDataFrame(hot.select(["word"]))
        rest = staged(telling.join(F.broadcast(common), "word", "left_anti").select("word", "weight"), "toxic-rest")
        found = rest.select(_rest_bucket(F.col("word")).alias("b")).distinct().toArrow()["b"].to_numpy()
        marks = np.zeros(1 << REST_BITS, dtype=bool)
        marks[found] = True
        open_buckets = np.packbits(marks)
    shared = df.sparkSession.sparkContext.broadcast((weights, open_buckets))
    names = [f"_keep{i}" for i in range(len(keep))]

    kind = pa.struct([("sum", pa.int64()), ("words", pa.int64()), *([] if rest is None else [("open", pa.list_(pa.string()))])])

    # only the text goes to the workers, and only what it says comes back; its row stays in the JVM
    @F.arrow_udf("sum long, words long" + ("" if rest is None else ", open array<string>"))
    def told(texts: pa.Array) -> pa.Array:
        weights, buckets = shared.value
        look = weights.get
        parts = [pa.array([], kind)]
        for batch in slices(iter([pa.RecordBatch.from_arrays([texts], names=["text"])]), 0, SLICE_CHARS):
            lists = [words_of(t or "") for t in batch.column(0).to_pylist()]
            columns = [pa.array([sum([look(w, 0) for w in ws]) for ws in lists], pa.int64()), pa.array(map(len, lists), pa.int64())]
            if buckets is not None:
                fresh = [w for w in set().union(*lists) if w not in weights]
                hashes = [zlib.crc32(w.encode()) >> (32 - REST_BITS) for w in fresh]
                may = {w for w, h in zip(fresh, hashes, strict=True) if buckets[h >> 3] >> (7 - (h & 7)) & 1}
                columns.append(pa.array([[w for w in ws if w in may] for ws in lists], pa.list_(pa.string())))
            parts.append(pa.StructArray.from_arrays(columns, fields=list(kind)))
        return pa.concat_arrays(parts)

    # each text is looked at once, whatever is asked of the result
    found = told.asNondeterministic()(F.col(text_col)).alias("_told")
    digest = [] if rest is None else [_digest(F.col(text_col)).alias("_digest")]
    rows = df.select(*[F.col(c).alias(n) for n, c in zip(names, keep, strict=True)], *digest, found)
    rows = rows.select(*rows.columns[:-1], *[F.col(f"_told.{c}").alias(f"_{c}") for c in ["sum", "words", *([] if rest is None else ["open"])]])
    total = F.col("_sum")
    if rest is not None:
        rows = staged(rows, "toxic-open")
        listed = rows.where(F.size("_open") > 0).groupBy("_digest").agg(F.first("_open").alias("_open"))
        listed = listed.select("_digest", F.explode("_open").alias("word")).groupBy("_digest", "word").agg(F.count(F.lit(1)).alias("times"))
        more = listed.join(rest, "word").groupBy("_digest").agg(F.sum(F.col("times") * F.col("weight")).alias("_more"))
        rows = rows.join(more, "_digest", "left")
        total = total + F.coalesce("_more", F.lit(0))
    x = F.when(F.col("_words") > 0, total / WEIGHT_UNIT / F.col("_words")).otherwise(F.lit(0.0))
    return rows.select(*[F.col(n).alias(c) for n, c in zip(names, keep, strict=True)], x.alias("evidence"))


def _score(evidence: Column, model: dict) -> Column:
    slope, shift = model["calibration"]
    x = F.log(evidence + FLOOR) * slope + shift
    return 1 / (1 + F.exp(-F.greatest(F.least(x, F.lit(500.0)), F.lit(-500.0))))


def score_documents(df: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, score, predicted`` of every row; the whole text is read.

    Null and empty texts, and texts without a telling word, get the score of no
    evidence. Null and repeated ids are kept; other columns are not read; an
    empty table gives no rows.
    """
    scored = evidence(df, model, [id_col], text_col).select(id_col, _score(F.col("evidence"), model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def drop_toxic(df: DataFrame, model: dict, text_col: str = "text") -> DataFrame:
    """The rows of ``df`` that are not predicted toxic, with all their columns."""
    return evidence(df, model, df.columns, text_col).where(_score(F.col("evidence"), model) < 0.5).drop("evidence")


def fold(id_col: str) -> Column:
    """crc32 of the id as text, modulo 5 (null: the empty text)."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 5


def training_rows(documents: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "toxic") -> DataFrame:
    """``text, toxic, part`` of the labelled documents outside fold 0; fold 4 is part 1.

    Labels may be as many as documents, so the join is a shuffle; the buckets of
    their ids, ID_BUCKETS numbers at most, go ahead by broadcast and keep most
    unlabelled texts out of it.
    """

    def bucket() -> Column:
        return F.pmod(F.xxhash64(F.col(id_col).cast("long")), F.lit(ID_BUCKETS)).cast("int").alias("_bucket")

    known = labels.where(F.col(id_col).isNotNull() & (fold(id_col) != 0)).select(id_col, F.col(label_col).alias("toxic"))
    texts = documents.where(F.col(id_col).isNotNull() & (fold(id_col) != 0)).select(id_col, "text", bucket())
    texts = texts.join(F.broadcast(known.select(bucket()).distinct()), "_bucket", "left_semi")
    return texts.join(known.hint("merge"), id_col).select("text", "toxic", (fold(id_col) == 4).cast("int").alias("part"))
