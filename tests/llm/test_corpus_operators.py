"""Near-duplicates, components, models and the pipeline against brute force."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np

from tapeloom.llm import jaccard_join, neardup_vectors, quality, shingles, toxicity
from tapeloom.llm.components import connected_components
from tests.conftest import SMALL


def _roots(nodes, links):
    up = {n: n for n in nodes}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components(spark):
    rnd = random.Random(1)
    links = [(rnd.randrange(200), rnd.randrange(200)) for _ in range(110)] + [(i, i + 1) for i in range(300, 340)] + [(500, 500 + i) for i in range(60)]
    df = spark.createDataFrame([*links, (None, 3)], "a long, b long")
    want = _roots({x for p in links for x in p}, links)
    got = {r["node"]: r["component"] for r in connected_components(df).collect()}
    assert got == {n: want[n] for n in got} and all(n in got for p in links if p[0] != p[1] for n in p)
    assert connected_components(df.limit(0)).count() == 0


def test_vectors(spark):
    rng = np.random.default_rng(2)
    base = rng.standard_normal((30, 16))
    rows = [(i, (base[i % 30] + (0.12 if i % 3 else 0.0) * rng.standard_normal(16)).tolist(), i % 2 if i % 30 else None, i) for i in range(120)]
    rows += [(200, [0.0] * 16, 1, 0), (201, [float("nan")] * 16, 1, 0), (202, None, 1, 0), (203, [], 1, 0), (204, [1.0, None] * 8, 1, 0), (205, rows[1][1], 1, 0), (206, rows[1][1], 1, 0), (None, rows[1][1], 1, 0), (207, [1.0] * 4, 1, 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int, n_links int")
    got = {r["vec_id"]: r for r in neardup_vectors.near_duplicates(df).collect()}
    good = [(i, np.array(v), lab) for i, v, lab, _ in rows if i is not None and lab is not None and v and None not in v and np.isfinite(v).all() and any(v)]
    links = [(a, b) for x, (a, u, p) in enumerate(good) for b, v, q in good[x + 1 :] if p == q and len(u) == len(v) and u @ v >= 0.98 * np.linalg.norm(u) * np.linalg.norm(v)]
    want = _roots([r[0] for r in rows if r[0] is not None], links)
    n = Counter(x for p in links for x in p)
    assert len(links) > 10
    for i in want:
        assert (got[i]["n_links"], got[i]["component_id"], got[i]["kept"]) == (n[i], want[i], want[i] == i)
    assert neardup_vectors.near_duplicates(df.limit(0)).count() == 0


WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _set(text):
    w = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def test_vectors_of_any_size_and_label(spark):
    for scale in (1e200, 1e-200, 1.0):
        rows = [(1, [scale, 0.0], "a"), (2, [0.783 * scale, 0.622 * scale], "a"), (3, [scale, 0.1 * scale], "a"), (4, [scale, 0.05 * scale], "b"), (5, [1.0, 0.001], "a")]
        df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string")
        got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in neardup_vectors.near_duplicates(df).collect()}
        assert got == {1: (2, 1), 2: (0, 2), 3: (2, 1), 4: (0, 4), 5: (2, 1)}
    half = spark.createDataFrame([(1, [1.0, 0.0], 1.2), (2, [1.0, 0.0], 1.7), (3, [1.0, 0.0], 1.2)], "vec_id long, embedding array<double>, label double")
    assert {r["vec_id"]: r["component_id"] for r in neardup_vectors.near_duplicates(half).collect()} == {1: 1, 2: 2, 3: 1}


def test_shingles():
    texts = ["One two three four five six", "one TWO three four five", "É é a b c d", "a b", "", None, " \t\n", "x y z a b c", "a a a a a a a"]
    got = shingles.shingle_sets(texts)
    for t, s in zip(texts, got, strict=True):
        assert len(s) == len(_set(t))
    assert len(set(got[0].tolist()) & set(got[1].tolist())) == 1


def test_similar_sets_share_a_key():
    rng = np.random.default_rng(4)
    bound = jaccard_join.Bound()
    for double in (False, True):
        bands = [jaccard_join.Band(u, max(1, u // 4) if double else u, double) for u in jaccard_join.band_uppers(900)]
        for _ in range(300):
            n = int(rng.integers(1, 600))
            s = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
            gone = int(rng.integers(0, n // 5 + 1))
            t = np.unique(np.concatenate((s[gone:], rng.integers(0, 2**63, int(rng.integers(0, n // 6 + 1))).astype(np.uint64))))
            shared = len(np.intersect1d(s, t))
            if not shared or 100 * shared < 75 * (len(s) + len(t) - shared):
                continue
            hot = np.zeros(1 << jaccard_join.SKETCH_BITS, dtype=bool)
            hot[(rng.permutation(s)[: n // 2] >> np.uint64(64 - jaccard_join.SKETCH_BITS)).astype(np.int64)] = True
            common = np.packbits(hot)
            a, b = (set(jaccard_join.keys_of(x, common, bands, bound).tolist()) for x in (s, t))
            assert a & b
            sig = [np.frombuffer(jaccard_join.signature_of(x), dtype=np.uint8)[None, :] for x in (s, t)]
            w = min(x.shape[1] for x in sig)
            assert jaccard_join._close_enough(np.array([len(s)]), np.array([len(t)]), *[jaccard_join._folded(x, w) for x in sig], bound).all()


def _documents():
    rnd = random.Random(6)
    words = [f"w{i}" for i in range(400)]
    passage = " ".join(rnd.choice(words) for _ in range(60))
    rows = []
    for i in range(60):
        rows.append((i, " ".join(rnd.choice(words) for _ in range(rnd.randrange(1, 90)))))
    for i in range(60, 160):
        w = rows[i % 20][1].split()
        for _ in range(rnd.randrange(3)):
            w[rnd.randrange(len(w))] = rnd.choice(words)
        rows.append((i, " ".join(w).upper() if i % 7 == 0 else " ".join(w)))
    rows += [(i, passage + " " + " ".join(rnd.choice(words) for _ in range(30))) for i in range(160, 200)]
    return rows + [(300, None), (301, ""), (302, " \n"), (303, "w1"), (304, "W1"), (None, rows[0][1]), (5, rows[5][1])]


def test_jaccard_links(spark):
    rows = _documents()
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, component_id string").repartition(5)
    got = jaccard_join.link_documents(df).collect()
    assert len(got) == len(rows)
    sets = [(i, _set(t)) for i, t in rows if i is not None]
    links = [(a, b) for x, (a, s) in enumerate(sets) for b, t in sets[x + 1 :] if s and t and 100 * len(s & t) >= 75 * len(s | t)]
    want = _roots([i for i, _ in sets], links)
    for r in got:
        if r["doc_id"] is not None:
            assert r["component_id"] == want[r["doc_id"]]
            assert r["n_shingles"] in {len(s) for i, s in sets if i == r["doc_id"]}
    kept = jaccard_join.keep_one_of_each(df)
    assert kept.columns == df.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert sorted(x for x in ids if x is not None) == sorted({c for c in want.values()}) and ids.count(None) == 1
    assert jaccard_join.link_documents(df.limit(0)).count() == 0 and jaccard_join.keep_one_of_each(df.limit(0)).count() == 0


def _counts(text):
    w = WORD.findall(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    c = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    cover = {j for i in range(len(w) - 2) if c[tuple(w[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
    return len(w), sum(map(len, w)), sum(ch in "#*$%&|<>" for ch in text), dup, len(cover)


def test_statistics():
    rnd = random.Random(8)
    parts = ["a", "b", "c d", "\n", " ", "é#", "|x|", " ", "\x0b", "same line\n"]
    for _ in range(500):
        t = "".join(rnd.choice(parts) for _ in range(rnd.randrange(40)))
        assert quality.statistics(t)[0] == _counts(t)


def test_trees_are_monotone_and_learn():
    rng = np.random.default_rng(9)
    x = rng.uniform(size=(1500, 3))
    y = ((x[:, 0] < 0.5) | (rng.uniform(size=1500) < 0.05)).astype(float)
    trees = quality.grow(x, y, [-1, 1, 0], n_trees=30)
    assert ((trees.scores(x) >= 0.5) == y).mean() > 0.9
    grid = np.linspace(-0.1, 1.1, 60)
    for f, sign in ((0, -1), (1, 1)):
        for row in x[:20]:
            line = np.repeat(row[None, :], len(grid), axis=0)
            line[:, f] = grid
            assert (np.diff(trees.scores(line)) * sign >= -1e-12).all()
    assert (quality.grow(x[:5], y[:5], [0, 0, 0]).scores(x) > 0).all()


def test_quality_rows(spark):
    text = " ".join(f"word{i}" for i in range(80)) + "."
    df = spark.createDataFrame([(1, text, "x"), (None, None, "x"), (2, "a b c " * 60, "x"), (1, "", "x")], "doc_id long, text string, kept string")
    labels = spark.createDataFrame([(1, 1), (2, 0), (None, 1)], "doc_id long, quality int")
    trees = quality.fit(df, labels)
    got = quality.judge_documents(df, trees).collect()
    assert sum(r["base_failed"] for r in got) == 3
    assert quality.drop_low_quality(df, trees).columns == df.columns
    assert quality.judge_documents(df.limit(0), trees).count() == 0
    assert quality.fit(df.limit(0), labels.limit(0)).scores(np.zeros((1, len(quality.FEATURES))))[0] == 0.5


def test_small_sets_share_a_key():
    rnd = np.random.default_rng(21)
    bound = jaccard_join.Bound()
    common = np.zeros(1 << (jaccard_join.SKETCH_BITS - 3), dtype=np.uint8)
    common[::3] = 0xFF
    for population, rate in ((10**6, 0.01), (10, 0.0)):
        bands = [jaccard_join.allocate(u, population, rate, bound) for u in jaccard_join.band_uppers(100)]
        for n in range(1, 27):
            for m in range(n, bound.largest_partner(n) + 1):
                most = bound.budget(n, m)
                for some in range(40):
                    shared = n - (most - (m - n)) // 2
                    all_of = rnd.integers(0, 1 << 64, 200 * (n + m), dtype=np.uint64)
                    if some % 2:  # shingles that fall into one hashed segment
                        all_of = all_of[(all_of * np.uint64(0xFF51AFD7ED558CCD) >> np.uint64(33)) % 27 == 0]
                    all_of = all_of[: n + m - shared]
                    a, b = np.sort(all_of[:n]), np.sort(all_of[n - shared :])
                    assert len(b) == m and len(np.intersect1d(jaccard_join.keys_of(a, common, bands, bound), jaccard_join.keys_of(b, common, bands, bound))), (n, m)


def test_crowded_group_of_near_copies(spark, monkeypatch):
    rnd = random.Random(31)
    base = [f"w{i}" for i in range(150)]
    rows = []
    for i in range(140):
        w = list(base)
        for _ in range(rnd.choice((1, 3, 4, 4))):
            w[rnd.randrange(len(w))] = f"x{rnd.randrange(10**6)}"
        rows.append((1000 - i, " ".join(w)))
    rows += [(i, " ".join(base[:70]) + " " + " ".join(f"y{rnd.randrange(10**6)}" for _ in range(60))) for i in range(2000, 2030)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    sets = [(i, _set(t)) for i, t in rows]
    links = [(a, b) for x, (a, s) in enumerate(sets) for b, t in sets[x + 1 :] if 100 * len(s & t) >= 75 * len(s | t)]
    want = _roots([i for i, _ in sets], links)
    assert 1 < len(set(want.values())) < len(rows)
    made = []
    full = jaccard_join.compared_in_full
    monkeypatch.setattr(jaccard_join, "compared_in_full", lambda *a: made.append(full(*a)) or made[-1])
    for block in (2048, 30):
        monkeypatch.setattr(jaccard_join, "BLOCK", block)
        assert {r["doc_id"]: r["component_id"] for r in jaccard_join.link_documents(df).collect()} == want
    assert made and 0 < made[0].count() < len(rows)


def test_spanning_links():
    rnd = np.random.default_rng(8)
    base = rnd.integers(0, 1 << 64, 60, dtype=np.uint64)
    sets = []
    for k in range(80):
        keep = rnd.random(60) < rnd.choice([0.8, 0.95])
        sets.append((k, k % 50, np.unique(np.concatenate((base[keep], rnd.integers(0, 1 << 64, int(rnd.integers(0, 12)), dtype=np.uint64))))))
    bound = jaccard_join.Bound()
    near = [(a, b) for a, _, s in sets for b, _, t in sets if a < b and 100 * len(np.intersect1d(s, t)) >= 75 * len(np.union1d(s, t))]
    given = [(k, k % 50) for k in range(80)]
    every = jaccard_join.spanning_links(sets, None, bound)
    assert {tuple(sorted(x)) for x in every} <= set(near) and len(every) < 80
    assert _roots(range(80), given + every) == _roots(range(80), given + near)
    cross = jaccard_join.spanning_links(sets[:30], sets[30:], bound)
    assert _roots(range(80), given + cross) == _roots(range(80), given + [x for x in near if x[0] < 30 <= x[1]])


def test_repeated_ids_are_judged_by_their_texts(spark, monkeypatch):
    one, two = (" ".join(f"{c}{i}" for i in range(40)) for c in "ab")
    rows = [(5, one), (5, two), (5, two + " more"), (3, one), (8, two), (9, None), (9, ""), (None, one), (None, one)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    kept = [tuple(r) for r in jaccard_join.keep_one_of_each(df).collect()]
    third = [r for r in kept if r[0] == 5]
    assert len(third) == 1 and third[0] in rows[1:3]
    assert sorted(kept, key=str) == sorted([(3, one), *third, (9, None), (9, ""), (None, one), (None, one)], key=str)
    got = sorted((r["doc_id"], r["component_id"]) for r in jaccard_join.link_documents(df).collect() if r["doc_id"])
    assert got == [(3, 3), (5, 3), (5, 5), (5, 5), (8, 5), (9, 9), (9, 9)]
    # two sets with one number are told apart by the second
    found = shingles.shingle_sets([one, two])
    first, second = jaccard_join.nodes_of(found)
    assert jaccard_join.nodes_of(found, frozenset([int(first[0])]))[0].tolist() == [int(second[0]), int(first[1])]


def test_long_texts_are_hashed_in_pieces(monkeypatch):
    text = " ".join(f"w{i * i % 97}x{i}" for i in range(3000))
    whole = shingles.shingle_sets([text])[0]
    monkeypatch.setattr(shingles, "SLICE_BYTES", 500)
    assert shingles.shingle_sets(["a b", text, "c"])[1].tolist() == whole.tolist()


def test_toxicity_on_planted_words(spark):
    rnd = random.Random(10)
    plain = ["".join(rnd.choice("aeioulnrst") for _ in range(rnd.randrange(2, 7))) for _ in range(300)]
    stems = ["grobulx", "snarkvip"]
    rows = []
    for i in range(900):
        w = [rnd.choice(plain) for _ in range(40)]
        toxic = i % 6 == 0
        if toxic:
            for _ in range(4):
                w.insert(rnd.randrange(len(w)), rnd.choice(stems) + rnd.choice(["", "en", "ing", "er"]))
        rows.append((i, " ".join(w), int(toxic), int(i % 4 == 0)))
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int, part int")
    model = toxicity.fit(df)
    extra = spark.createDataFrame([(5000, "you " + " ".join(plain[:20]) + " GROBULXish, grobulx! snarkvip", 1), (5001, " ".join(plain[:30]), 0), (None, None, 0), (5002, "", 0)], "doc_id long, text string, score int")
    got = {r["doc_id"]: r for r in toxicity.score_documents(extra, model).collect()}
    assert got[5000]["predicted"] == 1 and got[5001]["predicted"] == 0 and got[None]["predicted"] == got[5002]["predicted"] == 0
    assert all(0 <= r["score"] <= 1 for r in got.values())
    kept = toxicity.drop_toxic(extra, model)
    assert kept.columns == extra.columns and kept.count() == 3
    assert toxicity.score_documents(extra.limit(0), model).count() == 0
    assert toxicity.fit(df.limit(0))["calibration"] == toxicity.DEFAULT_CALIBRATION


def _spelled_ratio(word, grams, totals, columns):
    """The documented model of one word from plain dictionaries of exact counts."""
    order, top = toxicity.ORDER, toxicity.SHARED_ORDER
    n = [sum(totals[c + p] for p in columns) for c in ("n0", "n1")]
    scale = [min(1.0, n[1] / n[0]), min(1.0, n[0] / n[1])]
    c = {g: [scale[k] * sum(v[f"n{k}{p}"] for p in columns) for k in (0, 1)] for g, v in grams.items()}
    shared, longer = {}, set(grams)
    for k in range(top, 0, -1):
        shared[k] = Counter(x[-k:] for x in longer)
        longer = set(shared[k])
    out = 0.0
    for g in toxicity.grams_of([word])[1]:
        p = 1 / len(shared[1])
        for k in range(1, top + 1):
            same = [v for x, v in shared[k].items() if x[:-1] == g[-k:][:-1]]
            if same:
                p = (max(shared[k][g[-k:]] - toxicity.SHARED_DISCOUNT, 0) + toxicity.SHARED_DISCOUNT * len(same) * p) / sum(same)
        logs = []
        for k in (0, 1):
            row = [v[k] for x, v in c.items() if x[: order - 1] == g[: order - 1]]
            kept = sum(max(v - toxicity.DISCOUNT, 0) for v in row)
            own = max(c.get(g, [0, 0])[k] - toxicity.DISCOUNT, 0) / sum(row) + (1 - kept / sum(row)) * p if kept > 0 else p
            logs.append(math.log(max(own, 1e-30)))
        out += logs[1] - logs[0]
    return out


def test_toxicity_counts_are_exact(spark, monkeypatch):
    rnd = random.Random(12)
    plain = ["".join(rnd.choice("aeioulnrstäж") for _ in range(rnd.randrange(2, 9))) for _ in range(120)]
    rows = [(i, " ".join([rnd.choice(plain) for _ in range(12)] + ["grobulx", "snarkvip"] * (i % 3 == 0)), int(i % 3 == 0), int(i % 4 == 0)) for i in range(240)]
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int, part int")
    model = toxicity.fit(df)
    counted = toxicity.count_grams(toxicity.count_words(df, "text", "toxic", "part")).collect()
    grams = {r["gram"]: r.asDict() for r in counted}
    totals = {c: sum(r[c] for r in counted) for c in ("n0a", "n1a", "n0b", "n1b")}
    words = [*plain[:25], "grobulx", "grobulxen", "snarkvi", "zzz", "x" * 150]
    asked = spark.createDataFrame([(w,) for w in sorted(set(words))], "word string")
    for i, columns in ((0, "a"), (2, "ab")):
        got = {r["word"]: r["ratio"] for r in toxicity.word_ratios(asked, {**model, "columns": i}).collect()}
        for w in words:
            assert abs(got.get(w, 0.0) - _spelled_ratio(w, grams, totals, columns)) < 1e-6, w
        above = {r["word"]: r["ratio"] for r in toxicity.word_ratios(asked, {**model, "columns": i}, toxicity.MARGIN).where(f"ratio > {toxicity.MARGIN}").collect()}
        assert above == {w: x for w, x in got.items() if x > toxicity.MARGIN} and above
    # the same scores whether telling words are broadcast or joined
    texts = spark.createDataFrame([(i, t) for i, t, *_ in rows] + [(None, None), (7, ""), (7, "grobulx grobulx " + rows[0][1])], "doc_id long, text string")
    want = sorted(map(str, toxicity.score_documents(texts, model).collect()))
    kept = sorted(map(str, toxicity.drop_toxic(texts, model).collect()))
    assert any("predicted=1" in r for r in want) and 0 < len(kept) < len(want)
    for most in (0, 2):
        monkeypatch.setattr(toxicity, "HOT_WORDS", most)
        assert sorted(map(str, toxicity.score_documents(texts, model).collect())) == want
        assert sorted(map(str, toxicity.drop_toxic(texts, model).collect())) == kept


def test_toxicity_sends_a_text_to_python_once(spark):
    """Workers get each text once and give none back; words pass through one Python step on their way to the ratios."""
    rows = [(i, " ".join(f"plain{(i * 7 + k) % 50}" for k in range(400)) + (" zorgblat" * 20 if i % 6 == 0 else ""), int(i % 6 == 0), int(i % 4 == 0)) for i in range(240)]
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int, part int")
    model = toxicity.fit(df)
    kept = toxicity.drop_toxic(df, model)
    assert 0 < kept.count() < 240 and kept.columns == df.columns
    kept.collect()
    todo, moved = [kept._jdf.queryExecution().executedPlan()], {"pythonDataSent": 0, "pythonDataReceived": 0}
    while todo:
        node = todo.pop()
        todo += [node.children().apply(i) for i in range(node.children().size())]
        for name in moved:
            if node.metrics().contains(name):
                moved[name] += node.metrics().apply(name).value()
    size = sum(len(r[1]) for r in rows)
    assert size < moved["pythonDataSent"] < 1.3 * size and 0 < moved["pythonDataReceived"] < 0.3 * size
    ratios = toxicity.word_ratios(spark.createDataFrame([(w,) for w in sorted({w for r in rows for w in r[1].split()})], "word string"), model, toxicity.MARGIN)
    assert ratios._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    assert "zorgblat" in {r["word"] for r in ratios.collect()}


def test_pipeline(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    n = docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = corpus_pipeline.staged(stage(spark, docs, SMALL), name)
        assert after.columns == docs.columns and 0 < after.count() <= n
        docs, n = after, after.count()
    packed = corpus_pipeline.packing(spark, docs, SMALL)
    assert packed.select("doc_id").distinct().count() == n
