"""Token planes, target resampling and subvector clusters against brute force, round trips and the tokenizers library."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter
from pathlib import Path

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tapeloom.llm import q_subvector_clusters, q_target_sampling, q_token_planes, subvector_clusters, target_sampling, token_planes
from tapeloom.llm.bpe import default_vocabulary
from tests.conftest import SMALL


def _library_ids(texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(default_vocabulary())
    t.no_truncation()
    t.no_padding()
    return [e.ids + [0] for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1), max_size=70), st.sampled_from(token_planes.KINDS), st.integers(0, 31))
def test_planes_round_trip(ids, kind, shift):
    block = np.array(ids, dtype=np.uint32) >> np.uint32(shift)
    planes = token_planes.to_planes(block, kind)
    assert token_planes.from_planes(planes, len(block), kind).tolist() == block.tolist()
    if len(block):
        assert len(planes) == (int(block.max()).bit_length() if kind == "bit" else -(-int(block.max()).bit_length() // 8))


def test_bit_planes_by_hand():
    block = np.array([1, 2, 3, 4], dtype=np.uint32)
    assert token_planes.to_planes(block, "bit") == [bytes([0b0101]), bytes([0b0110]), bytes([0b1000])]
    assert token_planes.to_planes(block + 256, "byte") == [bytes([1, 2, 3, 4]), bytes([1, 1, 1, 1])]


@pytest.mark.parametrize("kind", token_planes.KINDS)
def test_any_stretch_is_read_from_its_chunks(kind):
    import pyarrow as pa

    rnd = np.random.default_rng(1)
    file = token_planes.FileWriter(3, 17, kind, block_ids=10)
    docs = [rnd.integers(0, 50_000, n).astype(np.uint32) for n in (0, 1, 9, 10, 11, 35, 2)]
    for i, d in enumerate(docs):
        file.add(i, d)
    content = file.close(pa.int64()) + b"\n"
    back, flat = token_planes.FileReader(content), np.concatenate(docs)
    assert (back.part, back.base, back.n_ids, back.keys.to_pylist()) == (3, 17, len(flat), list(range(7)))
    read = []
    whole = back.chunk
    back.chunk = lambda i: read.append(i) or whole(i)
    for a in range(0, len(flat) + 1, 3):
        for b in range(a, len(flat) + 1, 4):
            read.clear()
            assert back.ids(a, b).tolist() == flat[a:b].tolist()
            assert read == (list(range(a // 10, (b - 1) // 10 + 1)) if a < b else [])
    for at in (len(token_planes.MAGIC) + 3, len(content) - 80, len(content) - 5):
        broken = bytearray(content)
        broken[at] ^= 1
        with pytest.raises(Exception):  # noqa: B017
            token_planes.FileReader(bytes(broken)).ids(0, len(flat))
    for cut in (content[:-1], content[:20], b""):
        with pytest.raises(ValueError):
            token_planes.FileReader(cut)


def _texts():
    rnd = random.Random(8)
    words = ["river", "Fluss", "año", "日本", "12", "x" * 90, "<|endoftext|>", "😀"]
    rows = [(i, " ".join(rnd.choice(words) for _ in range(rnd.randrange(0, 60)))) for i in range(150, 0, -1)]
    rows += [(None, "no id"), (None, "no id"), (7, "again"), (7, "again"), (7, None), (900, None), (901, ""), (902, "word and " * 30_000), (-5, "below zero")]
    return rows


@pytest.mark.parametrize(("kind", "file_ids"), [("byte", 700), ("bit", 1 << 24)])
def test_files_hold_all_ids_in_order(spark, tmp_path, kind, file_ids):
    rows = _texts()
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, start string, ids int").repartition(7)
    path = str(tmp_path / "ids")
    token_planes.write_ids(df, path, planes=kind, block_ids=256, file_ids=file_ids, partitions=5)
    got = sorted(token_planes.read_ids(spark, path).collect(), key=lambda r: r["start"])
    keys = [r["doc_id"] for r in got]
    assert keys == sorted(keys, key=lambda k: (k is not None, k or 0)) and len(got) == len(rows)
    at = 0
    want = Counter((k, tuple(ids)) for (k, _), ids in zip(rows, _library_ids([t for _, t in rows]), strict=True))
    for r in got:
        assert r["start"] == at and r["n_tokens"] == len(r["ids"])
        assert r["ids_crc32"] == zlib.crc32(np.array(r["ids"], dtype="<u4").tobytes())
        at += r["n_tokens"]
    assert Counter((r["doc_id"], tuple(r["ids"])) for r in got) == want
    parts = [p for p in Path(path).iterdir() if p.name.startswith("part-") and p.stat().st_size]
    assert len(parts) > 5 if file_ids == 700 else len(parts) <= 5
    plain = token_planes.read_ids(spark, path, with_ids=False)
    assert plain.columns == ["doc_id", "start", "n_tokens", "ids_crc32"] and plain.count() == len(rows)


def test_no_ids_and_hot_ids(spark, tmp_path):
    empty = spark.createDataFrame([], "doc_id long, text string")
    token_planes.write_ids(empty, str(tmp_path / "none"))
    assert token_planes.read_ids(spark, str(tmp_path / "none")).count() == 0
    hot = spark.createDataFrame([(1, f"text {i % 3}") for i in range(400)] + [(2, "b")], "doc_id long, text string")
    token_planes.write_ids(hot, str(tmp_path / "hot"), partitions=6)
    got = token_planes.read_ids(spark, str(tmp_path / "hot")).collect()
    assert len(got) == 401 and max(got, key=lambda r: r["start"])["doc_id"] == 2
    files = [p for p in (tmp_path / "hot").iterdir() if p.name.startswith("part-") and p.stat().st_size]
    assert len(files) >= 4  # one id with nearly all rows still fills several ranges
    named = spark.createDataFrame([("b", "x"), ("a", "y")], "name string, body string")
    token_planes.write_ids(named, str(tmp_path / "named"), id_col="name", text_col="body")
    assert [(r["name"], r["start"]) for r in token_planes.read_ids(spark, str(tmp_path / "named"), "name", "string").orderBy("start").collect()] == [("a", 0), ("b", 2)]


def test_damaged_files_are_told(spark, tmp_path):
    token_planes.write_ids(spark.createDataFrame([(1, "some words here")], "doc_id long, text string"), str(tmp_path / "ids"))
    file = next(p for p in (tmp_path / "ids").iterdir() if p.name.startswith("part-"))
    data = bytearray(file.read_bytes())
    data[-20] ^= 255
    file.write_bytes(bytes(data))
    (tmp_path / "ids" / f".{file.name}.crc").unlink(missing_ok=True)
    with pytest.raises(Exception, match="damaged|right|magic|indexes"):
        token_planes.read_ids(spark, str(tmp_path / "ids")).collect()


def test_op11_equals_the_library(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    got = {r["doc_id"]: r for r in q_token_planes.op11_token_planes(spark, SMALL).collect()}
    at = 0
    for d, ids in zip(docs, _library_ids([d["text"] for d in docs]), strict=True):
        r = got[d["doc_id"]]
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (at, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes()))
        at += len(ids)
    assert len(got) == len(docs)


def test_ranks_give_the_ids_of_the_library(tmp_path):
    from tapeloom.llm import rank_bpe

    rnd = random.Random(1)
    pieces = ["a", "the ", "  ", "\n", "é", "日本", "😀", "'s", "'ll", " 12", "<|endoftext|>", "<|endof", "\u00a0", "\r\n", "x" * 70, "...", "A", "\u0301", "\x00", "\x85", "٣"]
    texts = ["".join(rnd.choice(pieces) for _ in range(rnd.randrange(40))) for _ in range(400)] + ["x" * 100_000, "日本" * 20_000, " " * 30_000, ""]
    coder = rank_bpe.loaded_ranks()
    assert isinstance(coder, rank_bpe.RankBpe) and [x.tolist() + [0] for x in coder.encode(texts)] == _library_ids(texts)
    import json

    spec = json.loads(Path(default_vocabulary()).read_text())
    spec["model"]["merges"] = spec["model"]["merges"][::-1]  # ids no longer follow ranks
    (tmp_path / "other.json").write_text(json.dumps(spec))
    assert not isinstance(rank_bpe.loaded_ranks(str(tmp_path / "other.json")), rank_bpe.RankBpe)


WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def _features(text):
    w = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return len(w), [" ".join(w[i : i + n]) for n in (1, 2, 3) for i in range(len(w) - n + 1)]


def _drawn(docs, target, percent=5, least=20, seed=42, buckets=10_000):
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    s, t = Counter(), Counter()
    feats = [_features(x) for _, x in docs]
    for _, fs in feats:
        s.update(map(bucket, fs))
    for x in target:
        t.update(map(bucket, _features(x)[1]))
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (all_s + buckets) / ((s[b] + 1) * (all_t + buckets)))) for b in set(s) | set(t)}
    rows = []
    for (k, _), (n, fs) in zip(docs, feats, strict=True):
        weight = sum(gain[bucket(f)] for f in fs)
        h = int(hashlib.sha256(f"{seed}:{'' if k is None else k}".encode()).hexdigest()[:8], 16)
        rows.append([k, n, len(fs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))])
    able = sorted((r for r in rows if r[1] >= least), key=lambda r: (-r[4], r[0] is not None, r[0] or 0))
    for i, r in enumerate(able[: percent * len(able) // 100]):
        r.append(i + 1)
    return [tuple([*r, None][:6]) for r in rows]


def test_joined_crcs():
    rnd = random.Random(3)
    parts = [bytes(rnd.randrange(256) for _ in range(n)) for n in (0, 1, 2, 5, 62, 63, 64, 65, 200, 70_000)]
    for a in parts:
        for b in parts:
            got = target_sampling.joined_crc(np.array([zlib.crc32(a)], dtype=np.uint32), np.array([zlib.crc32(b)], dtype=np.uint32), np.array([len(b)]))
            assert got.tolist() == [zlib.crc32(a + b)]


def _sources():
    rnd = random.Random(5)
    words = ["River", "fluss", "Año", "日本", "12", "é", "x" * 80, "tea", "Bridge-work", "o'clock", "ÀB", "K"]
    docs = [(i, rnd.choice(["", " ", "- "]) + rnd.choice([" ", ", ", "\n"]).join(rnd.choice(words) for _ in range(rnd.randrange(0, 70)))) for i in range(260)]
    docs += [(300, None), (301, ""), (302, "..."), (None, "tea " * 40), (None, "tea " * 40), (303, "tea " * 40), (303, "tea " * 40)]
    return docs, [" ".join(rnd.choice(words[:6]) for _ in range(30)) for _ in range(12)] + [None, ""]


def test_draw_equals_brute_force(spark):
    docs, target = _sources()
    df = spark.createDataFrame([(*d, 1, "x") for d in docs], "doc_id long, text string, score int, rank string").repartition(6)
    goal = spark.createDataFrame([(t,) for t in target], "text string")
    for percent in (5, 60):
        got = target_sampling.resample(df, goal, percent)
        assert sorted(map(tuple, got.select("doc_id", "n_words", "n_features", "weight", "score", "rank").collect()), key=str) == sorted(_drawn(docs, target, percent), key=str)
    none = target_sampling.resample(df.limit(0), goal)
    assert none.count() == 0 and none.columns == got.columns
    plain = target_sampling.resample(df, goal.limit(0)).select("doc_id", "n_words", "n_features", "weight", "score", "rank")
    assert sorted(map(tuple, plain.collect()), key=str) == sorted(_drawn(docs, []), key=str)


def test_long_texts_are_read_in_pieces(spark, monkeypatch):
    rnd = random.Random(6)
    text = "".join(rnd.choice([" ", "a", "B", "é", "0", "--", "\n", "zz", "日"]) for _ in range(4000))
    for size in (1, 2, 3, 17, 500):
        monkeypatch.setattr(target_sampling, "PIECE_BYTES", size)
        for one in (text, "word", "", "a b", " a  b  c "):
            total, many = np.zeros(10_000, dtype=np.int64), 0
            for piece, skip in target_sampling._pieces(one.encode(), 3):
                runs = target_sampling.Runs(np.frombuffer(piece, dtype=np.uint8), np.array([len(piece)]), np.array([skip]), 10_000, 3)
                total += runs.counts(10_000)
                many += int(runs.n_words[0])
            n, fs = _features(one)
            assert many == n
            want = Counter(zlib.crc32(f.encode()) % 10_000 for f in fs)
            assert {i: int(x) for i, x in enumerate(total) if x} == dict(want)


@pytest.mark.parametrize("most", [0, 1, 7, 150, 400, 1000])
def test_ranks_with_ties_are_exact(spark, monkeypatch, most):
    monkeypatch.setattr(target_sampling, "SAMPLES", 60)
    monkeypatch.setattr(target_sampling, "SEGMENTS", 9)
    rnd = random.Random(most)
    rows = [(rnd.randrange(50) if rnd.random() < 0.9 else None, None if i % 11 == 0 else rnd.choice([-(2**40), -1, 0, 5, 5, 5, 2**40])) for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, score long").repartition(5)
    got = target_sampling.draw(df, most).collect()
    able = sorted(((k, s) for k, s in rows if s is not None), key=lambda r: (-r[1], r[0] is not None, r[0] or 0))
    drawn = sorted((r for r in got if r["rank"] is not None), key=lambda r: r["rank"])
    assert [r["rank"] for r in drawn] == list(range(1, min(most, len(able)) + 1))
    assert [(r["doc_id"], r["score"]) for r in drawn] == able[:most]
    assert Counter((r["doc_id"], r["score"]) for r in got) == Counter(rows)


def _clustered(rows, k=8, rounds=10, dims=64):
    kept = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    if not kept:
        return {}
    named = sorted(kept, key=lambda r: (hashlib.sha256(f"3:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    centre = [v for _, v in named[:k]]
    assign = lambda: [min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), n) for n, c in enumerate(centre)) for _, v in kept]
    for _ in range(rounds):
        found = assign()
        for c in range(len(centre)):
            own = [v for (_, v), (_, n) in zip(kept, found, strict=True) if n == c]
            if own:
                centre[c] = [sum(col) // len(own) for col in zip(*own, strict=True)]
    found = assign()
    inertia = Counter()
    for d, c in found:
        inertia[c] += d
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centre]
    return Counter((i, c, d, inertia[c], sum(inertia.values()), names[c]) for (i, _), (d, c) in zip(kept, found, strict=True))


COLUMNS = ("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


@pytest.mark.parametrize(("block", "chunk"), [(1, 8192), (2, 16), (5, 7), (64, 100)])
def test_clusters_equal_brute_force(spark, block, chunk):
    rng = np.random.default_rng(7)
    base = rng.standard_normal((12, 64)) * 0.3
    rows = [(i, (base[i % 12] + 0.05 * rng.standard_normal(64)).round(3).tolist()) for i in range(140)]
    rows += [(i, rows[0][1]) for i in range(200, 260)] + [(5, rows[5][1]), (5, rows[6][1]), (None, rows[7][1]), (300, [-0.0005] * 64)]
    rows += [(400, None), (401, []), (402, [1.0] * 63), (403, [1.0] * 65), (404, [None] + [1.0] * 63), (405, [float("nan")] * 64), (406, [float("inf")] + [0.0] * 63)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<double>, cluster int").repartition(4)
    got = subvector_clusters.cluster_vectors(df, block=block, chunk=chunk)
    assert Counter(map(tuple, got.select(*COLUMNS).collect())) == _clustered(rows)
    for r in got.select("centroid", "centroid_sha256").distinct().collect():
        assert hashlib.sha256(",".join(map(str, r["centroid"])).encode()).hexdigest() == r["centroid_sha256"]


def test_few_or_no_vectors(spark):
    one = [0.25] * 64
    rows = [(1, one), (2, one), (3, [-0.3] * 64)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    want = [(i, [float(np.float32(x)) for x in v]) for i, v in rows]
    assert Counter(map(tuple, subvector_clusters.cluster_vectors(df).select(*COLUMNS).collect())) == _clustered(want)
    none = subvector_clusters.cluster_vectors(df.where("vec_id = 9"))
    assert none.count() == 0 and set(COLUMNS) <= set(none.columns)
    far = spark.createDataFrame([(1, [1e30] * 64), (2, one)], "vec_id long, embedding array<double>")
    assert [r["vec_id"] for r in subvector_clusters.cluster_vectors(far).collect()] == [2]


@pytest.mark.parametrize(("query", "sql"), [
    (q_target_sampling.op12_target_sampling, q_target_sampling.OP12_SQL), (q_subvector_clusters.op13_subvector_clusters, q_subvector_clusters.OP13_SQL),
])
def test_queries_equal_their_sql(spark, query, sql):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "embeddings"):
        con.execute(f"create view {t} as select * from '{SMALL}/{t}.parquet'")
    want = con.execute(sql)
    names = [c[0] for c in want.description]
    assert Counter(map(tuple, query(spark, SMALL).select(*names).collect())) == Counter(want.fetchall())
