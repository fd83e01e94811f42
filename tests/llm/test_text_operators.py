"""BPE, packing, chat, archives, shards, pages."""

from __future__ import annotations

import hashlib
import itertools
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tapeloom.llm import bpe, chat, html_mincut, packing, sharding, warc

ODD = ["a", "b", " ", "  ", "\n", "\t", "é", "漢", "'s", "'ll", "1", "²", "<|endoftext|>", "!", "_", "\x1c", " ", "\r\n", "the", " the", "\xa0"]


@pytest.fixture(scope="module")
def reference():
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def test_bpe_equals_the_library(reference):
    rnd = random.Random(3)
    texts = ["".join(rnd.choice(ODD) for _ in range(rnd.randrange(30))) for _ in range(2000)] + ["a" * 900, "x" * 70 + " " * 90, ""]
    own = bpe.ByteBpe()
    for text, got in zip(texts, own.encode(texts), strict=True):
        want = reference.encode(text, add_special_tokens=False).ids
        assert got.tolist() == want
        assert own.decode_bytes(got).decode("utf-8", "replace") == reference.decode(want, skip_special_tokens=False)


def test_bpe_rows(spark):
    df = spark.createDataFrame([(1, "Hello world", "x"), (None, None, "y"), (1, "", "z")], "doc_id long, text string, ids string")
    rows = bpe.encode_documents(df).collect()
    assert sorted((r["doc_id"] or 0, len(r["ids"])) for r in rows) == [(0, 0), (1, 0), (1, 2)]
    back = bpe.decode_documents(bpe.encode_documents(df)).collect()
    assert sorted(r["text"] for r in back) == ["", "", "Hello world"]
    empty = [r for r in bpe.round_trip_digests(df).collect() if r["n_tokens"] == 0]
    assert {r["ids_sha256"] for r in empty} == {hashlib.sha256(b"").hexdigest()}
    assert bpe.round_trip_digests(df.limit(0)).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 9), min_size=1, max_size=9), st.randoms(use_true_random=False))
def test_best_cuts_is_optimal(gaps, rnd):
    at = np.concatenate(([0], np.cumsum(gaps)))
    price = np.array([0] + [rnd.randrange(4) for _ in gaps])
    window = 10
    cuts = packing.best_cuts(at, price, window, final=True)
    best = None
    inner = range(1, len(at) - 1)
    for k in range(len(at)):
        for some in itertools.combinations(inner, k):
            ends = [*some, len(at) - 1]
            spans = np.diff(at[[0, *ends]])
            if (spans <= window).all():
                cost = int((window - spans).sum() + price[ends].sum())
                best = cost if best is None else min(best, cost)
    spans = np.diff(at[[0, *cuts]])
    assert (spans <= window).all() and int((window - spans).sum() + price[cuts].sum()) == best


def test_packing_covers_every_id_once(spark, reference):
    texts = ["word " * n + "end." for n in (0, 3, 900, 2500, 40)] + [None, "", "same text. " * 50, "same text. " * 50, "z" * 5000]
    df = spark.createDataFrame([(i if i < 9 else 8, t, 5) for i, t in enumerate(texts)], "doc_id long, text string, length int").coalesce(2)
    rows = packing.pack_documents(df, with_ids=True).collect()
    sequences = {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append(r)
        assert zlib.crc32(np.array(r["ids"], dtype="<u4").tobytes()) == r["ids_crc32"] and len(r["ids"]) == r["length"]
    for pieces in sequences.values():
        pieces.sort(key=lambda r: r["offset"])
        assert [p["offset"] for p in pieces] == [0, *np.cumsum([p["length"] for p in pieces])[:-1].tolist()]
        assert sum(p["length"] for p in pieces) <= 1024
    for i, t in enumerate(texts[:8]):
        own = sorted((r for r in rows if r["doc_id"] == i), key=lambda r: r["start"])
        assert sum((r["ids"] for r in own), []) == reference.encode(t or "", add_special_tokens=False).ids + [0]
    assert packing.pack_documents(df.limit(0)).count() == 0


CONTROL = ["<|im_start|>", "<|im_end|>\n", "</s>", "[INST]", "[/INST]", "\\", "<", "|", "<<SYS>>", "a", "\n", "é"]


def test_chat_round_trip(spark):
    rnd = random.Random(5)
    rows = []
    for conv in range(40):
        for turn in range(rnd.randrange(1, 7)):
            rows.append((conv, turn, rnd.choice(["user", "assistant", "system", "od\nd <|im_end|>", None]), rnd.choice([None, "".join(rnd.choice(CONTROL) for _ in range(9))]), 1))
    rows += [(None, 0, "assistant", "x", 1), (7, 0, "user", "twice", 1)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, example int")
    examples = chat.format_examples(df)
    for r in examples.collect():
        body = r["formatted"][r["loss_start"] : r["loss_start"] + r["loss_length"]]
        assert "<|" not in body and "[INST]" not in body and "</s>" not in body
    back = {r["conv_id"]: r for r in chat.read_examples(examples).collect()}
    for conv in {r[0] for r in rows}:
        mine = sorted((r[1], r[2] or "", r[3] or "") for r in rows if r[0] == conv)
        assert [(t["role"], t["text"]) for t in back[conv]["turns"]] == [(b, c) for _, b, c in mine]
        assert "".join(back[conv]["trained"]) == "".join(c for _, b, c in mine if b == "assistant")
    assert chat.format_examples(df.limit(0)).count() == 0


def test_chat_examples_grow_by_prefix(spark):
    df = spark.createDataFrame([(1, 0, "user", "q"), (1, 1, "assistant", "a"), (1, 2, "user", "r"), (1, 3, "assistant", "b")], "conv_id long, turn long, role string, text string")
    first, second = chat.format_examples(df).orderBy("example").collect()
    assert second["formatted"].startswith(first["formatted"]) and not first["final"] and second["final"]


def test_archives(spark, tmp_path):
    big = "<p>" + "long page " * 200
    rows = [(1, "http://a/ b", big, 0), (2, None, big, 0), (3, "http://c", "small", 0), (4, "http://d", "small", 0), (5, "u", None, 0), (None, "n", big, 0)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, digest int")
    path = str(tmp_path / "w")
    warc.write_archives(warc.mark_revisits(df).repartition(2), path)
    got = {r["record_id"]: r for r in warc.read_archives(spark, path).collect()}
    assert got["<urn:page:2>"]["record_type"] == "response" and got["<urn:page:2>"]["payload"].decode() == big
    for k in ("1", "null"):
        assert got[f"<urn:page:{k}>"]["refers_to"] == "<urn:page:2>" and got[f"<urn:page:{k}>"]["payload_bytes"] == len(big)
    assert got["<urn:page:3>"]["record_type"] == got["<urn:page:4>"]["record_type"] == "response"
    assert got["<urn:page:5>"]["payload"] == b"" and got["<urn:page:1>"]["url"] == "http://a/%20b"
    one = warc.record(1, "u", b"abc", hashlib.sha1(b"abc").hexdigest(), 1)
    assert warc.parse(one)["payload"] == b"abc"
    for broken in (one[:-1], one.replace(b"Content-Length: 3", b"Content-Length: 4"), one.replace(b"abc", b"abd"), b"x"):
        with pytest.raises(ValueError):
            warc.parse(broken)
    with pytest.raises(ValueError):
        list(warc.records(b"nothing"))


def _jump(key: int, n: int) -> int:
    b, j, key = -1, 0, key % 2**64
    while j < n:
        b = j
        key = (key * sharding.LCG_MULTIPLIER + 1) % 2**64
        j = int((b + 1) * (2.0**31 / ((key >> 33) + 1)))
    return b


def test_shards(spark):
    rows = [(i, "é" * (i % 5), "x") for i in range(3000)] + [(None, None, "x"), (-5, "neg", "x"), (7, "again", "x"), (2**62, "", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, shard string")
    got = sharding.assign_shards(df).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r["shard"] == _jump(r["doc_id"] or 0, 24) and r["grown_shard"] == _jump(r["doc_id"] or 0, 25)
        assert r["grown_shard"] in (r["shard"], 24)
    for s in range(24):
        assert sorted(r["slot"] for r in got if r["shard"] == s) == list(range(sum(r["shard"] == s for r in got)))
    assert {(r["size"], r["text_crc32"]) for r in got if r["doc_id"] is None} == {(8, 0)}
    assert sharding.assign_shards(df.limit(0)).count() == 0


def test_slots_of_a_hot_key_are_gapless_and_spread(spark):
    rows = [(None if i % 2 else 7, f"text {i}", "x") for i in range(600)] + [(None, None, "x")] * 5
    df = spark.createDataFrame(rows, "doc_id long, text string, slot string").repartition(4)
    got = sharding.assign_shards(df).collect()
    for shard in {r["shard"] for r in got}:
        assert sorted(r["slot"] for r in got if r["shard"] == shard) == list(range(sum(r["shard"] == shard for r in got)))
    groups = df.select(sharding._bucket(F.col("doc_id"), F.crc32(F.coalesce("text", F.lit("")).cast("binary")), 256).alias("b")).groupBy("b").count().collect()
    assert len(groups) > 150 and max(r["count"] for r in groups) < 30


@settings(max_examples=80, deadline=None)
@given(st.integers(1, 6), st.randoms(use_true_random=False))
def test_min_cut_is_least(n, rnd):
    a, b = [rnd.randrange(8) for _ in range(n)], [rnd.randrange(8) for _ in range(n)]
    edges = [(i, j, rnd.randrange(1, 5)) for i in range(n) for j in range(i) if rnd.random() < 0.5]

    def cost(side):
        return sum(b[i] if side[i] else a[i] for i in range(n)) + sum(w for i, j, w in edges if side[i] != side[j])

    got = html_mincut.min_cut([float(x) for x in a], [float(x) for x in b], [(i, j, float(w)) for i, j, w in edges])
    assert cost(got) == min(cost(s) for s in itertools.product([False, True], repeat=n))


PAGE = """<!DOCTYPE html><html><head><title>t</title><script>var x="<p>no</p>"</script></head><body><header><nav><a href=x>Home</a></nav></header>
<div id="cookie-banner">We use cookies to improve everything here. <button>Accept</button></div>
<article><h1>A   title &amp; more</h1><p>First paragraph with
 many words, &lt;tags&gt; and a <a href=y>link</a>.<br>next<p>Second one&nbsp;here, left open<ul><li>point</li></ul><aside>Related stories you may like to read</aside></article>
<section class="comments"><p>I do not agree with this long article at all, says a reader.</p></section><form><p>Subscribe to our newsletter</p></form><footer>&copy; 2020</footer></body></html>"""


def test_pages(spark):
    want = "A title & more\n\nFirst paragraph with many words, <tags> and a link. next\n\nSecond one here, left open\n\npoint"
    rows = [(1, "u", PAGE, "x"), (2, None, None, "x"), (None, "v", "", "x"), (3, "w", "<p>only", "x"), (3, "w", "<<<", "x"), (4, "w", "<nav><a href=x>a</a></nav>", "x")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = html_mincut.extract_pages(df).collect()
    assert len(got) == 6 and next(r for r in got if r["page_id"] == 1)["text"] == want
    assert all(r["n_chars"] == len(r["text"]) for r in got)
    assert [r["text"] for r in got if r["page_id"] in (2, None, 4)] == ["", "", ""]
    assert html_mincut.extract_pages(df.limit(0)).count() == 0


ARTICLE = "The river rises every spring and the whole valley waits for it, as it has done for as long as anyone here can remember. " * 3


@pytest.mark.parametrize("page", [
    '<body class="single-post no-sidebar"><article><p>{}</p></article></body>',
    '<html class="modal"><body class="search"><main class="widget"><article><p>{}</p></article></main></body></html>',
    '<body><div class="has-sidebar share-enabled with-comments"><article><p>{}</p></article></div></body>',
    '<body><div class="social"><article><p>{}</p></article></div></body>',
    '<body><article><div style="overflow: hidden"><p>{}</p></div></article></body>',
    "<body><article><p title='the hidden valley' data-x=hidden>{}</p></article></body>",
])
def test_articles_in_common_markup_are_kept(page):
    assert html_mincut.extract(page.format(ARTICLE)) == ARTICLE.strip()


def test_real_boilerplate_still_goes():
    for part in ('<div class="comments">', "<p hidden>", '<p class=x aria-hidden="true">', '<div class="related-posts">'):
        page = f"<body><article><p>{ARTICLE}</p>{part}{ARTICLE.upper()}</article></body>"
        assert html_mincut.extract(page) == ARTICLE.strip()


def test_articles_survive_ordinary_markup():
    parts = [
        "The river rose in the night and the bridge was closed to all traffic before the morning, said the council, which had watched the water for days and feared the worst of it.",
        "Farmers on the lower fields moved their animals to the hill. Nobody was hurt, and the school opened its hall to families who could not return to their homes until the water fell.",
        "By the evening the rain had stopped. Engineers will look at the bridge on Monday, and the mayor thanked all who had carried sandbags through the dark streets for so many hours.",
    ]
    body, want = "".join(f"<p>{p}</p>" for p in parts), "\n\n".join(parts)
    for start, stop in (
        ('<body class="single-post no-sidebar"><article>', "</article>"), ('<body class="home has-sidebar"><div id="content">', "</div>"),
        ('<body><article data-title="the hidden cost of tea">', "</article>"), ('<body><div class="post post-with-comments">', "</div>"),
        ('<body><main class="content layout nav open">', "</main>"), ('<body><article class="tag tag-news">', "</article>"),
        ("<body><noscript><article>", "</article></noscript>"), ("<body><select><option>x<article>", "</article>"), ("<body><script>var a = 1;<article>", "</article>"),
    ):
        tag = start.index(">") + 1
        page = f'<html>{start[:tag]}<nav><a href="/">Home</a> <a href="/n">News</a></nav>{start[tag:]}{body}{stop}<footer>Copyright 2024 All rights reserved</footer></body></html>'
        assert html_mincut.extract(page) == want, start
    comment = '<div class="comments"><article class="comment-body"><p>I was there too and it was very wet, greetings to all of you.</p></article></div>'
    assert "very wet" not in html_mincut.extract(f"<body><article>{body}</article>{comment}</body>")


PARTS = (
    "The river rose in the night and the bridge was closed to all traffic before the morning, said the council, which had watched it.",
    "Farmers on the lower fields moved their animals to the hill. Nobody was hurt, and the school opened its hall to families in need.",
    "By the evening the rain had stopped. Engineers will look at the bridge on Monday, and the mayor thanked all who had carried sandbags.",
)


@pytest.mark.parametrize("page", [
    "{nav}<form><article>{body}</article></form>", "{nav}<form><main><article>{body}</article></main></form>", '{nav}<form><div class="content">{body}</div></form>',
    '{nav}<fieldset><div class="content">{body}</div></fieldset>', '{nav}<article class="related-coverage story">{body}</article>', '<div class="social-news-site">{nav}<div class="story">{body}</div></div>',
    '{nav}<div class="alert-story"><div class="story-body">{body}</div></div>', '{nav}<div class="promo-page"><div class="story">{body}</div></div>', '{nav}<div class="search-page"><div class="body">{body}</div></div>',
    '{nav}<div class="widget"><main>{body}</main></div>', "{nav}<noscript><main>{body}</main></noscript>", '<nav><a href="/">Home</a><main><article>{body}</article></main>', '{nav}<a href="/x">Home<article>{body}</article>',
    "{nav}<main><form><article>{body}</article></form></main>", '{nav}<article>{body}<p style="color:red; display:none">Hidden words of some length that nobody sees at all.</p></article>',
    '<form id="aspnetForm"><header><h1>Site</h1>{nav}</header><div id="content"><article>{body}</article><div class="sidebar"><p>Related things you may want to read as well.</p></div></div></form>',
    '{nav}<div id="x"><div>{body}</div></div><aside><article><h3>Teaser of another story</h3><p>Some words of it.</p></article></aside>',
    '{nav}<article>{body}</article><section class="comments"><div class="content">{body}{body}</div></section>', '{nav}<article>{body}</article><div id="comments"><article><p>I was there too and it was very wet, greetings to all.</p></article></div>',
    '{nav}<p><a href=x>one<a href=y>two</p><article>{body}</article>',
])
def test_whole_articles_wherever_they_lie(page):
    nav, body = '<nav><a href="/">Home</a> <a href="/n">News</a></nav>', "".join(f"<p>{p}</p>" for p in PARTS)
    page = f"<html><body>{page.format(nav=nav, body=body)}<footer>Copyright 2024 All rights reserved</footer></body></html>"
    assert html_mincut.extract(page) == "\n\n".join(PARTS)


def test_long_boilerplate_alone_is_no_article():
    words = " ".join(PARTS)
    for page in (f"<footer><p>{words}</p></footer>", f'<div class="comments"><p>{words}</p></div>', f'<aside class="sidebar"><div>{words}</div></aside>', f"<nav><p>{words}</p></nav>", f"<p hidden>{words}</p>"):
        assert html_mincut.extract(f"<body>{page}</body>") == ""


def test_broken_markup_takes_linear_time():
    import time

    for page in ("<b>" * 20000 + "</div>" * 5000 + "x", "<a><div>" + "<b>" * 20000 + "</a>" * 5000 + "x", "<select>" * 20000 + "x", "<div>" * 20000 + "<p>" * 2000 + "x", "<form><article>" * 10000 + "x", "<a><main>" * 10000 + "x"):
        began = time.process_time()
        html_mincut.extract(page)
        assert time.process_time() - began < 3
