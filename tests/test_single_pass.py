"""Payloads are made, parsed and cleaned once, however many results read them."""

from __future__ import annotations

from pyspark.sql import functions as F

from tapeloom.functions import macro
from tapeloom.plans import catalyst_plans
from tapeloom.sources import catalysts, payloads
from tests.conftest import SMALL


def _plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_views_do_not_parse_again(spark):
    plan = _plan(catalyst_plans.catalyst_views(spark, SMALL))
    assert "from_xml" not in plan and "from_json" not in plan and "collect_list" not in plan


def test_payloads_are_parsed_once(spark):
    df = spark.createDataFrame([("k", "alpaca_news", "<l><auction><type>a</type><auction_date>2024-01-05</auction_date></auction><auction/></l>", '{"news":[{"id":"1","headline":" A  b "},{"headline":" "}]}'),
                                ("n", "alpaca_news", None, None), ("e", "alpaca_news", "<l/>", '{"news":[]}'), ("c", "alpaca_news", "<l><auction>", '{"news":[{"id"'), ("u", "else", "<l/>", "{}")], "k string, s string, x string, j string")
    events, rejects = catalysts.auctions(df, "x", ["k"], F.lit("2024-01-01").cast("timestamp"))
    assert _plan(events).count("from_xml") == 1 and _plan(rejects).count("from_xml") == 1
    assert [(r["k"], r["position"], r["source_event_key"]) for r in events.collect()] == [("k", 0, "a:2024-01-05")] and sorted(r["k"] for r in rejects.collect()) == ["c", "e", "n", "u"]
    headlines, bad = catalysts.feed_headlines(df, "s", "j", ["k"])
    assert _plan(headlines).count("from_json") == 1
    assert [(r["k"], r["position"], r["headline"]) for r in headlines.collect()] == [("k", 0, "A b")]
    assert sorted((r["k"], r["reason"]) for r in bad.collect()) == [("c", "parser_failure"), ("n", "parser_failure"), ("u", "unsupported_source_name")]


def test_texts_are_cleaned_once(spark):
    df = spark.range(3).select(F.concat(F.lit("U.S. Treasury  "), F.col("id").cast("string"), F.lit(" auction")).alias("t"))
    plan = _plan(df.select(macro.event_group(F.col("t")).alias("g"), macro.importance(F.col("t"), F.lit("Labor")).alias("i"), macro.place(F.lit(None).cast("string"), F.col("t")).alias("p")))
    assert plan.count("regexp_replace") == 3


def test_names_are_cleaned_once(spark):
    rows = '{"rows":[{"Date":"2024-01-05","pe":"1","Time Frame":"Annual"},{"date":"2024-01-05","p/e":"2","timeframe":" annual"},{"date":"2024-01-05","pe":"n/a","timeframe":"annual"},{"date":"2024-01-05","pe":"3","timeframe":"weekly"},{"date":"soon","pe":"4","timeframe":"annual"}]}'
    df = spark.createDataFrame([("a", rows), ("b", '{"rows":[{"date":"2024-01-05"},{"pe":"1"}]}'), ("c", None), ("d", "no list")], "k string, p string")
    for frames, want in ((None, [("a", "2024-01-05", 3.0)]), (payloads.TIMEFRAMES, [("a", "2024-01-05", "annual", 2.0)])):
        got = payloads.report_rows(df, "p", ["k"], "rows", ["date"], {"pe": ["pe"]}, frames)
        assert _plan(got).count("regexp_replace") == 1
        assert [tuple(v if isinstance(v, (str, float)) else str(v) for v in r) for r in got.collect()] == want
    reports = '{"quarterlyEarnings":[{"fiscalDateEnding":"2024-03-31","reportedEPS":"1"},{"reportedDate":"2024-03-31","reportedEPS":"2"},{"reportedEPS":"3"}]}'
    got = payloads.earnings_history(spark.createDataFrame([("a", reports), ("b", '{"quarterlyEarnings":[{"reportedEPS":"3"}]}')], "k string, p string"), "p", ["k"])
    assert _plan(got).count("regexp_replace") == 1
    assert [(r["k"], str(r["date"]), r["reported_eps"]) for r in got.collect()] == [("a", "2024-03-31", 2.0)]
