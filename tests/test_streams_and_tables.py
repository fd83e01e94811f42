"""Stateful streams in pieces, staged tables, zoned scans, summary states, and catalyst payloads."""

from __future__ import annotations

import datetime as dt
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tapeloom.operators import gates, summary_states
from tapeloom.sources import catalysts, staged, tables
from tapeloom.streaming import monitor

T0 = dt.datetime(2024, 1, 1)
POLL_IN = "event_id long, symbol long, observed_at timestamp, snapshot_at timestamp, price double"
POLL_OUT = "symbol long, observed_at timestamp, event_id long, kind string, issue string, status string, queued boolean, price double, last_snapshot_at timestamp"


def _at(minutes: float) -> dt.datetime:
    return T0 + dt.timedelta(minutes=minutes)


def _poll(spark, base, schema=POLL_IN):
    stream = spark.readStream.schema(schema).parquet(f"{base}/in")
    monitor.run_through(spark, monitor.poll_statuses(stream, "30 minutes", 3600, 7200), f"{base}/out", f"{base}/state")
    return sorted(map(tuple, spark.read.schema(POLL_OUT).parquet(f"{base}/out").collect()), key=str)


def _replayed(rows, mark, cooldown=60.0, silence=120.0):
    """What the poll must say, by a plain replay; minutes since T0."""
    out = []
    for symbol in sorted({r[1] for r in rows}):
        refresh = snapshot = poll = None
        told = True

        def silent(now):
            nonlocal refresh, told
            if poll is not None and not told and poll + silence < now and poll + silence <= mark:
                due = refresh is None or refresh <= poll + silence - cooldown
                out.append((symbol, poll + silence, None, "snapshot_missing", None, "failed", due, snapshot))
                refresh, told = (poll + silence if due else refresh), True

        for event, _, at, taken, _ in sorted((r for r in rows if r[1] == symbol and r[2] <= mark), key=lambda r: (r[2], r[0])):
            silent(at)
            due = refresh is None or refresh <= at - cooldown
            issue = "missing_or_unparseable_timestamp" if taken is None else "future_timestamp" if taken > at + 1 else "stale_timestamp" if taken < at - 15 else None
            snapshot = snapshot if issue else taken
            out.append((symbol, at, event, "snapshot_timestamp_invalid" if issue else "snapshot_observed", issue, "failed" if issue else "refresh_queued" if due else "observed", due, snapshot))
            refresh, poll, told = (at if due else refresh), at, False
        silent(float("inf"))
    return out


def test_poll_in_pieces_with_restarts(spark, tmp_path):
    rnd = random.Random(3)
    rows, at = [], 0.0
    for i in range(240):
        at += rnd.choice([0.5, 2, 9, 30])
        near = at + rnd.choice([0, 0, 0, 0.5, 2, -20])
        rows.append((i, rnd.choice([1, 1, 2, 3, 4]) if i < 200 else 1, at, None if rnd.random() < 0.1 else near, float(i)))
    rows[50:54] = rows[53:49:-1]  # out of order, but within the delay
    rows = [r for r in rows if r[1] != 4 or r[2] < 300]  # symbol 4 falls silent for good
    for k in range(3):
        part = rows[k * len(rows) // 3 : (k + 1) * len(rows) // 3]
        part += part[:5] if k == 1 else []  # the same polls again
        spark.createDataFrame([(e, s, _at(a), None if t is None else _at(t), p) for e, s, a, t, p in part], POLL_IN).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        got = _poll(spark, str(tmp_path))
    assert got == _poll(spark, str(tmp_path))  # nothing new, nothing twice
    want = _replayed(rows, max(r[2] for r in rows) - 30)
    have = [(r[0], r[1].replace(tzinfo=None), r[2], r[3], r[4], r[5], r[6], r[8]) for r in got]
    assert sorted(have, key=str) == sorted(((s, _at(a), e, k, i, st, q, None if t is None else _at(t)) for s, a, e, k, i, st, q, t in want), key=str)
    assert any(r[3] == "snapshot_missing" and r[0] == 4 for r in have)


def test_timestamp_issues(spark):
    cases = [(None, monitor.MISSING), (61, monitor.FUTURE), (60, None), (0, None), (-900, None), (-901, monitor.STALE)]
    df = spark.createDataFrame([(T0, None if s is None else T0 + dt.timedelta(seconds=s)) for s, _ in cases], "o timestamp, s timestamp")
    assert [r[0] for r in df.select(monitor.timestamp_issue(F.col("s"), F.col("o"))).collect()] == [w for _, w in cases]


def test_rolling_sums_drop_late_rows_and_old_panes(spark, tmp_path):
    day = lambda n, h=1: T0 + dt.timedelta(days=n, hours=h)
    first = [("a", day(n), 1.0) for n in range(0, 120)] + [("b", day(0), 5.0), ("b", day(29), 7.0), ("b", day(30), 11.0), (None, day(3), 9.0), ("a", None, 9.0), ("a", day(2, 5), None)]
    second = [("a", day(50), 1000.0), ("a", day(118), 10.0), ("a", day(125), 1.0)]  # the first is far behind the watermark
    for rows in (first, second):
        spark.createDataFrame(rows, "symbol string, at timestamp, v double").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        stream = spark.readStream.schema("symbol string, at timestamp, v double").parquet(f"{tmp_path}/in")
        monitor.run_through(spark, monitor.rolling_day_sums(stream, "at", ["v"]), f"{tmp_path}/out", f"{tmp_path}/state")
    got = {(r["symbol"], (r["as_of_date"] - T0.date()).days): (r["v"], r["v_30d"], r["v_90d"]) for r in spark.read.parquet(f"{tmp_path}/out").collect()}
    assert got["a", 0] == (1.0, 1.0, 1.0) and got["a", 2] == (1.0, 3.0, 3.0) and got["a", 50] == (1.0, 30.0, 51.0) and got["a", 100] == (1.0, 30.0, 90.0)
    assert got["a", 118] == (11.0, 40.0, 100.0) and got["b", 29] == (7.0, 12.0, 12.0) and got["b", 30] == (11.0, 18.0, 23.0)
    assert ("a", 125) not in got and len(got) == 120 + 3
    state = spark.read.format("statestore").option("operatorId", 0).option("stateVarName", "panes").load(f"{tmp_path}/state")
    assert state.count() <= 90 + 3


def _table(spark, tmp_path, **more):
    return staged.StagedTable(spark, str(tmp_path / "t"), "symbol string, day int, v double", ["symbol", "day"], **more)


def _all(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_staged_batches_are_all_or_nothing(spark, tmp_path):
    t = _table(spark, tmp_path, buckets=4)
    assert t.read().count() == 0
    make = lambda rows: spark.createDataFrame(rows, "symbol string, day int, v double")
    first = make([("a", 1, 1.0), ("a", 2, None), ("b", 1, 3.0), ("c", 9, 4.0)])
    assert t.apply(first, 1) == {"inserted": 4, "updated": 0, "unchanged": 0, "deleted": 0}
    before = _all(t.read())

    @F.udf("double")
    def failing(v):
        raise RuntimeError("lost")

    with pytest.raises(Exception, match="lost"):
        t.apply(make([("a", 1, 5.0), ("z", 1, 1.0)]).withColumn("v", failing("v")), 2)
    for wrong in ([("a", 1, 1.0), ("a", 1, 2.0)], [(None, 1, 1.0)]):
        with pytest.raises(ValueError, match="null or come twice"):
            t.apply(make(wrong), 3)
    assert _all(t.read()) == before and t.log().count() == 1
    assert t.apply(make([("zz", 1, 9.0)]), 1) is None and _all(t.read()) == before
    did = t.apply(make([("a", 1, 1.0), ("a", 2, 2.0), ("d", 4, 1.0)]), 4, scope=make([("c", 0, 0.0), ("a", 0, 0.0)]))
    assert (did["inserted"], did["updated"], did["deleted"]) == (1, 1, 1)
    assert _all(t.read()) == _all(make([("a", 1, 1.0), ("a", 2, 2.0), ("b", 1, 3.0), ("d", 4, 1.0)]))
    assert t.apply(make([]), 5) == {"inserted": 0, "updated": 0, "unchanged": 0, "deleted": 0}
    assert t.apply(make([]), 6, scope=make([("a", 0, 0.0)]))["deleted"] == 2 and _all(t.read()) == _all(make([("b", 1, 3.0), ("d", 4, 1.0)]))


def test_streamed_batches_are_applied_once(spark, tmp_path):
    t = _table(spark, tmp_path)
    for k in range(2):
        spark.createDataFrame([(f"s{i}", k, float(i)) for i in range(5)], "symbol string, day int, v double").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        for _ in range(2):
            stream = spark.readStream.schema("symbol string, day int, v double").parquet(f"{tmp_path}/in")
            staged.stream_into(stream, t, f"{tmp_path}/state")
    assert t.read().count() == 10 and t.log().count() == 2


def test_ranges_that_are_not_touched_keep_their_files(spark, tmp_path):
    rows = [(f"{c}{i:03d}", i, 1.0) for c in "adgkmpsv" for i in range(40)]
    df = spark.createDataFrame(rows, "symbol string, day int, v double")
    t = _table(spark, tmp_path, splits=staged.prefix_splits(df, "symbol", 4, 1))
    assert len(t.splits) == 3
    t.apply(df, "all")
    names = lambda: set(t.read().inputFiles())
    before = names()
    t.apply(spark.createDataFrame([("a0005", 0, 2.0), ("a003", 3, 1.0)], "symbol string, day int, v double"), "few")
    assert len(before & names()) >= 3 and t.read().count() == len(rows) + 1
    for f in names():
        have = [r["symbol"] for r in spark.read.parquet(f).collect()]
        assert have == sorted(have)


def test_zoned_scan_opens_only_files_that_can_match(spark, tmp_path):
    schema = "symbol string, at timestamp, v long"
    rows = [(f"S{s}", T0 + dt.timedelta(days=n), s * 1000 + n) for s in range(8) for n in range(100)]
    staged.write_zoned(spark.createDataFrame(rows, schema).repartition(4), str(tmp_path / "z"), "at", files=16)
    scan = lambda **more: staged.scan_zoned(spark, str(tmp_path / "z"), schema, ["symbol", "v"], "at", **more)
    every = len(scan().inputFiles())
    some = scan(symbols=["S3"], start="2024-02-01", end="2024-02-10")
    assert every >= 12 and 1 <= len(some.inputFiles()) <= 3
    assert sorted(r["v"] for r in some.collect()) == [3000 + n for n in range(31, 41)]
    assert scan().count() == 800 and scan(symbols=[]).count() == 0 and scan(start="2030-01-01").count() == 0
    assert "PushedFilters: [" in some._jdf.queryExecution().toString()
    assert staged.scan_zoned(spark, str(tmp_path / "none"), schema, ["v"], "at").count() == 0


def test_versions_with_columns_and_rows(spark, tmp_path):
    tables.write_version(spark.range(10).withColumn("x", F.col("id") * 2), str(tmp_path / "v"), 0)
    got = tables.read_version(spark, str(tmp_path / "v"), 0, {"x": "string", "gone": "int"}, F.col("x") == "6")
    assert list(map(tuple, got.collect())) == [("6", None)]


def test_merged_states_equal_one_pass(spark):
    rows = [(chr(97 + i % 3), f"s{i % 700}", dt.date(2024, 1, 1 + i % 28), float(i % 501), None) for i in range(6000)]
    df = spark.createDataFrame(rows, "b string, s string, d date, x double, n string")
    states = summary_states.bucket_states(df, "b", "s", "d", ["x"])
    whole = summary_states.merged(states, numbers=["x"]).first()
    assert (whole["rows"], whole["first"], whole["last"], whole["columns"]) == (6000, dt.date(2024, 1, 1), dt.date(2024, 1, 28), ["s", "d", "x"])
    assert abs(whole["symbols_estimated"] - 700) <= 14 and abs(whole["median_x"] - 250) <= 10  # symbols lie in several buckets here
    assert whole["symbols"] == sum(len({r[1] for r in rows if r[0] == b}) for b in "abc")
    assert summary_states.merged(states.limit(0), "bucket").count() == 0
    text = summary_states.documents(summary_states.merged(states, "bucket"), "bucket", "t", "d").first()["value"]
    assert '"columnCount":3' in text and '"column":"d"' in text


def test_schema_drift_tells_order(spark):
    df = spark.createDataFrame([], "a int, c string, b int, x int")
    got = set(map(tuple, gates.schema_drift(df, {"a": "int", "b": "bigint", "c": "string", "y": "int"}).collect()))
    assert got == {("y", "missing"), ("x", "extra"), ("b", "type"), ("b", "order"), ("c", "order")}


def test_auctions_by_hand(spark):
    ok = "<a><auction><cusip>C1</cusip><securityType>Bill</securityType><auctionDate>2024-07-02</auctionDate><announcementType>x &lt; y</announcementType></auction></a>"
    spaced = "<q:list xmlns:q='urn:q'><q:auction><q:type>Note  10y</q:type><q:auction_date>2024-01-02</q:auction_date></q:auction><q:auction><q:type/></q:auction></q:list>"
    df = spark.createDataFrame([(1, ok), (2, spaced), (3, ok[:-9]), (4, "plain"), (5, None), (6, "<a/>")], "k int, p string")
    events, rejects = catalysts.auctions(df, "p", ["k"], F.lit("2024-03-01").cast("timestamp"))
    got = {r["k"]: r for r in events.collect()}
    assert set(got) == {1, 2} and got[1]["source_event_key"] == "C1" and got[1]["summary"] == "x < y" and got[1]["schedule_status"] == "scheduled"
    assert got[1]["effective_at"].replace(tzinfo=None) == dt.datetime(2024, 7, 2, 15, 30)  # 11:30 in summer
    assert got[2]["effective_at"].replace(tzinfo=None) == dt.datetime(2024, 1, 2, 16, 30) and got[2]["source_event_key"] == "Note 10y:2024-01-02" and got[2]["schedule_status"] == "released"
    assert sorted(r["k"] for r in rejects.collect()) == [3, 4, 5, 6] and rejects.where("reason <> 'no_treasury_rows_parsed'").count() == 0


def test_feeds_by_hand(spark):
    rows = [
        (1, "massive_news", '{"results":[{"id":7,"title":" A  b ","published":"2024-01-02T03:04:05Z","tags":["x","x"," "]},{"title":""}]}'),
        (2, "alpaca_news", '{"results":[{"headline":"h","symbols":["Z"],"created_at":"2024-01-02T03:04:05Z"}]}'),
        (3, "alpha_vantage_news", '{"feed":[{"title":"t","url":"u","time_published":"20240102T030405","topics":[{"topic":"T"}],"ticker_sentiment":[{"ticker":"Q"}]}]}'),
        (4, "unheard", "{}"), (5, None, "{}"), (6, "alpaca_news", "{broken"), (7, "alpaca_news", None), (8, "massive_news", "{}"),
    ]
    good, bad = catalysts.feed_headlines(spark.createDataFrame(rows, "k int, s string, p string"), "s", "p", ["k"])
    got = {r["k"]: r for r in good.collect()}
    assert set(got) == {1, 2, 3} and (got[1]["headline"], got[1]["source_item_id"], got[1]["tags"]) == ("A b", "7", ["x"])
    assert (got[2]["source_item_id"], got[2]["tickers"]) == ("h", ["Z"]) and (got[3]["source_item_id"], got[3]["tickers"], got[3]["channels"]) == ("u", ["Q"], ["T"])
    assert all(r["published_at"].replace(tzinfo=None) == dt.datetime(2024, 1, 2, 3, 4, 5) for r in got.values())
    assert {r["k"]: r["reason"] for r in bad.collect()} == {4: "unsupported_source_name", 5: "unsupported_source_name", 6: "parser_failure", 7: "parser_failure"}


def test_syndicated_by_hand(spark):
    rss = "<rss xmlns:d='urn:d'><channel><item><title>One</title><link>l1</link><pubDate>Tue, 2 Jan 2024 03:04:05 +0200</pubDate><d:creator>c</d:creator></item><item><link>no title</link></item></channel></rss>"
    atom = "<feed xmlns='urn:a'><entry><title>Two</title><id>i2</id><updated>2024-01-02T03:04:05Z</updated><link href='h'/><author><name>n</name></author></entry></feed>"
    good, bad = catalysts.syndicated(spark.createDataFrame([(1, rss), (2, atom), (3, "<rss><channel>"), (4, None), (5, "<other/>")], "k int, p string"), "p", ["k"])
    got = {r["k"]: r for r in good.collect()}
    assert set(got) == {1, 2} and (got[1]["source_item_id"], got[1]["author"], got[2]["url"], got[2]["author"]) == ("l1", "c", "h", "n")
    assert got[1]["published_at"].replace(tzinfo=None) == dt.datetime(2024, 1, 2, 1, 4, 5)
    assert sorted(r["k"] for r in bad.collect()) == [3, 4, 5]


def _laid_out(rows):
    """Cells of a table by a plain grid of taken squares."""
    taken, out = set(), []
    for r, row in enumerate(rows):
        c = 0
        for text, rs, cs in row:
            while (r, c) in taken:
                c += 1
            taken |= {(r + i, c + j) for i in range(rs) for j in range(cs)}
            out.append((r, c, rs, cs, text))
            c += cs
    return out


def test_table_cells_stand_where_spans_leave_room(spark):
    rnd = random.Random(9)
    pages, want = [], []
    for page in range(60):
        rows = [[(f"{page}.{r}.{i}", rnd.choice([1, 1, 1, 2, 3]), rnd.choice([1, 1, 2])) for i in range(rnd.randrange(0, 5))] for r in range(rnd.randrange(0, 6))]
        ends = rnd.random() < 0.5
        body = "".join("<tr>" + "".join(f"<td rowspan={rs} colspan='{cs}'>{t}" + "</td>" * ends for t, rs, cs in row) + "</tr>" * ends for row in rows)
        pages.append((page, f"<div>x<table>{body}" + "</table>" * ends))
        want += [(page, 0, *cell) for cell in _laid_out(rows)]
    pages += [(100, None), (101, ""), (102, "<td>no table</td>"), (103, "<table><tr><td>a<table><tr><th rowspan=x colspan=-1>in &amp; <script>no</script>side</table>b</table>")]
    got = catalysts.markup_tables(spark.createDataFrame(pages, "page int, html string").repartition(3), "page", "html").collect()
    assert sorted((r["page"], r["table_no"], r["row_no"], r["column_no"], r["row_span"], r["column_span"], r["text"]) for r in got if r["page"] < 100) == sorted(want)
    assert sorted((r["page"], r["table_no"], r["is_header"], r["text"]) for r in got if r["page"] >= 100) == [(103, 0, False, "ab"), (103, 1, True, "in & side")]


def test_splits_and_paths_are_stable(spark, tmp_path):
    df = spark.createDataFrame([("b",), ("a",), (None,)], "s string")
    assert staged.prefix_splits(df.limit(0), "s", 4) == []
    t = staged.StagedTable(spark, str(tmp_path / "x"), "s string", ["s"], splits=["b"])
    t.apply(df.where("s is not null"), "one")
    assert t.apply(df.where("s = 'a'"), "two")["unchanged"] == 1
    assert sorted(p.name for p in Path(tmp_path / "x" / "log").iterdir() if not p.name.startswith(("_", "."))) == ["n=1", "n=2"]
