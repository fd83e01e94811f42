"""Operators on small tables made by hand."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tapeloom.functions import scalars as S
from tapeloom.operators import candles, clean, maintain, portfolio, regime, structure
from tapeloom.sources import payloads, tables


def day(n):
    return dt.date(2024, 1, 1) + dt.timedelta(days=n)


def bars(spark, rows):
    return spark.createDataFrame([("A", day(i), *map(float, r)) for i, r in enumerate(rows)], "symbol string, date date, open double, high double, low double, close double, volume double")


def test_doji_and_engulfing(spark):
    rows = [(10, 10.5, 9.5, 10 - i, 1) for i in range(5)] + [(6, 6.2, 4.8, 5, 1), (4.9, 6.6, 4.8, 6.5, 1), (6.5, 7.5, 5.5, 6.51, 1)]
    out = candles.candlestick_patterns(bars(spark, rows)).orderBy("date").collect()
    assert out[6]["pat_bullish_engulfing"] == 1 and out[7]["pat_doji"] == 1
    assert all(r["pat_morning_star"] in (0, 1) for r in out)


def test_pivots_are_known_three_bars_later(spark):
    highs = [1, 2, 3, 9, 3, 2, 1, 1, 1]
    b = bars(spark, [(h, h, h - 0.5, h, 1) for h in highs]).withColumn("atr_14d", F.lit(1.0))
    got = {r["bar"]: r["pivot_high"] for r in structure.confirmed_pivots(b).collect()}
    assert got[6] == 9.0 and all(v is None for k, v in got.items() if k != 6)


def test_zones_match_a_plain_replay(spark):
    px = [10, 11, 12, 13, 12, 11, 10, 9, 10, 11, 12, 13.02, 12, 11, 10, 9.05, 10, 11, 12, 13, 12, 11, 10]
    b = bars(spark, [(p, p + 0.1, p - 0.1, p, 100) for p in px]).withColumns({"atr_14d": F.lit(0.5), "return_1d": F.lit(0.0), "gap_atr": F.lit(0.0)})
    out = structure.zones_and_sweeps(structure.confirmed_pivots(b)).orderBy("bar").collect()
    zones = []
    for r in out:
        if r["pivot_high"] is not None:
            half = structure.zone_half_width(r["pivot_high"], r["pivot_high_atr"])
            near = [z for z in zones if z["low"] - half <= r["pivot_high"] <= z["high"] + half]
            if near:
                z = min(near, key=lambda x: abs(sum(x["px"]) / len(x["px"]) - r["pivot_high"]))
                z["px"].append(r["pivot_high"])
                z["low"], z["high"] = min(z["low"], r["pivot_high"] - half), max(z["high"], r["pivot_high"] + half)
            else:
                zones.append({"px": [r["pivot_high"]], "low": r["pivot_high"] - half, "high": r["pivot_high"] + half})
        ok = [(abs(sum(z["px"]) / len(z["px"]) - r["close"]), len(z["px"])) for z in zones if z["low"] <= r["close"] <= z["high"] or sum(z["px"]) / len(z["px"]) >= r["close"]]
        assert r["sr_resistance_1_touches"] == (min(ok)[1] if ok else 0)


def test_rules_compile_and_reject(spark):
    df = spark.createDataFrame([(1.0, "a"), (None, "b"), (3.0, None)], "x double, s string")
    tree = {"or": [{"field": "x", "op": "gt", "value": 2.0}, {"field": "s", "op": "not_in", "values": ["a"]}]}
    got = [r[0] for r in df.select(clean.rule(tree, {"x": "number", "s": "string"})).collect()]
    assert got == [False, True, True]
    with pytest.raises(ValueError):
        clean.rule({"field": "s", "op": "gt", "value": "a"}, {"s": "string"})


def test_snake_names(spark):
    assert clean.snake_names(spark.createDataFrame([(1, 2, 3)], ["FooBar", "foo bar", "A%"])).columns == ["foo_bar", "foo_bar_2", "a"]


def test_half_up(spark):
    got = spark.range(1).select(S.half_up(F.lit(1.005), 2), S.half_up(F.lit(-1.005), 2), S.half_up(F.lit(1.0049), 2)).first()
    assert tuple(got) == (1.01, -1.01, 1.0)


def test_fold_positions(spark):
    t = spark.createDataFrame([(1, 1, 10.0, 2.0), (1, 2, 10.0, 4.0), (1, 3, -5.0, 5.0), (1, 4, -30.0, 6.0)], "k int, at int, quantity double, price double")
    r = portfolio.fold_positions(t, ["k"], ["at"]).first()
    assert (r["quantity"], r["realized_pnl"], r["closed_positions"]) == (0.0, 5 * 2.0 + 15 * 3.0, 1)


def test_streak_and_transitions(spark):
    df = spark.createDataFrame([("a", i, v) for i, v in enumerate([1.0, 2.0, None, 3.0, 4.0])], "s string, at int, x double")
    got = [r[0] for r in df.select("at", regime.streak(F.col("x") > 1, "s", "at").alias("k")).orderBy("at").select("k").collect()]
    assert got == [0, 1, 0, 1, 2]


def test_staged_apply_is_null_safe(spark):
    a = spark.createDataFrame([(1, None), (2, "x"), (3, "y")], "k int, v string")
    b = spark.createDataFrame([(1, None), (2, "z"), (4, "n")], "k int, v string")
    assert {r["k"]: r["op"] for r in maintain.staged_apply(a, b, ["k"], ["v"]).collect()} == {1: "unchanged", 2: "update", 3: "delete", 4: "insert"}


def test_buckets_and_versions(spark, tmp_path):
    df = spark.createDataFrame([("abc", 1), ("1z", 2), ("99", 3)], "symbol string, n int")
    p = str(tmp_path / "b")
    tables.write_buckets(df, p)
    got = tables.read_buckets(spark, p, ["A", "X"], {"symbol": "string", "n": "int", "extra": "double"})
    assert sorted((r["symbol"], r["n"], r["extra"]) for r in got.collect()) == [("99", 3, None), ("abc", 1, None)]
    tables.write_version(df, str(tmp_path / "v"), 1)
    assert tables.read_version(spark, str(tmp_path / "v"), 1).count() == 3
    assert tables.table_or_none(spark, str(tmp_path / "none"), "a int").count() == 0
    assert tables.layer_stats(tables.read_version(spark, str(tmp_path / "v"), 1)).first()["rows"] == 3


def test_payloads(spark):
    ics = "BEGIN:VEVENT\nUID:1\nSUMMARY:CPI\nDTSTART;TZID=X:20240101T083000\nEND:VEVENT\nBEGIN:VEVENT\nUID:2\nEND:VEVENT"
    rows = payloads.calendar_entries(spark.createDataFrame([(ics,)], "t string"), "t").collect()
    assert [(r["uid"], r["summary"], r["starts"]) for r in rows] == [("1", "CPI", "20240101T083000"), ("2", None, None)]
    js = '{"Time Series": {"2024-01-01": {"1. open": "5", "2. high": "6"}}}'
    r = payloads.series_of(spark.createDataFrame([(js,)], "t string"), "t").first()
    assert r["moment"] == "2024-01-01" and r["values"] == {"open": "5", "high": "6"}
    v = payloads.vendor_batch(spark.createDataFrame([('[{"Net %": "1", "T": "a"}]',), ('[{"Net %": "1", "T": "a"}]',)], "t string"), "t", "d", ["T"])
    assert v.count() == 1 and v.first()["payload"] == '{"net_pct":"1","t":"a"}' and v.first()["symbol"] == "A"


def test_totals_of_a_stream_that_stops_and_goes_on(spark, tmp_path):
    from tapeloom.streaming import jobs

    schema = "event_id long, ts timestamp, user_id long, event_type string, value double, props string"

    def arrive(*rows):
        spark.createDataFrame([(i, dt.datetime(2024, 1, 1, h, m), 1, "view", v, "{}") for i, h, m, v in rows], schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")

    def totals():
        jobs.keep_totals(jobs.event_stream(spark, f"{tmp_path}/in", spark.createDataFrame([], schema).schema), f"{tmp_path}/out", f"{tmp_path}/state")
        return sorted((r["start"].hour, r["start"].minute, r["n"], r["total"]) for r in jobs.kept_totals(spark, f"{tmp_path}/out").collect())

    arrive((1, 10, 1, 1.0), (2, 10, 4, 2.0), (2, 10, 4, 2.0))
    assert totals() == [(10, 0, 2, 3.0)]
    assert totals() == [(10, 0, 2, 3.0)]
    # a later run: a new window, a late event of the first, and one that came before
    arrive((3, 11, 0, 5.0), (4, 10, 2, 4.0), (1, 10, 1, 1.0))
    assert totals() == [(10, 0, 3, 7.0), (11, 0, 1, 5.0)]


def test_column_repair_and_rules(spark):
    df = spark.createDataFrame([(1, None, "B", 1.0, 2, None), (2, "A", "A", 1.0, 2, 3)], "unnamed_0 int, symbol string, symbol_2 string, ExcessReturn double, source_x int, m int")
    out = clean.with_any(clean.one_symbol(clean.without_residue(df)), ["m"])
    assert out.columns == ["symbol", "m", "conflict"] and [tuple(r) for r in out.collect()] == [("A", 3, False)]
    assert clean.without_residue(df.limit(0)).count() == 0
    assert clean.snake_names(spark.createDataFrame([(1, 2)], ["ATRValue", " % "])).columns == ["atr_value", "col"]


def test_payloads_that_cannot_be_read(spark):
    from tapeloom.sources import payloads as P

    df = spark.createDataFrame([(1, None), (2, ""), (3, "{"), (4, '{"rows":[]}'), (5, '{"rows":[{"date":"2024-01-31","timeframe":"Annual","Revenue":"1,000"},{"date":"x"},null]}')], "k long, payload string")
    got = P.report_rows(df, "payload", ["k"], "rows", ["date"], {"revenue": ["revenue"]}).collect()
    assert [(r["k"], str(r["date"]), r["timeframe"], r["revenue"]) for r in got] == [(5, "2024-01-31", "annual", 1000.0)]
    assert P.history_rows(df, "payload", ["k"], ("open",)).where("date is not null").count() == 1
    csv = spark.createDataFrame([(1, None), (2, "timestamp,close\n2024-01-01,3"), (3, "Timestamp,DIVIDEND amount,split-coefficient\r\n2024-01-01,,\n2024-01-01,2,\nx,1,1")], "k long, payload string")
    assert [tuple(r)[2:] for r in P.corporate_actions(csv, "payload", ["k"]).collect()] == [(2.0, 1.0)]
    for make in (P.earnings_history, P.corporate_actions):
        assert make(df.limit(0), "payload", ["k"]).count() == 0


def test_values_at_ranks(spark):
    from tapeloom.functions.frames import value_at

    values = [(i * 7919) % 1000 for i in range(3000)] + [500] * 2000 + [None] * 5
    df = spark.createDataFrame([(v, None if v is None else f"Key {v:04d}") for v in values], "v int, s string")
    ordered = sorted(v for v in values if v is not None)
    for rank in (0, 1, 1499, 2500, 4998, 4999):
        want = (ordered[rank], ordered.index(ordered[rank]))
        assert value_at(df, "v", rank, few=10) == want and value_at(df, "v", rank) == want
        assert value_at(df, "s", rank, few=10) == (f"Key {want[0]:04d}", want[1])


def test_rotation_and_purge_of_odd_tables(spark):
    df = spark.createDataFrame([(x,) for x in ("c", None, "a", "b", "d")], "k string")
    assert [r["k"] for r in clean.rotation(df, "k", 4, 3).orderBy("position").collect()] == ["d", None, "a"]
    assert [r["k"] for r in clean.rotation(df, "k", 7, 9).orderBy("position").collect()] == ["b", "c", "d", None, "a"]
    assert clean.rotation(df.limit(0), "k", 1, 2).count() == 0
    n = spark.createDataFrame([(float(x),) for x in (1, 2, 2, 3, 4)] + [(None,)], "x double")
    assert sorted(r[0] for r in clean.purge(n, "x", "bottom_percent", 25).collect()) == [1.0, 2.0, 2.0]
    assert clean.purge(n.limit(0), "x", "top_percent", 5).count() == 0


def test_exits_meet_only_the_bars_that_can_matter(spark):
    b = bars(spark, [(10, 10 + i % 3, 9, 10, 1) for i in range(40)])
    p = spark.createDataFrame([(f"p{i}", "A", day(i - 1), 10.0) for i in range(42)] + [("gone", "B", day(1), 1.0)], "position_id string, symbol string, entry_date date, entry_price double")
    got = {r["position_id"]: (r["exit_date"], r["bars_held"], r["rule"]) for r in portfolio.first_exits(p, b, 0.5, 5.0, 0.5, 7).collect()}
    assert got == {f"p{i}": (day(i + 6), 7, "time") for i in range(34)}
