"""Release calendars by hand: pages of five sources, JSON dates, vendors' tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tapeloom.sources import calendars

AT = "2024-06-01 00:00:00"


def _utc(*x):
    return dt.datetime(*x)


def test_pages_of_five_sources(spark):
    pages = [
        (1, "bea_release_schedule", "<td>June 5</td> <td>8:30 AM</td><td>Data Release</td><td>Trade &amp; more</td> January 4 8:30 AM News GDP, third"),
        (2, "fomc_schedule", "<p>For 2024:</p><li>Tuesday, July 30, and Wednesday, July 31</li><p>For 2025:</p><li>Tuesday, January 28, and Wednesday, January 29</li>"),
        (3, "ecb_policy_calendar", "06/06/2024 Governing Council of the ECB: monetary policy meeting in Frankfurt (Day 1) 07/06/2024 Governing Council of the ECB: monetary policy meeting (Day 2), followed by press conference"),
        (4, "boe_mpc_calendar", "Thursday 20 June 2024 and Thursday 1 August and again Thursday 1 August"),
        (5, "boj_release_schedule", "<td>Jul. 30 (Tue), 31 (Wed)</td>"),
        (6, "boj_release_schedule", "nothing yet"), (7, "ecb_policy_calendar", None), (8, "unheard", "Thursday 20 June 2024"),
    ]
    good, bad = calendars.schedule_pages(spark.createDataFrame(pages, "k int, s string, p string"), "s", "p", ["k"], F.lit(AT).cast("timestamp"))
    got = sorted((r["k"], r["effective_at"].replace(tzinfo=None), r["event_name"], r["schedule_status"]) for r in good.collect())
    assert got == [
        (1, _utc(2024, 1, 4, 13, 30), "GDP, third", "released"), (1, _utc(2024, 6, 5, 12, 30), "Trade & more", "scheduled"),
        (2, _utc(2024, 7, 31, 18), "FOMC rate decision", "scheduled"), (2, _utc(2025, 1, 29, 19), "FOMC rate decision", "scheduled"),
        (3, _utc(2024, 6, 7, 12, 15), "ECB monetary policy decision", "scheduled"),
        (4, _utc(2024, 6, 20, 11), "BoE MPC rate decision", "scheduled"), (4, _utc(2024, 8, 1, 11), "BoE MPC rate decision", "scheduled"),
        (5, _utc(2024, 7, 31, 5), "BoJ monetary policy decision", "scheduled"),
    ]
    assert sorted((r["k"], r["reason"]) for r in bad.collect()) == [(6, "no_boj_rows_parsed"), (7, "no_ecb_rows_parsed")]


def test_release_dates(spark):
    df = spark.createDataFrame([(1, '{"release_dates":[{"release_id":10,"release_name":" CPI  ","date":"2024-06-01"},{"release_id":11,"date":"2024-06-02"},{"release_name":"x"}]}'), (2, "{broken"), (3, None)], "k int, p string")
    good, bad = calendars.release_dates(df, "p", ["k"], F.lit(AT).cast("timestamp"))
    assert [(r["source_event_key"], r["event_name"], r["schedule_status"]) for r in good.collect()] == [("10:2024-06-01", "CPI", "scheduled")]
    assert sorted(r["raw_identifier"] for r in bad.collect()) == ["11:2024-06-02", ":"]


def test_vendor_tables(spark):
    payload = '{"mapping":{"title_column":"T","date_column":"D","importance_column":"I","actual_column":"A","static_values":{"country":"US","event_name":"Other"}},"rows":[{"T":"CPI","D":"2024-06-01","I":"3","A":"1,234.5"},{"T":" ","D":"2024-06-02","I":"moderate"},{"T":"No day"},{"id":"9","T":"x","D":"2024-06-03","I":"?"}]}'
    good, bad = calendars.vendor_tables(spark.createDataFrame([(1, payload), (2, '{"rows":[{"event_name":"plain"}]}'), (3, None)], "k int, p string"), "p", ["k"])
    got = {r["event_name"]: r for r in good.collect()}
    assert {n: r["importance_tier"] for n, r in got.items()} == {"CPI": "high", "Other": "medium", "x": "low"}
    assert (got["CPI"]["actual_numeric"], got["CPI"]["actual_text"], got["CPI"]["time_precision"], got["x"]["source_event_key"], len(got["Other"]["source_event_key"])) == (1234.5, "1,234.5", "date_only", "9", 64)
    assert sorted((r["k"], r["raw_identifier"]) for r in bad.collect()) == [(1, "No day"), (2, "plain")]
