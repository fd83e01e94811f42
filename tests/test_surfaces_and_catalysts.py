"""Position folds on hot keys, portfolio surfaces, headline versions, mentions, views, the gold table and regime inputs."""

from __future__ import annotations

import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F

from tapeloom.operators import catalysts, clean, fundamentals, gates, gold, portfolio, ranking, reference, regime, surfaces
from tapeloom.functions import macro
from tapeloom.sources import tables

T0 = dt.datetime(2024, 1, 1)


def _folded(trades):
    q = c = r = 0.0
    n = 0
    for t, p in trades:
        if t > 0:
            q, c = q + t, (q * c + t * p) / (q + t)
        else:
            sold = min(-t, q)
            q, r = q - sold, r + sold * (p - c)
            n += q == 0 and sold > 0
            c = c if q > 0 else 0.0
    return q, c, r, n


@pytest.mark.parametrize("block", [3, 4096])
def test_folds_of_hot_keys_equal_a_plain_fold(spark, block):
    rnd = random.Random(4)
    rows = [(1 if i < 900 else rnd.randrange(2, 6), i // 2, float(rnd.choice([1, 2, 5, -1, -2, -9, 0])), float(rnd.randrange(1, 50))) for i in range(1000)]
    df = spark.createDataFrame(rows, "k int, at int, quantity double, price double").repartition(7)
    got = {r["k"]: r for r in portfolio.fold_positions(df, ["k"], ["at"], block).collect()}
    for k in {r[0] for r in rows}:
        q, c, r, n = _folded([(t, p) for _, _, t, p in sorted(x for x in rows if x[0] == k)])
        g = got[k]
        assert g["quantity"] == q and g["closed_positions"] == n and g["average_cost"] == pytest.approx(c, abs=1e-9) and g["realized_pnl"] == pytest.approx(r, abs=1e-7)
    assert portfolio.fold_positions(df.limit(0), ["k"], ["at"], block).count() == 0


SAMPLE = "account string, sleeve string, bar_ts timestamp, portfolio_value double, cash double, gross_exposure double, net_exposure double, turnover double, commission double, slippage_cost double, drawdown double, cumulative_return double"


def _sample(account, sleeve, day, hour, value, cash, **more):
    base = {"gross": 0.5, "net": 0.25, "turnover": None, "commission": None, "slippage": None, "dd": None, "cr": 0.1} | more
    return (account, sleeve, T0 + dt.timedelta(days=day, hours=hour), value, cash, base["gross"], base["net"], base["turnover"], base["commission"], base["slippage"], base["dd"], base["cr"])


def test_surfaces_by_hand(spark):
    rows = [
        _sample("a", "x", 0, 9, 1.0, 1.0), _sample("a", "x", 0, 17, 100.0, 50.0), _sample("a", "y", 1, 9, 200.0, None, gross=1.0, net=-1.0, turnover=0.5, commission=2.0), _sample("a", "x", 2, 9, 300.0, 50.0, turnover=0.2),
        _sample("b", "x", 0, 9, 0.0, 0.0),
    ]
    samples = surfaces.last_samples(spark.createDataFrame(rows, SAMPLE), ["account", "sleeve"])
    assert samples.count() == 4
    allocations = spark.createDataFrame([("a", "x", 1.0, 0.25), ("a", "y", 0.5, 0.75), ("b", "x", 1.0, 1.0)], "account string, sleeve string, scale double, target_weight double")
    accounts = spark.createDataFrame([("a", 100.0, 0.0, True, True), ("b", 70.0, 0.0, False, None)], "account string, seed_nav double, residual_cash double, assigned boolean, revised boolean")
    history = surfaces.portfolio_history(samples, allocations, accounts)
    got = {(r["account"], (r["as_of"] - T0.date()).days): r for r in history.collect()}
    assert set(got) == {("a", 0), ("a", 1), ("a", 2), ("b", 0)}
    assert [got["a", d]["nav"] for d in range(3)] == [100.0, 200.0, 400.0] and [got["a", d]["cash"] for d in range(3)] == [50.0, 50.0, 50.0]
    r = got["a", 1]
    assert (r["gross_exposure"], r["net_exposure"], r["turnover"], r["cost_drag_bps"], r["period_pnl"], r["period_return"]) == (0.75, -0.375, 0.25, 2.0 * 10000 / 100, 100.0, 1.0)
    assert got["a", 0]["period_pnl"] == 0.0 and got["a", 2]["drawdown"] == 0.0 and got["b", 0]["nav"] == 70.0 and got["b", 0]["cash"] == 70.0
    slices = surfaces.portfolio_slices(samples, allocations, history)
    by = {(r["account"], r["sleeve"]): r for r in slices.collect()}
    assert (by["a", "x"]["actual_weight"], by["a", "x"]["position"], by["a", "x"]["pnl_contribution"], by["a", "y"]["market_value"]) == (0.75, 1, 200.0, 100.0)
    alerts = {(r["account"], r["code"]): r["level"] for r in surfaces.portfolio_alerts(accounts, history, slices).collect()}
    assert alerts == {("b", "no_assignment"): None, ("b", "no_portfolio_revision"): None, ("b", "cash_residual_high"): 1.0, ("a", "drift_x"): 0.5, ("a", "drift_y"): -0.5, ("b", "drift_x"): -1.0}


WORD = "headline_id string, observed_at timestamp, source_item_id string, source_name string, headline string, summary string, url string, author string, tickers string, published_at timestamp, source_updated_at timestamp, withdrawn boolean"


def test_headline_versions_by_hand(spark):
    at = lambda h: T0 + dt.timedelta(hours=h)
    rows = [
        ("h", at(1), "1", "alpaca_news", "Old", "s", None, None, None, at(0), at(1), None), ("h", at(2), "2", "massive_news", " ", "s", None, None, "A", at(1), None, None),
        ("h", at(3), "3", "massive_news", "New", "s", None, None, None, at(1), None, None), ("h", at(4), "3", "massive_news", "New", "s", None, None, None, at(1), None, None),
        ("h", at(5), "4", "elsewhere", "Other", "x", "u", None, None, at(-5), None, False), ("h", at(6), "5", "alpaca_news", "Old", "s", None, None, None, at(0), at(1), True),
        (None, at(1), "9", "alpaca_news", "no key", None, None, None, None, None, None, None),
    ]
    got = catalysts.headline_versions(spark.createDataFrame(rows, WORD)).orderBy("version_seq").collect()
    assert [(r["version_seq"], r["version_kind"], r["headline"], r["url"], r["tickers"]) for r in got] == [
        (1, "publish", "Old", None, None), (2, "correction", "Old", None, "A"), (3, "edit", "New", None, None), (4, "correction", "New", "u", None), (5, "withdrawal", "New", "u", None)]
    assert got[-1]["published_at"].replace(tzinfo=None) == at(-5) and got[-1]["withdrawn"]
    last = catalysts.current_headlines(catalysts.headline_versions(spark.createDataFrame(rows, WORD))).collect()
    assert [(r["headline_id"], r["version_seq"]) for r in last] == [("h", 5)]


def test_mentions_meet_their_parents(spark):
    events = spark.createDataFrame([("e1", "FOMC  rate decision", "US", None, "USD", "CentralBankPolicy", ["rates", "rates"], T0, T0, True, "Scheduled")],
                                   "event_id string, event_name string, country string, region string, currency string, event_group string, factors array<string>, published_at timestamp, effective_at timestamp, high_impact boolean, schedule_status string")
    headlines = spark.createDataFrame([("e1", None, None, "Labor", ["abc", "ABC", " "], T0)], "headline_id string, country string, region string, event_group string, tickers array<string>, published_at timestamp")
    found = catalysts.mentions(events, headlines)
    assert {(r["item_kind"], r["entity_type"], r["entity_key"]) for r in found.collect()} == {
        ("event", "country", "US"), ("event", "currency", "USD"), ("event", "indicator", "CentralBankPolicy"), ("event", "central_bank", "FED"), ("event", "factor", "rates"), ("headline", "indicator", "Labor"), ("headline", "symbol", "ABC")}
    more = found.unionByName(spark.createDataFrame([("event", "gone", "country", "US"), ("headline", "e2", "symbol", "ABC")], found.schema))
    days = {(r["entity_type"], r["entity_key"]): r for r in catalysts.entity_days(catalysts.with_parents(more, events, headlines), F.lit(T0)).collect()}
    assert len(days) == 7 and (days["country", "US"]["event_count"], days["country", "US"]["scheduled_count"], days["country", "US"]["policy_event_count"], days["country", "US"]["high_impact_event_count"]) == (1, 1, 1, 1)
    assert (days["symbol", "ABC"]["headline_count"], days["symbol", "ABC"]["event_count"], days["symbol", "ABC"]["last_effective_at"]) == (1, 0, None)


def test_views_and_their_functions(spark):
    events = spark.createDataFrame([(i, i % 3 == 0, ("scheduled", "released", "Unheard")[i % 3 - 1], dt.date(2024, 1, 1 + i)) for i in range(9)], "id int, withdrawal_flag boolean, schedule_status string, as_of_date date")
    made = catalysts.register_views(spark, "t_", events=events)
    assert made == ["t_economic_catalyst_calendar_by_date", "t_economic_catalyst_releases_by_date"]
    assert [r["id"] for r in spark.sql(f"SELECT id FROM {made[1]} ORDER BY id").collect()] == [2, 5, 8]
    assert [r["id"] for r in spark.sql(f"SELECT id FROM {made[0]}_between(DATE '2024-01-04', DATE '2024-01-06')").collect()] == [4]


def test_gold_table_has_one_exchange(spark):
    rows = [(s, dt.date(2023, 1, 2) + dt.timedelta(days=i), 10.0 + i % 7, 12.0 + i % 5, 8.0 + i % 3, 11.0 + i % 6, 100.0 + i % 11) for s in ("a", "b") for i in range(90)]
    bars = spark.createDataFrame(rows, "symbol string, date date, open double, high double, low double, close double, volume double")
    g = gold.gold_market(bars, zones=False)
    plan = g._jdf.queryExecution().executedPlan().toString()
    assert re.findall(r"Exchange (\w+)", plan) == ["hashpartitioning"] and "Join" not in plan and "Python" not in plan
    whole = gold.gold_market(bars)
    assert len(whole.columns) == len(set(whole.columns)) > 150 and whole.count() == 180
    assert not {"bar", "pivot_high"} & set(whole.columns)


def test_inputs_and_publish_window(spark):
    d = lambda n: dt.date(2024, 1, n)
    f = spark.createDataFrame([("S", d(n), 1.0 * n) for n in range(1, 7)] + [("V", d(n), 30.0 + n) for n in range(1, 6)] + [("W", d(n), 40.0) for n in range(1, 6)], "symbol string, date date, close double")
    macro = spark.createDataFrame([(d(n), 0.5) for n in (1, 2, 3, 5, 9)], "date date, rate double")
    slices = {"s": ("S", {"close": "s_close"}), "v": ("V", {"close": "v_close"}), "w": ("W", {"close": "w_close"})}
    out = regime.inputs_daily(f, macro, slices, "v_close", "w_close")
    got = {r["date"].day: r for r in out.collect()}
    assert set(got) == {1, 2, 3, 4, 5, 6, 9} and [got[n]["inputs_complete"] for n in (1, 4, 5, 6, 9)] == [True, False, True, False, False]
    assert [got[n]["vix_streak"] for n in (2, 3, 5, 6)] == [0, 1, 3, 0] and got[1]["vix_slope"] == 9.0
    w = regime.publish_window(out, "date", "inputs_complete").first()
    assert (w["published_through"], w["input_through"], w["skipped"]) == (d(5), d(9), [d(6), d(9)])
    none = regime.publish_window(out.where("date > '2024-01-05'"), "date", "inputs_complete").first()
    assert none["published_through"] is None and none["skipped"] == [d(6), d(9)]


EARN = "symbol string, fiscal_date date, report_date date, date date, reported_eps double, eps_estimate double, surprise double, position int"


def test_silver_earnings_by_hand(spark):
    d = lambda n: dt.date(2024, 1, n)
    actual = spark.createDataFrame([("A", d(1), d(2), None, 1.00005, -1.00005, 0.00004, 0), ("A", d(1), d(3), None, 2.67545, None, None, 1), (None, d(1), None, None, 1.0, None, None, 0), ("B", None, None, None, 1.0, None, None, 0)], EARN)
    scheduled = spark.createDataFrame([("A", d(1), d(9), None, None, 3.0, None, 0), ("A", None, d(5), d(1), None, 3.00005, None, 0), ("C", None, None, d(7), None, 4.0, None, 0)], EARN)
    got = {(r["symbol"], r["event_date"].day): r for r in fundamentals.silver_earnings(actual, scheduled).collect()}
    assert set(got) == {("A", 1), ("A", 5), ("C", 7)}
    assert (got["A", 1]["record_type"], got["A", 1]["reported_eps"], got["A", 1]["report_date"]) == ("actual", 2.6755, d(3)) and (got["A", 5]["record_type"], got["A", 5]["eps_estimate"]) == ("scheduled", 3.0001)
    one = fundamentals.silver_earnings(actual.limit(1), scheduled.limit(0)).first()
    assert (one["reported_eps"], one["eps_estimate"], one["surprise"]) == (1.0001, -1.0001, 0.0)


def test_listing_states_are_whole_words(spark):
    cases = {"Inactive": "inactive", "ACTIVE": "active", "not trading; inactive": "active", "Delisted": "delisted", "unlisted": None, "Halted by exchange": "suspended", "merged": "acquired", "interactive": None}
    facts = spark.createDataFrame([(k, k) for k in cases], "symbol string, status string")
    for c in ("name", "description", "asset_type", "exchange", "sector", "industry", "country", "delisting_date"):
        facts = facts.withColumn(c, F.lit(None).cast("string"))
    facts = facts.withColumn("industry2", F.lit("an ETF, exchange traded fund"))
    got = facts.select("status", reference.inferred()["listing_status_norm"].alias("state"), reference.inferred()["is_etf"].alias("etf")).collect()
    assert {r["status"]: r["state"] for r in got} == {**cases, "not trading; inactive": "active"} and {r["etf"] for r in got} == {"true"}


def test_keyword_rules_by_hand(spark):
    cases = {"US CPI release": "Inflation", "Nonfarm  Payrolls": "Labor", "GDP, second estimate": "GrowthActivity", "Housing starts": "Housing", "Consumer confidence": "ConsumerSentiment", "Trade balance": "TradeExternal",
             "10-year auction": "RatesFiscal", "FOMC minutes": "CentralBankPolicy", "Bank supervision": "CreditRegulatory", "Something else": "GrowthActivity"}
    df = spark.createDataFrame([(k,) for k in cases], "t string").withColumn("g", macro.event_group(F.col("t")))
    got = {r["t"]: (r["g"], r["i"]) for r in df.select("t", "g", macro.importance(F.col("t"), F.col("g")).alias("i")).collect()}
    assert {k: v[0] for k, v in got.items()} == cases
    assert [got[k][1] for k in ("US CPI release", "FOMC minutes", "10-year auction", "Housing starts")] == ["high", "medium", "medium", "low"]


def test_jumps_flags_samples_and_statistics(spark, tmp_path):
    d = lambda n: dt.date(2024, 1, n)
    rows = [("a", d(1))] * 10 + [("a", d(2))] * 30 + [("a", d(4))] * 90
    jumps = gates.count_jumps(spark.createDataFrame(rows, "k string, day date"), "k", "day", 1.5, 2.5, 5).collect()
    assert [(r["day"], r["ratio"], r["level"]) for r in jumps] == [(d(2), 3.0, "error")]
    flags = spark.createDataFrame([("1",), (" On",), ("YES",), ("0",), (None,), ("perhaps",)], "f string")
    assert sorted(r["f"] for r in clean.available(flags, "f").collect()) == [" On", "1", "YES"]
    hot = spark.createDataFrame([("a", i) for i in range(500)] + [("b", 1)], "k string, n int").repartition(6)
    first = clean.first_per(hot, ["k"], 3, F.desc("n"))
    assert sorted(map(tuple, first.collect())) == [("a", 497, 3), ("a", 498, 2), ("a", 499, 1), ("b", 1, 1)] and "WindowGroupLimit" in first._jdf.queryExecution().executedPlan().toString()
    sample = ranking.sample_symbols(spark.createDataFrame([("b",), ("a",), ("b",), (None,), ("c",)], "symbol string"), most=2).collect()
    assert [tuple(r) for r in sample] == [("a", 3), ("b", 3)]
    tables.write_buckets(spark.createDataFrame([("a", d(1)), ("b", d(5)), ("b", d(3))], "symbol string, date date"), str(tmp_path / "s"))
    s = tables.layer_stats(spark.read.parquet(str(tmp_path / "s")), "date").first()
    assert (s["rows"], s["first"], s["last"]) == (3, d(1), d(5)) and s["files"] >= 2 and s["bytes"] > 0
