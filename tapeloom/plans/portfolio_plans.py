"""Portfolio surfaces of accounts made of nations, with customers' segments as sleeves and orders as samples."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeloom.operators import surfaces
from tapeloom.plans.sqltext import r6
from tapeloom.session import table

SCALES = {"AUTOMOBILE": 0.5, "BUILDING": 1.0, "FURNITURE": 0.25, "HOUSEHOLD": 0.75}


def _inputs(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Samples at several moments of a day, allocations (machinery has none) and accounts, some without an assignment."""
    k, v = F.col("o_orderkey"), F.col("o_totalprice")
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), F.concat(F.lit("A"), "c_nationkey").alias("account"), F.col("c_mktsegment").alias("sleeve"))
    at = F.timestamp_seconds(F.unix_seconds(F.col("o_orderdate").cast("timestamp")) + F.pmod(k, F.lit(24)) * 3600)
    samples = table(spark, d, "orders").join(c, "o_custkey").select(
        "account", "sleeve", at.alias("bar_ts"), v.alias("portfolio_value"), F.when(k % 4 != 0, v * (k % 7) / 20.0).alias("cash"), ((k % 10) / 10.0).alias("gross_exposure"), ((k % 10) / 20.0 - 0.2).alias("net_exposure"),
        F.when(k % 5 != 0, (k % 9) / 10.0).alias("turnover"), (k % 3).cast("double").alias("commission"), F.when(k % 2 == 0, F.lit(2.5)).alias("slippage_cost"), F.when(k % 3 == 0, F.lit(-0.125)).alias("drawdown"), ((k % 11) / 100.0).alias("cumulative_return"))
    scale = F.element_at(F.create_map(*[x for s, w in SCALES.items() for x in (F.lit(s), F.lit(w))]), F.col("sleeve"))
    allocations = c.select("account", "sleeve").distinct().withColumns({"scale": scale, "target_weight": F.lit(0.25)}).where("scale is not null")
    n = F.substring("account", 2, 9).cast("int")
    accounts = c.select("account").distinct().select("account", (n * 9973.0).alias("seed_nav"), F.when(n % 3 == 0, 50000.0).otherwise(0.0).alias("residual_cash"), (n % 6 != 5).alias("assigned"), F.when(n % 8 != 7, True).alias("revised"))
    return surfaces.last_samples(samples, ["account", "sleeve"]), allocations, accounts


def _rounded(df: DataFrame) -> DataFrame:
    return df.select([(F.round(f.name, 6) + 0.0).alias(f.name) if f.dataType.simpleString() == "double" else F.col(f.name) for f in df.schema])


def history(spark: SparkSession, d: str) -> DataFrame:
    """An account's days from the last samples of its sleeves."""
    samples, allocations, accounts = _inputs(spark, d)
    return _rounded(surfaces.portfolio_history(samples, allocations, accounts))


def slices(spark: SparkSession, d: str) -> DataFrame:
    """Sleeves of an account at its last day."""
    samples, allocations, accounts = _inputs(spark, d)
    return _rounded(surfaces.portfolio_slices(samples, allocations, surfaces.portfolio_history(samples, allocations, accounts)))


def alerts(spark: SparkSession, d: str) -> DataFrame:
    """Accounts without an assignment or revision, with much cash, with sleeves off their target."""
    samples, allocations, accounts = _inputs(spark, d)
    days = surfaces.portfolio_history(samples, allocations, accounts)
    return _rounded(surfaces.portfolio_alerts(accounts, days, surfaces.portfolio_slices(samples, allocations, days)))


_SCALE = "CASE sleeve " + " ".join(f"WHEN '{s}' THEN {w}::DOUBLE" for s, w in SCALES.items()) + " END"
_BASE = f"""
c AS (SELECT c_custkey, 'A' || c_nationkey AS account, c_mktsegment AS sleeve FROM customer),
q AS (
  SELECT account, sleeve, o_orderdate + to_hours((o_orderkey % 24)::INTEGER) AS bar_ts, o_totalprice AS v, o_orderkey AS k,
    coalesce(CASE WHEN o_orderkey % 4 <> 0 THEN o_totalprice * (o_orderkey % 7) / 20.0::DOUBLE END, 0) AS cash, (o_orderkey % 10) / 10.0::DOUBLE AS gross, (o_orderkey % 10) / 20.0::DOUBLE - 0.2::DOUBLE AS net,
    CASE WHEN o_orderkey % 5 <> 0 THEN (o_orderkey % 9) / 10.0::DOUBLE END AS turnover, (o_orderkey % 3)::DOUBLE + CASE WHEN o_orderkey % 2 = 0 THEN 2.5::DOUBLE ELSE 0 END AS cost,
    CASE WHEN o_orderkey % 3 = 0 THEN -0.125::DOUBLE END AS dd, (o_orderkey % 11) / 100.0::DOUBLE AS cr
  FROM orders JOIN c ON o_custkey = c_custkey
), s AS (SELECT *, bar_ts::DATE AS as_of FROM q QUALIFY row_number() OVER (PARTITION BY account, sleeve, bar_ts::DATE ORDER BY bar_ts DESC, v DESC) = 1),
al AS (SELECT DISTINCT account, sleeve, {_SCALE} AS scale FROM c WHERE {_SCALE} IS NOT NULL),
ac AS (SELECT DISTINCT account, substr(account, 2)::INTEGER AS n FROM c),
p AS (SELECT d.account, x.sleeve, d.as_of FROM (SELECT DISTINCT account, as_of FROM s) d JOIN (SELECT account, sleeve, min(as_of) AS f FROM s GROUP BY 1, 2) x ON x.account = d.account AND d.as_of >= x.f),
j AS (SELECT p.account, p.sleeve, p.as_of, s.v, s.cash, s.gross, s.net, s.turnover, s.cost, coalesce(al.scale, 0) AS scale FROM p ASOF JOIN s ON p.account = s.account AND p.sleeve = s.sleeve AND p.as_of >= s.as_of LEFT JOIN al ON al.account = p.account AND al.sleeve = p.sleeve),
g AS (
  SELECT account, as_of, sum(v * scale) AS nav0, sum(cash * scale) AS cash0, sum(gross * v * scale) AS gross, sum(net * v * scale) AS net, sum(coalesce(turnover * v * scale, 0)) AS turnover,
    sum(CASE WHEN v * scale > 0 AND cost > 0 THEN cost * 10000 END) AS drag, sum(CASE WHEN v * scale > 0 AND cost > 0 THEN v * scale END) AS drag_on FROM j GROUP BY 1, 2
), b AS (SELECT g.*, n * 9973.0::DOUBLE AS seed, CASE WHEN n % 3 = 0 THEN 50000.0::DOUBLE ELSE 0 END AS extra, row_number() OVER (PARTITION BY g.account ORDER BY as_of) AS i FROM g JOIN ac USING (account)),
e AS (SELECT *, abs(nav0 + extra) < 1e-9 AND i = 1 AND seed > 0 AS emp FROM b),
n AS (SELECT *, CASE WHEN emp THEN seed ELSE nav0 + extra END AS nav, CASE WHEN emp THEN seed ELSE cash0 + extra END AS cash FROM e),
w AS (SELECT *, lag(nav) OVER (PARTITION BY account ORDER BY as_of) AS prev, greatest(max(nav) OVER (PARTITION BY account ORDER BY as_of), 0) AS peak, nav - seed AS cp, CASE WHEN seed > 0 THEN (nav - seed) / seed ELSE 0 END AS cret FROM n),
h AS (
  SELECT account, as_of, nav, cash, CASE WHEN nav > 0 THEN gross / nav ELSE 0 END AS gross_exposure, CASE WHEN nav > 0 THEN net / nav ELSE 0 END AS net_exposure, coalesce(nav - prev, cp) AS period_pnl,
    coalesce(coalesce(nav - prev, cp) / nullif(prev, 0), cret) AS period_return, cp AS cumulative_pnl, cret AS cumulative_return, CASE WHEN peak > 0 THEN nav / peak - 1 ELSE 0 END AS drawdown,
    CASE WHEN nav > 0 THEN turnover / nav END AS turnover, drag / nullif(drag_on, 0) AS cost_drag_bps FROM w
), l AS (SELECT account, arg_max(nav, as_of) AS nav, arg_max(cash, as_of) AS cash, max(as_of) AS as_of FROM h GROUP BY 1),
t AS (SELECT account, sleeve, arg_min(v, as_of) AS v0, arg_max(v, as_of) AS v, arg_max(gross, as_of) AS gross, arg_max(net, as_of) AS net, last(turnover ORDER BY as_of) AS turnover, last(dd ORDER BY as_of) AS dd, arg_max(cr, as_of) AS cr FROM s GROUP BY 1, 2),
u AS (SELECT account, sleeve, l.as_of, 0.25::DOUBLE AS target_weight, CASE WHEN nav > 0 THEN v * scale / nav ELSE 0 END AS aw, v * scale AS mv, gross, net, v * scale - v0 * scale AS pnl, nav, dd, turnover, cr FROM al JOIN t USING (account, sleeve) JOIN l USING (account)),
sl AS (
  SELECT account, sleeve, as_of, target_weight, aw AS actual_weight, mv AS market_value, greatest(gross * aw, 0) AS gross_exposure, net * aw AS net_exposure, pnl AS pnl_contribution, CASE WHEN nav > 0 THEN pnl / nav ELSE 0 END AS return_contribution,
    coalesce(dd, 0) * aw AS drawdown_contribution, turnover, cr AS since_inception_return, row_number() OVER (PARTITION BY account ORDER BY mv DESC, sleeve)::INTEGER AS position FROM u
)"""

_H = ("nav", "cash", "gross_exposure", "net_exposure", "period_pnl", "period_return", "cumulative_pnl", "cumulative_return", "drawdown", "turnover", "cost_drag_bps")
_S = ("target_weight", "actual_weight", "market_value", "gross_exposure", "net_exposure", "pnl_contribution", "return_contribution", "drawdown_contribution", "turnover", "since_inception_return")
HISTORY = f"WITH {_BASE} SELECT account, as_of, {', '.join(f'{r6(c)} AS {c}' for c in _H)} FROM h"
SLICES = f"WITH {_BASE} SELECT account, sleeve, as_of, {', '.join(f'{r6(c)} AS {c}' for c in _S)}, position FROM sl"
ALERTS = f"""WITH {_BASE}, a AS (
  SELECT account, 'no_assignment' AS code, 'critical' AS severity, NULL::DATE AS as_of, NULL::DOUBLE AS level FROM ac WHERE n % 6 = 5 UNION ALL SELECT account, 'no_portfolio_revision', 'critical', NULL, NULL FROM ac WHERE n % 8 = 7
  UNION ALL SELECT account, 'cash_residual_high', 'warning', as_of, cash / nav FROM l WHERE nav > 0 AND abs(cash / nav) >= 0.2 UNION ALL SELECT account, 'drift_' || sleeve, 'warning', as_of, actual_weight - target_weight FROM sl WHERE abs(actual_weight - target_weight) >= 0.1
) SELECT account, code, severity, as_of, {r6('level')} AS level FROM a"""


def register_all(register) -> None:
    register("portfolio_history", history, HISTORY)
    register("portfolio_slices", slices, SLICES)
    register("portfolio_alerts", alerts, ALERTS)
