"""Statement, earnings, price-target and alternative-data features."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tapeloom.functions.frames import Rolling
from tapeloom.functions.nulls import flag, r6, safe_div
from tapeloom.operators.asof import asof_forward


def statement_features(st: DataFrame) -> DataFrame:
    """Growth, margins, trailing sums and the nine-point score, at the grain of the statements (quarters)."""
    r = Rolling()
    c = F.col

    def change(x: str, n: int):
        return safe_div(c(x), r.lag(c(x), n)) - 1

    out = st.withColumns({
        "rev_qoq": change("revenue", 1), "rev_yoy": change("revenue", 4), "net_inc_yoy": change("net_income", 4), "shares_change_yoy": change("shares_outstanding", 4),
        "gross_margin": safe_div(c("gross_profit"), c("revenue")), "current_ratio_stmt": safe_div(c("current_assets"), c("current_liabilities")),
        **{f"{x}_ttm": r.total(c(x), 4) for x in ("revenue", "gross_profit", "net_income", "operating_cash_flow")},
        "long_term_debt_to_assets": safe_div(c("long_term_debt"), c("total_assets")),
    })
    out = out.withColumns({
        "margin_delta_qoq": c("gross_margin") - r.lag(c("gross_margin")),
        "roa_ttm": safe_div(c("net_income_ttm"), c("total_assets")), "gross_margin_ttm": safe_div(c("gross_profit_ttm"), c("revenue_ttm")),
        "asset_turnover_ttm": safe_div(c("revenue_ttm"), c("total_assets")),
    })

    def than_year_ago(x: str, sign: int):
        d = r.lag(c(x), 4)
        return flag(c(x) > d if sign > 0 else c(x) < d)

    marks = {
        "piotroski_roa_pos": flag(c("roa_ttm") > 0), "piotroski_cfo_pos": flag(c("operating_cash_flow_ttm") > 0), "piotroski_delta_roa_pos": than_year_ago("roa_ttm", 1),
        "piotroski_accruals_pos": flag(c("operating_cash_flow_ttm") > c("net_income_ttm")), "piotroski_leverage_decrease": than_year_ago("long_term_debt_to_assets", -1),
        "piotroski_liquidity_increase": than_year_ago("current_ratio_stmt", 1), "piotroski_no_new_shares": flag(c("shares_outstanding") <= r.lag(c("shares_outstanding"), 4)),
        "piotroski_gross_margin_increase": than_year_ago("gross_margin_ttm", 1), "piotroski_asset_turnover_increase": than_year_ago("asset_turnover_ttm", 1),
    }
    out = out.withColumns(marks)
    return out.withColumn("piotroski_f_score", sum((c(x) for x in marks), F.lit(0)))


def surprise_features(e: DataFrame) -> DataFrame:
    """Surprise share, its mean over 4 and deviation over 8 reports, and the share of beats over 8."""
    r = Rolling()
    s = safe_div(F.col("reported_eps") - F.col("eps_estimate"), F.abs(F.col("eps_estimate")))
    out = e.withColumn("surprise_pct", s)
    beat = F.when(F.col("surprise_pct").isNotNull(), (F.col("surprise_pct") > 0).cast("double"))
    return out.withColumns({
        "surprise_mean_4q": r6(r.mean(F.col("surprise_pct"), 4)), "surprise_std_8q": r6(r.std(F.col("surprise_pct"), 8)), "beat_rate_8q": r6(r.mean(beat, 8)),
    })


def earnings_calendar(daily: DataFrame, events: DataFrame) -> DataFrame:
    """Adds the last report, the days since, and the next scheduled report (a report on the day itself counts)."""
    actual = events.where("record_type = 'actual'").select("symbol", F.col("date"), F.lit(1).alias("_e"))
    out = daily.join(actual, ["symbol", "date"], "left")
    w = Window.partitionBy("symbol").orderBy("date").rowsBetween(Window.unboundedPreceding, 0)
    out = out.withColumns({"is_earnings_day": flag(F.col("_e") == 1), "last_earnings_date": F.last(F.when(F.col("_e") == 1, F.col("date")), True).over(w)}).drop("_e")
    out = out.withColumn("days_since_earnings", F.datediff("date", "last_earnings_date"))
    coming = events.where("record_type = 'scheduled'").select("symbol", F.col("report_date").alias("next_earnings_date"))
    out = asof_forward(out, coming, ["symbol"], "date", "next_earnings_date", ["next_earnings_date"])
    return out.withColumns({
        "days_until_next_earnings": F.datediff("next_earnings_date", "date"), "has_upcoming_earnings": flag(F.col("next_earnings_date").isNotNull()),
        "is_scheduled_earnings_day": flag(F.col("next_earnings_date") == F.col("date")),
    })


def target_features(t: DataFrame) -> DataFrame:
    """Dispersion, revisions and drift of price targets; ``obs_date`` orders the rows."""
    r = Rolling(order="obs_date")
    c = F.col
    up, down = c("tp_cnt_est_rev_up"), c("tp_cnt_est_rev_down")
    out = t.withColumns({
        "disp_abs": c("tp_high_est") - c("tp_low_est"), "disp_std_norm": safe_div(c("tp_std_dev_est"), c("tp_mean_est")), "rev_net": up - down,
        "rev_ratio": (up + 1) / (down + 1), "rev_intensity": safe_div(up + down, c("tp_cnt_est").cast("double")),
    }).withColumn("disp_norm", safe_div(c("disp_abs"), c("tp_mean_est")))
    row = F.row_number().over(r.w)
    out = out.withColumn("_n", row.cast("double"))
    slope = F.when(F.count("tp_mean_est").over(r.frame(90)) == 90, F.regr_slope("tp_mean_est", "_n").over(r.frame(90)))
    return out.withColumns({
        "disp_norm_change_30d": c("disp_norm") - r.lag(c("disp_norm"), 30), "tp_mean_change_30d": c("tp_mean_est") - r.lag(c("tp_mean_est"), 30),
        "disp_z": r6(r.zscore(c("disp_norm"), 252)), "tp_mean_slope_90d": r6(slope),
    }).drop("_n")


def calendar_sums(df: DataFrame, columns: list[str], days: tuple[int, ...] = (30, 90), by: str = "symbol", at: str = "as_of_date") -> DataFrame:
    """Adds sums over the last 30 and 90 calendar days, the day itself included."""
    day = F.datediff(F.col(at), F.lit("1970-01-01").cast("date"))
    out = df.withColumn("_day", day)
    new = {}
    for n in days:
        w = Window.partitionBy(by).orderBy("_day").rangeBetween(-(n - 1), 0)
        new |= {f"{c}_{n}d": F.sum(c).over(w) for c in columns}
    return out.withColumns(new).drop("_day")


def daily_trades(df: DataFrame) -> DataFrame:
    """Counts and amounts by day and symbol: buys, sells, net, and large ones."""
    buy, sell = F.col("side") == "buy", F.col("side") == "sell"
    return df.groupBy("as_of_date", "symbol").agg(
        F.count_if(buy).alias("buy_count"), F.count_if(sell).alias("sell_count"),
        F.sum(F.when(buy, F.col("amount")).otherwise(0.0)).alias("buy_amount"), F.sum(F.when(sell, F.col("amount")).otherwise(0.0)).alias("sell_amount"),
        F.max((F.col("amount") >= 100).cast("int")).alias("has_large"),
    ).withColumn("net_amount", F.col("buy_amount") - F.col("sell_amount"))


def silver_earnings(actual: DataFrame, scheduled: DataFrame, places: int = 4) -> DataFrame:
    """Reports of all symbols, one row an event: the last actual one, else the last scheduled one.

    Both: symbol, fiscal_date, report_date, date, reported_eps, eps_estimate,
    surprise and ``position`` (which of equal ones came last). An event is known
    by its fiscal date, else its report date, else its base date; a scheduled
    one that an actual one of the same symbol supersedes goes. Figures are
    rounded half up to ``places``. Rows without a symbol or any date are left out.
    """
    event = F.coalesce("fiscal_date", "report_date", "date")
    figures = ("reported_eps", "eps_estimate", "surprise")

    def last(df: DataFrame, kind: str) -> DataFrame:
        row = F.struct("fiscal_date", "report_date", *[F.round(c, places).alias(c) for c in figures])
        rows = df.withColumn("event_date", event).where(F.col("symbol").isNotNull() & F.col("event_date").isNotNull())
        return rows.groupBy("symbol", "event_date").agg(F.max_by(row, "position").alias("_r")).select("symbol", "event_date", "_r.*", F.lit(kind).alias("record_type"))

    done = last(actual, "actual")
    return done.unionByName(last(scheduled, "scheduled").join(done.select("symbol", "event_date"), ["symbol", "event_date"], "left_anti"))
