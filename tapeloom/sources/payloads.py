"""Provider payloads to rows: JSON, CSV, calendars and markup, with rejects kept apart."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapeloom.functions.scalars import clean_key, number, stable_hash, stripped_markup


def series_of(df: DataFrame, column: str) -> DataFrame:
    """Rows of ``{"Time Series": {moment: {"1. open": "…"}}}``; numeric prefixes of names go."""
    parsed = F.from_json(F.col(column), "struct<`Time Series`:map<string,map<string,string>>>")["Time Series"]
    out = df.select(*[c for c in df.columns if c != column], F.explode(parsed).alias("moment", "values"))
    return out.withColumn("values", F.transform_keys("values", lambda k, _: F.regexp_replace(k, r"^\d+\.\s*", "")))


def bars_from_csv(lines: DataFrame, column: str = "value") -> DataFrame:
    """Open, high, low, close and volume from CSV lines; undated lines and lines without prices go, no volume is 0."""
    names = ("date", "open", "high", "low", "close", "volume")
    s = F.from_csv(F.col(column), F.lit(", ".join(f"{n} string" for n in names)))
    p = lines.select(*[c for c in lines.columns if c != column], s.alias("s")).select("*", "s.*").drop("s")
    p = p.withColumns({"date": F.to_date(F.try_to_timestamp("date")), **{n: number(F.col(n)) for n in names[1:]}})
    p = p.withColumn("volume", F.coalesce("volume", F.lit(0.0)))
    return p.where(F.col("date").isNotNull() & F.col("open").isNotNull() & F.col("high").isNotNull() & F.col("low").isNotNull() & F.col("close").isNotNull())


def calendar_entries(df: DataFrame, column: str) -> DataFrame:
    """Entries of an iCalendar text: uid, summary, start."""
    entries = F.regexp_extract_all(F.col(column), F.lit(r"(?s)BEGIN:VEVENT(.*?)END:VEVENT"), 1)
    one = df.select(*[c for c in df.columns if c != column], F.explode(entries).alias("_e"))

    def field(name: str) -> Column:
        return F.nullif(F.trim(F.regexp_extract("_e", rf"(?m)^{name}(?:;[^:\n]*)?:(.*)$", 1)), F.lit(""))

    return one.withColumns({"uid": field("UID"), "summary": field("SUMMARY"), "starts": field("DTSTART")}).drop("_e")


def markup_links(df: DataFrame, column: str) -> DataFrame:
    """Targets and texts of the links in markup."""
    found = F.regexp_extract_all(F.col(column), F.lit(r'(?s)<a\s[^>]*href="[^"]*"[^>]*>.*?</a>'), 0)
    one = df.select(*[c for c in df.columns if c != column], F.posexplode(found).alias("position", "_a"))
    return one.withColumns({"target": F.regexp_extract("_a", r'href="([^"]*)"', 1), "label": stripped_markup(F.col("_a"))}).drop("_a")


def split_rejects(df: DataFrame, reasons: dict[str, Column], identifier: Column, payload: Column) -> tuple[DataFrame, DataFrame]:
    """Good rows, and rejects with the first reason, an identifier and a look at the payload."""
    reason = F.lit(None).cast("string")
    for name, bad in reversed(reasons.items()):
        reason = F.when(F.coalesce(bad, F.lit(False)), name).otherwise(reason)
    told = df.withColumn("_reason", reason)
    rejects = told.where("_reason is not null").select(F.col("_reason").alias("reason"), identifier.cast("string").alias("identifier"), F.substring(payload, 1, 200).alias("preview"))
    return told.where("_reason is null").drop("_reason"), rejects


# Reporting rhythms of statements, states of a price history, columns that tell the future.
TIMEFRAMES = ("quarterly", "annual")
HISTORY_STATES = ("ok", "no_history")
LOOK_AHEAD = ("excessreturn", "pricechange", "spychange")


def plain_name(x: Column) -> Column:
    """A field's name without case and anything but letters and digits."""
    return F.lower(F.regexp_replace(x, "[^0-9A-Za-z]", ""))


def plain_fields(entries: Column) -> Column:
    """A map as a list of entries with names as :func:`plain_name` leaves them, in their order; names are cleaned once for all look-ups."""
    return F.transform(F.map_entries(entries), lambda e: F.struct(plain_name(e["key"]).alias("key"), e["value"].alias("value")))


def field(entries: Column, *names: str) -> Column:
    """First non-null value among alternative names of a field in :func:`plain_fields`."""

    def one(name: str) -> Column:
        plain = "".join(c for c in name.lower() if c.isalnum())
        return F.get(F.filter(entries, lambda e: e["key"] == plain), F.lit(0))["value"]

    return F.coalesce(*[one(n) for n in names])


def day_of(x: Column) -> Column:
    return F.to_date(F.try_to_timestamp(F.trim(x)))


def report_rows(
    df: DataFrame, column: str, keys: list[str], path: str, dates: list[str], metrics: dict[str, list[str]], timeframes: tuple[str, ...] | None = TIMEFRAMES
) -> DataFrame:
    """Statement or valuation rows of the JSON list at ``path``: ``keys, date[, timeframe], metrics``.

    Undated rows, rows of other ``timeframes`` (None: not asked for) and rows
    without any metric go; of rows of one date (and timeframe) the last in the
    list stays. Null or unreadable payloads give no rows.
    """
    rows = F.from_json(F.col(column), f"struct<`{path}`:array<map<string,string>>>")[path]
    one = df.select(*keys, F.posexplode(rows).alias("position", "_row")).withColumn("_row", plain_fields(F.col("_row")))
    row = F.col("_row")
    one = one.select(*keys, "position", field(row, *dates).alias("date"), *([] if timeframes is None else [field(row, "timeframe").alias("timeframe")]), *[field(row, *names).alias(m) for m, names in metrics.items()])
    one = one.withColumns({"date": day_of(F.col("date")), **({} if timeframes is None else {"timeframe": F.lower(F.trim("timeframe"))}), **{m: number(F.col(m)) for m in metrics}})
    stays = F.col("date").isNotNull() & F.coalesce(*metrics).isNotNull()
    if timeframes is not None:
        stays = stays & F.col("timeframe").isin(*timeframes)
    group = [*keys, "date", *([] if timeframes is None else ["timeframe"])]
    # rows that go have no place among those of their date: a filter would be pushed down and clean all names again for each field
    last = one.groupBy(*group).agg(F.max_by(F.struct(*metrics), F.when(stays, F.col("position"))).alias("_m")).where("_m is not null")
    return last.select(*group, "_m.*")


def history_rows(df: DataFrame, column: str, keys: list[str], names: tuple[str, ...]) -> DataFrame:
    """Rows of ``{"status": …, "rows": […]}`` price histories; a history that is empty by its status gives one row without a date."""
    parsed = F.from_json(F.col(column), "struct<status:string,rows:array<map<string,string>>>")
    one = df.select(*keys, F.coalesce(F.nullif(F.lower(F.trim(parsed["status"])), F.lit("")), F.lit("ok")).alias("status"), parsed["rows"].alias("_rows"))
    one = one.where(F.col("status").isin(*HISTORY_STATES) & (F.col("_rows").isNotNull() | (F.col("status") == "no_history")))
    one = one.select(*keys, "status", F.explode_outer("_rows").alias("_row")).withColumn("_row", plain_fields(F.col("_row")))
    return one.select(*keys, "status", day_of(field(F.col("_row"), "date")).alias("date"), *[number(field(F.col("_row"), n)).alias(n) for n in names])


def listed_reports(df: DataFrame, column: str, keys: list[str], kind: str, names: dict[str, str]) -> DataFrame:
    """Rows of one of the report lists of a financial-reports payload, by fiscal date."""
    rows = F.from_json(F.col(column), f"struct<`{kind}`:array<map<string,string>>>")[kind]
    one = df.select(*keys, F.explode(rows).alias("_row")).withColumn("_row", plain_fields(F.col("_row")))
    return one.select(*keys, F.lit(kind).alias("report_type"), day_of(field(F.col("_row"), "fiscalDateEnding")).alias("date"), *[number(field(F.col("_row"), n)).alias(c) for c, n in names.items()])


def earnings_history(df: DataFrame, column: str, keys: list[str]) -> DataFrame:
    """Actual reports of a ``quarterlyEarnings`` list, the last per date; a surprise in percent becomes a fraction."""
    rows = F.from_json(F.col(column), "struct<quarterlyEarnings:array<map<string,string>>>")["quarterlyEarnings"]
    one = df.select(*keys, F.posexplode(rows).alias("position", "_row")).withColumn("_row", plain_fields(F.col("_row")))

    def text(name: str) -> Column:
        return F.nullif(F.trim(field(F.col("_row"), name)), F.lit(""))

    one = one.select(*keys, "position", day_of(F.coalesce(text("fiscalDateEnding"), text("reportedDate"))).alias("date"), F.struct(
        day_of(text("reportedDate")).alias("report_date"), number(text("reportedEPS")).alias("reported_eps"), number(text("estimatedEPS")).alias("eps_estimate"),
        F.coalesce(number(text("surprisePercentage")) / 100, number(text("surprise"))).alias("surprise"), F.lit("actual").alias("record_type")).alias("_r"))
    last = one.groupBy(*keys, "date").agg(F.max_by("_r", F.when(F.col("date").isNotNull(), F.col("position"))).alias("_r"))
    return last.where("_r is not null").select(*keys, "date", "_r.*")


def csv_fields(df: DataFrame, column: str, keys: list[str], names: list[str]) -> DataFrame:
    """``keys, position`` and the named fields of CSV texts with a header line, found by :func:`plain_name`; texts that lack one of them give no rows."""
    lines = df.select(*keys, F.split(F.trim(column), r"\r?\n").alias("_lines"))
    lines = lines.withColumn("_head", F.transform(F.split(F.col("_lines")[0], ","), plain_name))
    at = {n: F.array_position("_head", F.lit("".join(c for c in n.lower() if c.isalnum()))) for n in names}
    has = None
    for p in at.values():
        has = (p > 0) if has is None else has & (p > 0)
    one = lines.where(has).select(*keys, *[p.cast("int").alias(f"_at{i}") for i, p in enumerate(at.values())], F.posexplode(F.slice("_lines", 2, F.size("_lines"))).alias("position", "_line"))
    one = one.withColumn("_values", F.split("_line", ","))
    return one.select(*keys, "position", *[F.nullif(F.trim(F.get("_values", F.col(f"_at{i}") - 1)), F.lit("")).alias(n) for i, n in enumerate(names)])


def corporate_actions(df: DataFrame, column: str, keys: list[str]) -> DataFrame:
    """Dividend and split of every dated line of adjusted-daily CSV texts; 0 and 1 where blank, the last line of a date."""
    f = csv_fields(df, column, keys, ["timestamp", "dividend amount", "split coefficient"])
    f = f.select(*keys, "position", day_of(F.col("timestamp")).alias("date"), F.coalesce(number(F.col("dividend amount")), F.lit(0.0)).alias("dividend_amount"),
                 F.coalesce(number(F.col("split coefficient")), F.lit(1.0)).alias("split_coefficient")).where("date is not null")
    return f.groupBy(*keys, "date").agg(F.max_by(F.struct("dividend_amount", "split_coefficient"), "position").alias("_m")).select(*keys, "date", "_m.*")


def ticker_list(df: DataFrame, column: str, keys: list[str]) -> DataFrame:
    """Listing records, upper-cased symbols, the first record of each by ``keys`` and place in its list."""
    rows = F.from_json(F.col(column), "array<struct<ticker:string,name:string,primary_exchange:string,type:string,active:string>>")
    one = df.select(*keys, F.posexplode(rows).alias("position", "r")).withColumn("symbol", F.upper(F.trim("r.ticker"))).where("symbol <> ''")
    text = {c: F.nullif(F.trim(f"r.{n}"), F.lit("")).alias(c) for c, n in (("name", "name"), ("exchange", "primary_exchange"), ("asset_type", "type"))}
    active = F.lower("r.active").isin("true", "1", "yes", "y", "t").alias("active")
    return one.groupBy("symbol").agg(F.min_by(F.struct(*text.values(), active), F.struct(*keys, "position")).alias("_r")).select("symbol", "_r.*")


def vendor_batch(df: DataFrame, column: str, dataset: str, hints: list[str], requested: Column | None = None) -> DataFrame:
    """``symbol, dataset, source_hash, payload`` of a vendor's rows: names cleaned, fields that tell the future dropped, equal rows once.

    The symbol is the one that was asked for, else the first of ``hints`` with a value.
    """
    one = df.select(F.explode(F.from_json(F.col(column), "array<map<string,string>>")).alias("_row"))
    hinted = F.coalesce(*[F.nullif(F.upper(F.trim(F.col("_row")[h])), F.lit("")) for h in hints])
    kept = F.array_sort(F.map_entries(F.map_filter("_row", lambda k, _: ~plain_name(k).isin(*LOOK_AHEAD))))
    fields = F.transform_keys(F.map_from_entries(kept), lambda k, _: clean_key(k))
    symbol = hinted if requested is None else F.coalesce(F.nullif(F.upper(F.trim(requested)), F.lit("")), hinted)
    one = one.select(symbol.alias("symbol"), F.lit(dataset).alias("dataset"), F.to_json(fields).alias("payload"))
    return one.withColumn("source_hash", stable_hash(F.col("dataset"), F.col("payload"))).dropDuplicates(["source_hash"])
