"""Catalyst events and headlines: versions of fused headlines, mentions, their parents, days of entities, and views."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tapeloom.functions.scalars import bound, single_spaced

# Who comes first where several feeds tell the same headline, words that name a central bank,
# and the groups that are counted by themselves.
FEED_PRIORITY = ("massive_news", "alpaca_news", "alpha_vantage_news")
CENTRAL_BANKS = (("FED", ("fomc", "fed")), ("ECB", ("ecb",)), ("BOE", ("boe", "bank rate")), ("BOJ", ("boj", "bank of japan")))
COUNTED_GROUPS = {"policy": "CentralBankPolicy", "inflation": "Inflation", "labor": "Labor", "growth": "GrowthActivity", "rates": "RatesFiscal"}
PICKED, LATEST = ("headline", "summary", "url", "author"), ("tickers",)


def _filled(x: Column) -> Column:
    return F.when(F.trim(x.cast("string")) != "", x)


def headline_versions(rows: DataFrame, key: str = "headline_id", at: str = "observed_at", tie: str = "source_item_id", source: str = "source_name", priority: tuple[str, ...] = FEED_PRIORITY) -> DataFrame:
    """A row whenever what all feeds say about a headline changes: ``key, version_seq, version_kind, at`` and the fused state.

    After each observation only the last word of every feed counts. PICKED
    fields are the first that is not blank by the feeds' priority (unknown feeds
    last, as one), LATEST ones the newest that is not blank; the earliest
    publication and the newest update are taken, and a headline is withdrawn if
    any feed's last word says so. A version is a ``publish`` if it is the first,
    a ``withdrawal``, an ``edit`` of headline or summary, else a ``correction``.
    One sort by (key, time), feeds are told apart by windows in it; rows without
    a key or time are left out.
    """
    w = Window.partitionBy(key).orderBy(at, tie, source)
    past = w.rowsBetween(Window.unboundedPreceding, 0)
    rank = F.lit(len(priority))
    for i, name in reversed(list(enumerate(priority))):
        rank = F.when(F.col(source) == name, i).otherwise(rank)
    word = F.struct(F.col(at).alias("at"), F.coalesce("withdrawn", F.lit(False)).alias("withdrawn"), "published_at", "source_updated_at", *[_filled(F.col(c)).alias(c) for c in (*PICKED, *LATEST)])
    out = rows.where(F.col(key).isNotNull() & F.col(at).isNotNull()).withColumn("_rank", rank)
    out = out.withColumns({f"_w{i}": F.last(F.when(F.col("_rank") == i, word), ignorenulls=True).over(past) for i in range(len(priority) + 1)})
    words = [F.col(f"_w{i}") for i in range(len(priority) + 1)]
    state = {c: F.coalesce(*[x[c] for x in words]) for c in PICKED}
    state |= {c: F.array_max(F.filter(F.array(*[F.when(x[c].isNotNull(), F.struct(x["at"].alias("at"), x[c].alias("v"))) for x in words]), lambda s: s.isNotNull()))["v"] for c in LATEST}
    state |= {"published_at": F.least(*[x["published_at"] for x in words]), "source_updated_at": F.greatest(*[x["source_updated_at"] for x in words])}
    state["withdrawn"] = F.greatest(*[x["withdrawn"] for x in words])
    out = out.select(key, F.col(at).alias("version_observed_at"), tie, source, F.struct(*[v.alias(k) for k, v in state.items()]).alias("_now"))
    v = Window.partitionBy(key).orderBy("version_observed_at", tie, source)
    before = F.lag("_now").over(v)
    out = out.withColumn("_before", before).where(F.col("_before").isNull() | ~F.col("_now").eqNullSafe(F.col("_before")))
    same = F.col("_now.headline").eqNullSafe(F.col("_before.headline")) & F.col("_now.summary").eqNullSafe(F.col("_before.summary"))
    kind = F.when(F.col("_before").isNull(), "publish").when(F.col("_now.withdrawn") & ~F.col("_before.withdrawn"), "withdrawal").when(~same, "edit").otherwise("correction")
    return out.select(key, F.row_number().over(v).alias("version_seq"), kind.alias("version_kind"), "version_observed_at", "_now.*")


def current_headlines(versions: DataFrame, key: str = "headline_id") -> DataFrame:
    """The last version of every headline."""
    fields = [c for c in versions.columns if c != key]
    return versions.groupBy(key).agg(F.max_by(F.struct(*fields), "version_seq").alias("_v")).select(key, "_v.*")


def mentions(events: DataFrame, headlines: DataFrame) -> DataFrame:
    """``item_kind, item_id, entity_type, entity_key``: what events and headlines are about, each once.

    Events: event_id, event_name, country, region, currency, event_group and
    factors (a list); headlines: headline_id, country, region, event_group and
    tickers (a list).
    """

    def named(*pairs: tuple[str, Column]) -> Column:
        return F.array(*[F.struct(F.lit(t).alias("entity_type"), x.alias("entity_key")) for t, x in pairs])

    def each(kind: str, listed: Column) -> Column:
        return F.coalesce(F.transform(listed, lambda x: F.struct(F.lit(kind).alias("entity_type"), x.alias("entity_key"))), F.array().cast("array<struct<entity_type:string,entity_key:string>>"))

    def bank_of(name: Column) -> Column:
        bank = F.lit(None).cast("string")
        for code, words in reversed(CENTRAL_BANKS):
            said = F.lit(False)
            for word in words:
                said = said | name.contains(word)
            bank = F.when(said, code).otherwise(bank)
        return bank

    c, bank = F.col, bound(F.lower("event_name"), bank_of)
    of_events = F.concat(named(("country", c("country")), ("region", c("region")), ("currency", c("currency")), ("indicator", c("event_group")), ("central_bank", bank)), each("factor", c("factors")))
    of_headlines = F.concat(named(("country", c("country")), ("region", c("region")), ("indicator", c("event_group"))), each("symbol", F.transform("tickers", lambda t: F.upper(t))))

    def cleaned(listed: Column) -> Column:
        return F.filter(F.transform(listed, lambda e: F.struct(e["entity_type"].alias("entity_type"), single_spaced(e["entity_key"]).alias("entity_key"))), lambda e: e["entity_key"] != "")

    rows = events.select(F.lit("event").alias("item_kind"), c("event_id").alias("item_id"), F.explode(cleaned(of_events)).alias("e")).unionByName(
        headlines.select(F.lit("headline").alias("item_kind"), c("headline_id").alias("item_id"), F.explode(cleaned(of_headlines)).alias("e")))
    return rows.select("item_kind", "item_id", "e.entity_type", "e.entity_key").where("item_id is not null").distinct()


def with_parents(mentions: DataFrame, events: DataFrame, headlines: DataFrame) -> DataFrame:
    """Mentions with what they belong to, looked up by (kind, id) among both; those without a parent go.

    A parent with a third of all mentions is one row here, and its mentions are
    split by adaptive execution. Adds published_at, effective_at (a headline has
    its publication), event_group, high_impact and schedule_status.
    """
    parents = events.select(F.lit("event").alias("item_kind"), F.col("event_id").alias("item_id"), "published_at", "effective_at", "event_group", "high_impact", F.lower("schedule_status").alias("schedule_status")).unionByName(
        headlines.select(F.lit("headline").alias("item_kind"), F.col("headline_id").alias("item_id"), "published_at", F.col("published_at").alias("effective_at"), "event_group",
                         F.lit(None).cast("boolean").alias("high_impact"), F.lit(None).cast("string").alias("schedule_status")))
    return mentions.join(parents, ["item_kind", "item_id"])


def entity_days(found: DataFrame, as_of: Column) -> DataFrame:
    """Counts of every entity's headlines and events by day (of :func:`with_parents`); what has no time counts for ``as_of``."""
    event = F.col("item_kind") == "event"
    count = lambda x: F.count_if(F.coalesce(x, F.lit(False)))
    return found.groupBy(F.to_date(F.coalesce("effective_at", as_of)).alias("as_of_date"), "entity_type", "entity_key").agg(
        count(~event).alias("headline_count"), count(event).alias("event_count"), count(event & F.col("high_impact")).alias("high_impact_event_count"),
        count(event & F.col("schedule_status").isin("released", "revised")).alias("release_count"), count(event & (F.col("schedule_status") == "scheduled")).alias("scheduled_count"),
        *[count(event & (F.col("event_group") == g)).alias(f"{n}_event_count") for n, g in COUNTED_GROUPS.items()],
        F.max("published_at").alias("last_published_at"), F.max(F.when(event, F.col("effective_at"))).alias("last_effective_at"),
    )


# Which schedule states stand in the calendar and which among the releases.
_VIEWS = {
    "economic_catalyst_calendar_by_date": "SELECT * FROM {events} WHERE NOT withdrawal_flag AND schedule_status IN ('scheduled', 'cancelled', 'unknown')",
    "economic_catalyst_releases_by_date": "SELECT * FROM {events} WHERE NOT withdrawal_flag AND schedule_status IN ('released', 'revised')",
    "economic_catalyst_headlines_by_date": "SELECT * FROM {headlines} WHERE NOT withdrawal_flag",
    "economic_catalyst_entity_daily_by_date": "SELECT * FROM {entity_daily}",
    "market_data_by_date": "SELECT * FROM {market_data}",
}


def register_views(spark: SparkSession, prefix: str = "", **tables: DataFrame) -> list[str]:
    """Views by date over the tables given (events, headlines, entity_daily, market_data), for SQL, and a table function for each.

    ``<view>_between(first, last)`` gives a view's rows of the days in [first,
    last] by ``as_of_date``; its condition reaches the scan as that of a query
    would. Returns the views' names.
    """
    for name, df in tables.items():
        df.createOrReplaceTempView(f"{prefix}{name}")
    made = []
    for view, sql in _VIEWS.items():
        over = next(n for n in ("events", "headlines", "entity_daily", "market_data") if f"{{{n}}}" in sql)
        if over not in tables:
            continue
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in tables[over].schema)
        spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW {prefix}{view} AS {sql.format(**{over: prefix + over})}")
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {prefix}{view}_between(first DATE, last DATE) RETURNS TABLE ({columns}) RETURN SELECT * FROM {prefix}{view} WHERE as_of_date BETWEEN first AND last")
        made.append(prefix + view)
    return made
