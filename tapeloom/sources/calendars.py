"""Release calendars: dates in JSON, schedules in central banks' pages, and vendors' tables whose columns a mapping names; what gives no event is kept apart."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapeloom.functions.scalars import number, stable_hash, stripped_markup
from tapeloom.sources.catalysts import moment, plain
from tapeloom.sources.payloads import day_of

_MONTH = r"(?:January|February|March|April|May|June|July|August|September|October|November|December)"
_DAY = r"(?:Monday|Tuesday|Wednesday|Thursday|Friday|Saturday|Sunday)"
EVENTS = ("source_event_key", "event_name", "effective_at", "published_at", "time_precision", "schedule_status")


def _status(at: Column, ingested: Column) -> Column:
    return F.when(at >= ingested, "scheduled").otherwise("released")


def release_dates(batches: DataFrame, payload: str, keys: list[str], ingested_at: Column) -> tuple[DataFrame, DataFrame]:
    """Events of a JSON list ``release_dates``, a day each; items without a name or a date are rejects ``keys, raw_identifier, reason``."""
    read = F.from_json(F.col(payload), "struct<release_dates:array<struct<release_id:string,release_name:string,date:string,release_last_updated:string>>>")
    one = batches.select(*keys, ingested_at.alias("_at"), F.explode(read["release_dates"]).alias("r"))
    one = one.select(*keys, "_at", F.concat_ws(":", F.coalesce("r.release_id", F.lit("")), F.coalesce("r.date", F.lit(""))).alias("source_event_key"), plain(F.col("r.release_name")).alias("event_name"), day_of(F.col("r.date")).alias("_day"))
    good = one.where("event_name is not null and _day is not null").select(
        *keys, "source_event_key", "event_name", F.col("_day").cast("timestamp").alias("effective_at"), F.col("_day").cast("timestamp").alias("published_at"), F.lit("date_only").alias("time_precision"),
        _status(F.col("_day"), F.to_date("_at")).alias("schedule_status"))
    bad = one.where("event_name is null or _day is null").select(*keys, F.col("source_event_key").alias("raw_identifier"), F.lit("missing_release_name_or_date").alias("reason"))
    return good, bad


@dataclass(frozen=True)
class Schedule:
    """How a page of one source tells its dates.

    ``pattern`` is searched in the page's plain text; its groups are put
    together as ``shape`` says (``{0}`` the whole find, ``{y}`` the year of the
    batch) and read by ``format`` in ``zone``, at ``hour:minute`` where the
    format has no time. ``name`` is the event, or the group that holds it.
    """

    source: str
    pattern: str
    shape: str
    format: str
    zone: str
    name: str | int
    key: str
    reason: str
    clock: tuple[int, int] | None = None
    precision: str = "exact"


# Wording of the sources' pages, names and hours of their decisions. A date without a year is of the batch's
# year; days come before months where a source writes them so; a meeting of two days is decided on the second.
SCHEDULES = (
    Schedule("bea_release_schedule", rf"({_MONTH}\s+\d{{1,2}})\s+(\d{{1,2}}:\d{{2}}\s+[AP]M)\s+(?:News|Data Release|Visual Data|Article|N|D|V|A)\s+(.+?)(?={_MONTH}\s+\d{{1,2}}\s+\d{{1,2}}:\d{{2}}\s+[AP]M|$)",
             "{1} {y} {2}", "MMMM d yyyy h:mm a", "America/New_York", 3, "{3}:{1} {2}", "no_schedule_rows_parsed"),
    Schedule("fomc_schedule", rf"(\d{{4}})@{_DAY},\s+({_MONTH}\s+\d{{1,2}}),\s+and\s+{_DAY},\s+({_MONTH}\s+\d{{1,2}})", "{3} {1}", "MMMM d yyyy", "America/New_York", "FOMC rate decision", "fomc:{1}:{2}:{3}", "no_fomc_rows_parsed", (14, 0)),
    Schedule("ecb_policy_calendar", r"(\d{2}/\d{2}/\d{4})\s+Governing Council of the ECB: monetary policy meeting[^/]*?Day 2\), followed by press conference", "{1}", "dd/MM/yyyy", "Europe/Paris", "ECB monetary policy decision", "ecb:{1}", "no_ecb_rows_parsed", (14, 15)),
    Schedule("boe_mpc_calendar", rf"{_DAY}\s+(\d{{1,2}}\s+{_MONTH})(?:\s+(\d{{4}}))?", "{1} {2|y}", "d MMMM yyyy", "Europe/London", "BoE MPC rate decision", "boe:{1} {2}", "no_boe_rows_parsed", (12, 0)),
    Schedule("boj_release_schedule", r"([A-Z][a-z]{2})\.\s+(\d{1,2})\s+\([^)]*\),\s+(\d{1,2})\s+\([^)]*\)", "{1} {3} {y}", "MMM d yyyy", "Asia/Tokyo", "BoJ monetary policy decision", "boj:{1}. {2}:{3}", "no_boj_rows_parsed", (14, 0), "approximate"),
)


def _filled(shape: str, found: Column, pattern: str, year: Column) -> Column:
    """The shape with the groups of one find put in; a find is searched again for each group, it is short."""
    parts = []
    for piece in re.split(r"(\{[^}]*\})", shape):
        if piece == "{y}":
            parts.append(year)
        elif piece.startswith("{"):
            group, _, other = piece[1:-1].partition("|")
            text = F.trim(F.regexp_replace(F.regexp_extract(found, pattern, int(group)), r"\s+", " "))
            parts.append(F.when(text == "", year).otherwise(text) if other else text)
        elif piece:
            parts.append(F.lit(piece))
    return F.trim(F.concat(*parts))


def _event_of(s: Schedule, year: Column) -> Callable[[Column], Column]:
    """What one find of a schedule's pattern tells."""

    def event(found: Column) -> Column:
        local = F.try_to_timestamp(_filled(s.shape, found, s.pattern, year), F.lit(s.format))
        local = local + F.expr(f"interval {s.clock[0]} hours {s.clock[1]} minutes") if s.clock else local
        name = F.lit(s.name) if isinstance(s.name, str) else F.trim(F.regexp_replace(F.regexp_extract(found, s.pattern, s.name), r"\s+", " "))
        return F.struct(_filled(s.key, found, s.pattern, year).alias("source_event_key"), name.alias("event_name"), F.to_utc_timestamp(local, s.zone).alias("effective_at"), F.lit(s.precision).alias("time_precision"))

    return event


def schedule_pages(batches: DataFrame, source: str, payload: str, keys: list[str], ingested_at: Column) -> tuple[DataFrame, DataFrame]:
    """Events in the pages of SCHEDULES, told by ``source``; a page that gives none is a reject ``keys, source_name, reason``.

    Events: ``keys, source_name`` and EVENTS; the moment is UTC. Of two events
    of a page with one key the later stays. Pages of other sources give nothing.
    """
    text = stripped_markup(F.col(payload))
    # a section's year is put before each of its meetings, so that one pattern holds both
    sections = F.transform(F.regexp_extract_all(text, F.lit(r"For \d{4}:.+?(?=For \d{4}:|$)"), 0), lambda s: F.regexp_replace(s, rf"({_DAY}),\s+(?={_MONTH}\s+\d{{1,2}},\s+and)", F.concat(F.substring(s, 5, 4), F.lit("@$1, "))))
    text = F.when(F.col(source) == "fomc_schedule", F.array_join(sections, " ")).otherwise(text)
    one = batches.where(F.col(source).isin(*[s.source for s in SCHEDULES])).select(*keys, F.col(source).alias("source_name"), ingested_at.alias("_at"), text.alias("_text"))
    year = F.date_format("_at", "yyyy")
    kind = "array<struct<source_event_key:string,event_name:string,effective_at:timestamp,time_precision:string>>"
    events = F.array().cast(kind)
    reason = F.lit(None).cast("string")
    for s in SCHEDULES:
        listed = F.transform(F.regexp_extract_all("_text", F.lit(s.pattern), 0), _event_of(s, year))
        mine = F.col("source_name") == s.source
        events = F.when(mine, F.filter(listed, lambda e: e["effective_at"].isNotNull() & (e["event_name"] != "")).cast(kind)).otherwise(events)
        reason = F.when(mine, s.reason).otherwise(reason)
    one = one.select(*keys, "source_name", "_at", F.coalesce(events, F.array().cast(kind)).alias("_events"), reason.alias("reason"))
    rows = one.select(*keys, "source_name", "_at", F.explode("_events").alias("e"))
    last = rows.groupBy(*keys, "source_name", "e.source_event_key").agg(F.max_by(F.struct("e.event_name", "e.effective_at", "e.time_precision", "_at"), F.struct("e.effective_at", "e.event_name")).alias("e"))
    good = last.select(*keys, "source_name", "source_event_key", "e.event_name", "e.effective_at", F.col("e.effective_at").alias("published_at"), "e.time_precision", _status(F.col("e.effective_at"), F.col("e._at")).alias("schedule_status"))
    return good, one.where(F.size("_events") == 0).select(*keys, "source_name", "reason")


_COLUMNS = ("title", "effective_at", "date", "published_at", "updated_at", "importance", "country", "currency", "actual", "consensus", "previous", "unit", "status")
HIGH, MEDIUM = ("3", "high", "important"), ("2", "medium", "moderate")


def vendor_tables(batches: DataFrame, payload: str, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """Events of vendors' tables: ``rows`` of a JSON payload, whose columns ``mapping`` names (``title_column`` and so on) and ``static_values`` fill in.

    An event has a title and a moment, or a day; other rows are rejects ``keys,
    raw_identifier, reason``. Adds importance tier, actual, consensus and
    previous figures with their texts.
    """
    names = ", ".join(f"{c}_column:string" for c in _COLUMNS)
    read = F.from_json(F.col(payload), f"struct<mapping:struct<{names},static_values:map<string,string>>,rows:array<map<string,string>>>")
    one = batches.select(*keys, read["mapping"].alias("m"), F.explode(read["rows"]).alias("r"))

    def said(c: str, default: str | None = None) -> Column:
        column = F.coalesce(F.nullif(F.col(f"m.{c}_column"), F.lit("")), F.lit(default)) if default else F.nullif(F.col(f"m.{c}_column"), F.lit(""))
        return plain(F.when(column.isNotNull(), F.try_element_at(F.col("r"), column)))

    def fixed(c: str) -> Column:
        return plain(F.try_element_at(F.col("m.static_values"), F.lit(c)))

    exact, tier = F.col("m.effective_at_column").isNotNull() & (F.col("m.effective_at_column") != ""), F.lower(F.coalesce(said("importance"), fixed("importance")))
    title = said("title", "event_name")
    key = F.coalesce(plain(F.try_element_at(F.col("r"), F.lit("id"))), title, stable_hash(F.to_json(F.map_from_entries(F.array_sort(F.map_entries("r"))))))
    one = one.select(
        *keys, key.alias("source_event_key"), F.coalesce(title, fixed("event_name")).alias("event_name"), F.coalesce(moment(said("effective_at")), day_of(said("date")).cast("timestamp")).alias("effective_at"),
        F.when(exact, "exact").otherwise("date_only").alias("time_precision"), F.coalesce(said("status"), F.lit("scheduled")).alias("schedule_status"), moment(said("published_at")).alias("_published"), F.coalesce(said("country"), fixed("country")).alias("country"),
        F.when(tier.isin(*HIGH), "high").when(tier.isin(*MEDIUM), "medium").otherwise("low").alias("importance_tier"),
        *[x for c in ("actual", "consensus", "previous") for x in (number(said(c)).alias(f"{c}_numeric"), said(c).alias(f"{c}_text"))])
    fine = F.col("event_name").isNotNull() & F.col("effective_at").isNotNull()
    good = one.where(fine).withColumn("published_at", F.coalesce("_published", "effective_at")).drop("_published")
    return good, one.where(~fine).select(*keys, F.col("source_event_key").alias("raw_identifier"), F.lit("missing_title_or_effective_at").alias("reason"))
