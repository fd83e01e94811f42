"""Auction schedules in XML, headline feeds in JSON, RSS and Atom, and tables in markup; what cannot be read is kept apart with a reason."""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapeloom.functions.scalars import bound, single_spaced, squeezed
from tapeloom.sources.payloads import day_of

_CORRUPT = "_unreadable"
_XML = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT, "ignoreNamespace": "true"}

# Names of feeds and what a reject is called.
FEEDS = ("massive_news", "alpaca_news", "alpha_vantage_news")
UNSUPPORTED, UNREADABLE, NO_AUCTIONS = "unsupported_source_name", "parser_failure", "no_treasury_rows_parsed"


def _soft(x: Column) -> Column:
    return F.replace(x, F.lit("\u00a0"), F.lit(" "))


def plain(x: Column) -> Column:
    """Single spaces, no hard ones, none at the ends; null if nothing is left."""
    return squeezed(_soft(x))


def moment(x: Column) -> Column:
    """A time as ISO text, as ``20240105T100000``, or as in mail headers."""
    text = F.regexp_replace(single_spaced(_soft(x)), r"^[A-Za-z]{3},\s*", "")
    return bound(text, lambda t: F.coalesce(F.try_to_timestamp(t), F.try_to_timestamp(t, F.lit("yyyyMMdd'T'HHmmss")), F.try_to_timestamp(t, F.lit("d MMM yyyy HH:mm:ss Z"))))


def auctions(batches: DataFrame, payload: str, keys: list[str], ingested_at: Column, zone: str = "America/New_York") -> tuple[DataFrame, DataFrame]:
    """Scheduled auctions of XML payloads, and the payloads without any.

    Events: ``keys, position, source_event_key, event_name, effective_at,
    published_at, schedule_status, summary``. An auction has a security type and
    a date, each by either of two names; others are skipped. The key is the
    cusip, else type and date; the moment is 11:30 of the day in ``zone``, as
    UTC. Names are read without their name spaces. A payload that is no XML, or
    has no auction in it, gives one reject ``keys, reason, preview``.
    """
    names = ("cusip", "securityType", "type", "auctionDate", "auction_date", "announcementType", "operationStatus")
    schema = f"struct<auction:array<struct<{', '.join(f'{n}:string' for n in names)}>>,{_CORRUPT}:string>"
    # the payload is named once in what follows, so that it is parsed once: also by a filter that is pushed down to it
    listed = bound(F.from_xml(F.col(payload), schema, _XML), lambda r: F.when(r[_CORRUPT].isNull(), r["auction"]))
    told = F.transform(listed, lambda a: F.struct(
        single_spaced(_soft(F.coalesce(F.nullif(a["securityType"], F.lit("")), a["type"]))).alias("kind"), day_of(F.coalesce(F.nullif(a["auctionDate"], F.lit("")), a["auction_date"])).alias("day"),
        *[a[n].alias(n) for n in ("cusip", "announcementType", "operationStatus")]))
    usable = F.filter(told, lambda a: (a["kind"] != "") & a["day"].isNotNull())
    rows = batches.select(*keys, ingested_at.alias("_ingested"), F.posexplode(usable).alias("position", "_a"))
    a = F.col("_a")
    rows = rows.select(*keys, "_ingested", "position", "_a", a["kind"].alias("_kind"), a["day"].alias("_day"))
    events = rows.select(
        *keys, "position", F.coalesce(plain(a["cusip"]), F.concat_ws(":", "_kind", F.date_format("_day", "yyyy-MM-dd"))).alias("source_event_key"),
        F.concat(F.lit("U.S. Treasury "), "_kind", F.lit(" auction")).alias("event_name"),
        F.to_utc_timestamp(F.col("_day").cast("timestamp") + F.expr("interval 11 hours 30 minutes"), zone).alias("effective_at"),
        F.col("_day").alias("published_at"), F.when(F.col("_day") >= F.to_date("_ingested"), "scheduled").otherwise("released").alias("schedule_status"),
        F.coalesce(plain(a["announcementType"]), plain(a["operationStatus"])).alias("summary"),
    )
    rejects = batches.where(F.coalesce(F.size(usable), F.lit(0)) < 1).select(*keys, F.lit(NO_AUCTIONS).alias("reason"), F.substring(payload, 1, 200).alias("preview"))
    return events, rejects


_JSON_ITEM = ", ".join(
    [f"{n}:string" for n in ("benzinga_id", "id", "title", "headline", "teaser", "summary", "url", "author", "authors", "published", "last_updated", "created_at", "updated_at", "time_published")]
    + [f"{n}:array<string>" for n in ("tags", "tickers", "channels", "symbols")] + ["topics:array<struct<topic:string>>", "ticker_sentiment:array<struct<ticker:string>>"]
)
_HEADLINE = ("source_item_id", "headline", "summary", "url", "author", "published_at", "source_updated_at", "tags", "tickers", "channels")


def _distinct_texts(x: Column) -> Column:
    return F.coalesce(F.array_distinct(F.filter(F.transform(x, lambda v: single_spaced(_soft(v))), lambda v: v != "")), F.array().cast("array<string>"))


def feed_headlines(batches: DataFrame, source: str, payload: str, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """Headlines of three JSON feeds in one pass, and the batches that no feed is known for or that cannot be read.

    Headlines: ``keys, source_name, position`` and the fields of one layout,
    whatever a feed calls them; an item without a title is skipped, one without
    an id is known by its title (or address). Rejects: ``keys, source_name,
    reason, preview``.
    """
    name = plain(F.col(source))
    shape = f"struct<results:array<struct<{_JSON_ITEM}>>, news:array<struct<{_JSON_ITEM}>>, feed:array<struct<{_JSON_ITEM}>>, {_CORRUPT}:string>"
    one = batches.select(*keys, F.coalesce(name, F.lit("unknown")).alias("source_name"), F.col(payload).alias("_payload"))
    known, massive, alpaca, read = F.col("source_name").isin(*FEEDS), FEEDS[0], FEEDS[1], F.from_json(F.col("_payload"), shape, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT})

    def items(r: Column) -> Column:
        by_source = F.when(F.col("source_name") == massive, r["results"]).when(F.col("source_name") == alpaca, F.coalesce(r["news"], r["results"])).otherwise(r["feed"])
        return F.when(r[_CORRUPT].isNull(), by_source)

    # no filter asks whether the payload can be read, as that would parse it again: what cannot has no items
    rows = one.where(known).select(*keys, "source_name", F.posexplode(bound(read, items)).alias("position", "r"))

    def by_feed(a: Column, b: Column, c: Column) -> Column:
        return F.when(F.col("source_name") == massive, a).when(F.col("source_name") == alpaca, b).otherwise(c)

    r = lambda n: F.col(f"r.{n}")
    topics, none = F.transform(r("topics"), lambda t: t["topic"]), F.array().cast("array<string>")
    title = plain(by_feed(r("title"), r("headline"), r("title")))
    fields = (
        plain(F.coalesce(by_feed(F.coalesce(F.nullif(r("benzinga_id"), F.lit("")), F.nullif(r("id"), F.lit(""))), F.nullif(r("id"), F.lit("")), F.nullif(r("url"), F.lit(""))), title)), title,
        plain(by_feed(r("teaser"), r("summary"), r("summary"))), plain(r("url")), plain(by_feed(r("author"), r("author"), r("authors"))),
        moment(by_feed(r("published"), r("created_at"), r("time_published"))), moment(by_feed(r("last_updated"), r("updated_at"), r("time_published"))),
        _distinct_texts(by_feed(r("tags"), none, topics)), _distinct_texts(by_feed(r("tickers"), r("symbols"), F.transform(r("ticker_sentiment"), lambda t: t["ticker"]))),
        _distinct_texts(by_feed(r("channels"), none, topics)),
    )
    headlines = rows.select(*keys, "source_name", "position", *[f.alias(n) for f, n in zip(fields, _HEADLINE, strict=True)]).where("headline is not null")
    reason = F.when(~known, UNSUPPORTED).when(bound(read, lambda r: r.isNull() | r[_CORRUPT].isNotNull()), UNREADABLE)
    rejects = one.withColumn("_reason", reason).where("_reason is not null").select(*keys, "source_name", F.col("_reason").alias("reason"), F.substring("_payload", 1, 200).alias("preview"))
    return headlines, rejects


_RSS = "channel:struct<item:array<struct<title:string,link:string,guid:string,pubDate:string,description:string,creator:string,category:array<string>>>>"
_ATOM = "entry:array<struct<title:string,id:string,updated:string,published:string,summary:string,link:struct<_href:string>,author:struct<name:string>>>"


def syndicated(batches: DataFrame, payload: str, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """Headlines of RSS and Atom texts, whatever their name spaces: ``keys, position, source_item_id, headline, summary, url, author, published_at, source_updated_at``; and the texts that are neither."""
    read = F.from_xml(F.col(payload), f"struct<{_RSS},{_ATOM},{_CORRUPT}:string>", _XML | {"attributePrefix": "_", "valueTag": "_text"})
    one = batches.select(*keys, F.col(payload).alias("_payload"), F.when(read[_CORRUPT].isNull(), read).alias("_read"))
    rss = F.transform("_read.channel.item", lambda i: F.struct(
        plain(F.coalesce(i["guid"], i["link"], i["title"])).alias("source_item_id"), plain(i["title"]).alias("headline"), plain(i["description"]).alias("summary"),
        plain(i["link"]).alias("url"), plain(i["creator"]).alias("author"), i["pubDate"].alias("published"), i["pubDate"].alias("updated")))
    atom = F.transform("_read.entry", lambda e: F.struct(
        plain(F.coalesce(e["id"], e["title"])).alias("source_item_id"), plain(e["title"]).alias("headline"), plain(e["summary"]).alias("summary"),
        plain(e["link"]["_href"]).alias("url"), plain(e["author"]["name"]).alias("author"), F.coalesce(e["published"], e["updated"]).alias("published"), e["updated"].alias("updated")))
    one = one.withColumn("_items", F.coalesce(rss, atom))
    rows = one.select(*keys, F.posexplode("_items").alias("position", "r")).where("r.headline is not null")
    headlines = rows.select(*keys, "position", *[f"r.{n}" for n in ("source_item_id", "headline", "summary", "url", "author")], moment(F.col("r.published")).alias("published_at"), moment(F.col("r.updated")).alias("source_updated_at"))
    rejects = one.where("_items is null").select(*keys, F.lit(UNREADABLE).alias("reason"), F.substring("_payload", 1, 200).alias("preview"))
    return headlines, rejects


class _Grid:
    """One table: cells by row and column, each held free for those that span into it."""

    def __init__(self, number: int):
        self.number, self.row, self.cells, self.taken = number, -1, [], {}
        self.open: list | None = None

    def new_row(self) -> None:
        self.close_cell()
        self.row += 1
        self.at = 0

    def new_cell(self, header: bool, rows: int, columns: int) -> None:
        self.close_cell()
        if self.row < 0:
            self.new_row()
        while self.taken.get(self.at, -1) >= self.row:
            self.at += 1
        self.open = [self.row, self.at, rows, columns, header, []]
        for c in range(self.at, self.at + columns):
            self.taken[c] = max(self.taken.get(c, -1), self.row + rows - 1)
        self.at += columns

    def close_cell(self) -> None:
        if self.open is not None:
            self.cells.append((*self.open[:5], " ".join("".join(self.open[5]).split())))
            self.open = None


class _Tables(HTMLParser):
    """Tables in their order of appearance; what stands in an inner table belongs to that one only."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.stack: list[_Grid] = []
        self.found: list[_Grid] = []
        self.silent = 0

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in ("script", "style"):
            self.silent += 1
        if tag == "table":
            self.found.append(_Grid(len(self.found)))
            self.stack.append(self.found[-1])
        elif self.stack and tag == "tr":
            self.stack[-1].new_row()
        elif self.stack and tag in ("td", "th"):
            spans = dict(attrs)
            self.stack[-1].new_cell(tag == "th", _span(spans.get("rowspan")), _span(spans.get("colspan")))
        elif tag in ("br", "p", "div", "li"):
            self.handle_data(" ")

    def handle_endtag(self, tag: str) -> None:
        if tag in ("script", "style"):
            self.silent = max(0, self.silent - 1)
        if self.stack and tag in ("td", "th", "tr"):
            self.stack[-1].close_cell()
        elif self.stack and tag == "table":
            self.stack.pop().close_cell()

    def handle_data(self, data: str) -> None:
        if self.stack and self.stack[-1].open is not None and not self.silent:
            self.stack[-1].open[5].append(data)


def _span(x: str | None, most: int = 1000) -> int:
    """A span as browsers read it: at least 1, at most 1000; what is no number is 1."""
    digits = (x or "").strip()
    return min(max(int(digits), 1), most) if digits.isascii() and digits.isdigit() else 1


def markup_tables(df: DataFrame, key: str, html: str) -> DataFrame:
    """Cells of all tables in markup: ``key, table_no, row_no, column_no, row_span, column_span, is_header, text``.

    A cell stands where the spans of earlier cells leave room, as browsers lay
    it out; an inner table is a table of its own and no part of the cell around
    it. Rows, cells and tables may lack their end tags. Numbers count from 0.
    Pages are read whole, in Arrow batches; null markup gives no cells.
    """
    kind = df.schema[key].dataType.simpleString()
    names = ["table_no", "row_no", "column_no", "row_span", "column_span", "is_header", "text"]
    kinds = [*[pa.int32()] * 5, pa.bool_(), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for one in range(batch.num_rows):
                page = _Tables()
                page.feed(batch.column(1)[one].as_py() or "")
                page.close()
                for grid in page.found:
                    grid.close_cell()
                cells = [(g.number, *c) for g in page.found for c in g.cells]
                if cells:
                    columns = [pa.array(c, t) for c, t in zip(zip(*cells, strict=True), kinds, strict=True)]
                    keys = batch.column(0).take(pa.array([one] * len(cells)))
                    yield pa.RecordBatch.from_arrays([keys, *columns], names=[key, *names])

    schema = f"`{key}` {kind}, table_no int, row_no int, column_no int, row_span int, column_span int, is_header boolean, text string"
    return df.select(key, F.col(html).cast("string").alias(html)).mapInArrow(run, schema)
