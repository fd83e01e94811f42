"""Catalyst payloads made of the input tables and read back: auctions in XML, headline feeds, RSS and Atom, tables in markup."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeloom.functions import macro
from tapeloom.operators import catalysts as operators
from tapeloom.operators import ranking
from tapeloom.plans.fixtures import BD, daily_bars
from tapeloom.session import stored, table
from tapeloom.sources import catalysts

FETCHED = "1997-01-01 00:00:00"


def _listed(df: DataFrame, keys: list[str], order: list[str], text: Column) -> DataFrame:
    """The rows' texts of each key behind each other, in order."""
    lists = df.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct(*order, text.alias("_t")))).alias("_l"))
    return lists.select(*keys, F.array_join(F.transform("_l", lambda x: x["_t"]), "").alias("text"))


def _tag(name: str, x: Column) -> Column:
    return F.concat(F.lit(f"<{name}>"), x, F.lit(f"</{name}>"))


def _auction_batches(spark: SparkSession, d: str) -> DataFrame:
    """Each customer's orders as an auction schedule in XML, some with name spaces, some cut off."""
    o = table(spark, d, "orders")
    k, day = F.col("o_orderkey"), F.when(F.col("o_orderkey") % 7 == 0, "soon").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    kind = F.when(k % 11 == 0, " ").otherwise(F.concat(F.lit(" "), "o_orderpriority"))
    item = F.concat(
        F.lit("<auction>"), F.when(k % 4 == 0, _tag("cusip", F.concat(F.lit("C"), k.cast("string")))).otherwise("<cusip/>"),
        F.when(k % 2 == 0, _tag("securityType", kind)).otherwise(_tag("type", kind)), F.when(k % 3 == 0, _tag("auctionDate", day)).otherwise(_tag("auction_date", day)),
        F.when(k % 2 == 0, F.lit("<announcementType>A &amp; B</announcementType>")).otherwise("<operationStatus> is  open </operationStatus>"), F.lit("</auction>"),
    )
    texts = _listed(o, ["o_custkey"], ["o_orderkey", "o_totalprice"], item)
    c = F.col("o_custkey")
    spaced = F.regexp_replace(F.concat(F.lit("<list xmlns:t='urn:x'>"), "text", F.lit("</list>")), r"<(/?)(\w+)(?=[ />])", "<$1t:$2")
    whole = F.when(c % 2 == 0, F.concat(F.lit("<list>"), "text", F.lit("</list>"))).otherwise(spaced)
    return texts.withColumn("whole", whole).select("o_custkey", F.when(c % 13 == 0, F.expr("substring(whole, 1, length(whole) - 12)")).otherwise(F.col("whole")).alias("payload"))


def auction_xml(spark: SparkSession, d: str) -> DataFrame:
    """customers' auction schedules in XML; events, and payloads without any."""
    events, rejects = catalysts.auctions(_auction_batches(spark, d), "payload", ["o_custkey"], F.lit(FETCHED).cast("timestamp"))
    return events.withColumn("reason", F.lit(None).cast("string")).unionByName(rejects.drop("preview"), allowMissingColumns=True)


AUCTIONS = f"""
WITH o AS (
  SELECT o_custkey, o_orderkey, o_totalprice, o_orderdate::DATE AS day, o_orderpriority AS kind, o_orderkey % 11 <> 0 AND o_orderkey % 7 <> 0 AND o_custkey % 13 <> 0 AS usable FROM orders
)
SELECT o_custkey, (row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey, o_totalprice) - 1)::INTEGER AS position,
  CASE WHEN o_orderkey % 4 = 0 THEN 'C' || o_orderkey ELSE kind || ':' || day END AS source_event_key, 'U.S. Treasury ' || kind || ' auction' AS event_name,
  ((day + INTERVAL 690 MINUTE) AT TIME ZONE 'America/New_York') AT TIME ZONE 'UTC' AS effective_at, day AS published_at,
  CASE WHEN day >= DATE '1997-01-01' THEN 'scheduled' ELSE 'released' END AS schedule_status, CASE WHEN o_orderkey % 2 = 0 THEN 'A & B' ELSE 'is open' END AS summary, NULL::VARCHAR AS reason
FROM o WHERE usable
UNION ALL SELECT o_custkey, NULL, NULL, NULL, NULL, NULL, NULL, NULL, 'no_treasury_rows_parsed' FROM o GROUP BY o_custkey HAVING NOT bool_or(usable)"""


def _event_batches(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp")).withColumn("day", F.to_date("ts"))


def _feed_batches(spark: SparkSession, d: str) -> DataFrame:
    """Each user's events of a day as a batch of one of three JSON feeds, of one that nobody knows, or cut off."""
    e, u = _event_batches(spark, d), F.col("user_id") % 4
    title = F.when(F.col("event_id") % 10 == 0, " ").otherwise(F.concat(F.lit(" Event  "), "event_type", F.lit("  "), F.col("event_id").cast("string")))
    name, key = F.concat(F.lit("U"), F.col("user_id").cast("string")), F.col("event_id").cast("string")
    iso, packed = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"), F.date_format("ts", "yyyyMMdd'T'HHmmss")
    massive = F.to_json(F.struct(F.when(F.col("event_id") % 3 == 0, key).alias("benzinga_id"), F.concat(F.lit("i"), key).alias("id"), title.alias("title"), F.col("event_type").alias("teaser"), iso.alias("published"),
                                 iso.alias("last_updated"), F.array(F.lit(" a  b "), F.lit("a b"), F.lit("")).alias("tags"), F.array(name, name).alias("tickers"), F.array(F.lit("News")).alias("channels")))
    alpaca = F.to_json(F.struct(key.cast("long").alias("id"), title.alias("headline"), F.col("event_type").alias("summary"), iso.alias("created_at"), iso.alias("updated_at"), F.array(name).alias("symbols")))
    vantage = F.to_json(F.struct(title.alias("title"), F.concat(F.lit("u/"), key).alias("url"), F.col("event_type").alias("summary"), packed.alias("time_published"), F.array(F.struct(F.lit("Tech").alias("topic"))).alias("topics"),
                                 F.array(F.struct(name.alias("ticker"))).alias("ticker_sentiment")))
    lists = _listed(e, ["user_id", "day"], ["event_id"], F.concat(F.lit(","), F.when(u == 0, massive).when(u == 1, alpaca).otherwise(vantage)))
    path = F.when(u == 0, "results").when(u == 1, "news").otherwise("feed")
    whole = F.concat(F.lit('{"'), path, F.lit('":['), F.expr("substring(text, 2)"), F.lit("]}"))
    source = F.when(u == 0, " massive_news").when(u == 1, "alpaca_news").when(u == 2, "alpha_vantage_news").otherwise("other")
    return lists.select("user_id", "day", source.alias("source"), whole.alias("whole")).withColumn("payload", F.when((F.col("user_id") % 7 == 3) & (F.dayofmonth("day") % 2 == 1), F.expr("substring(whole, 1, length(whole) - 3)")).otherwise(F.col("whole")))


def headline_feeds(spark: SparkSession, d: str) -> DataFrame:
    """users' batches of three JSON feeds; headlines and rejects."""
    good, bad = catalysts.feed_headlines(_feed_batches(spark, d), "source", "payload", ["user_id", "day"])
    good = good.select("*", *[F.array_join(c, ",").alias(f"_{c}") for c in ("tags", "tickers", "channels")]).drop("tags", "tickers", "channels").withColumnsRenamed({f"_{c}": c for c in ("tags", "tickers", "channels")})
    return good.withColumn("reason", F.lit(None).cast("string")).unionByName(bad.drop("preview"), allowMissingColumns=True)


FEEDS = """
WITH e AS (
  SELECT *, ts::DATE AS day, user_id % 4 AS u, date_trunc('second', ts) AS moment, row_number() OVER (PARTITION BY user_id, ts::DATE ORDER BY event_id) - 1 AS i, user_id % 7 = 3 AND day(ts) % 2 = 1 AS cut FROM events
)
SELECT user_id, day, ['massive_news', 'alpaca_news', 'alpha_vantage_news'][u + 1] AS source_name, i::INTEGER AS position,
  CASE WHEN u = 0 AND event_id % 3 = 0 OR u = 1 THEN event_id::VARCHAR WHEN u = 0 THEN 'i' || event_id ELSE 'u/' || event_id END AS source_item_id, 'Event ' || event_type || ' ' || event_id AS headline, event_type AS summary,
  CASE WHEN u = 2 THEN 'u/' || event_id END AS url, NULL::VARCHAR AS author, moment AS published_at, moment AS source_updated_at, CASE u WHEN 0 THEN 'a b' WHEN 1 THEN '' ELSE 'Tech' END AS tags, 'U' || user_id AS tickers,
  CASE u WHEN 0 THEN 'News' WHEN 1 THEN '' ELSE 'Tech' END AS channels, NULL::VARCHAR AS reason
FROM e WHERE u < 3 AND NOT cut AND event_id % 10 <> 0
UNION ALL SELECT DISTINCT user_id, day, CASE u WHEN 0 THEN 'massive_news' WHEN 1 THEN 'alpaca_news' WHEN 2 THEN 'alpha_vantage_news' ELSE 'other' END, NULL::INTEGER, NULL, NULL, NULL, NULL, NULL, NULL::TIMESTAMP, NULL::TIMESTAMP, NULL, NULL, NULL,
  CASE WHEN u = 3 THEN 'unsupported_source_name' ELSE 'parser_failure' END FROM e WHERE u = 3 OR cut"""


def syndicated_feeds(spark: SparkSession, d: str) -> DataFrame:
    """Each user's events of a day as RSS or Atom with name spaces; headlines, and texts that are neither."""
    e, even = _event_batches(spark, d), F.col("user_id") % 2 == 0
    key, title = F.col("event_id").cast("string"), F.concat(F.lit(" Event &lt;"), "event_type", F.lit("&gt; "), F.col("event_id").cast("string"))
    rss = F.concat(F.lit("<item>"), _tag("title", title), F.when(F.col("event_id") % 2 == 0, _tag("guid", key)).otherwise(""), _tag("link", F.concat(F.lit("l/"), key)),
                   _tag("pubDate", F.date_format("ts", "EEE, d MMM yyyy HH:mm:ss Z")), _tag("dc:creator", F.col("event_type")), F.lit("</item>"))
    atom = F.concat(F.lit("<a:entry>"), _tag("a:title", title), _tag("a:id", key), F.lit('<a:link href="l/'), key, F.lit('"/>'), _tag("a:updated", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")),
                    F.lit("<a:author><a:name>me</a:name></a:author>"), _tag("a:summary", F.col("event_type")), F.lit("</a:entry>"))
    lists = _listed(e, ["user_id", "day"], ["event_id"], F.when(even, rss).otherwise(atom))
    whole = F.when(even, F.concat(F.lit('<rss version="2.0" xmlns:dc="urn:dc"><channel><title>t</title>'), "text", F.lit("</channel></rss>"))).otherwise(F.concat(F.lit('<a:feed xmlns:a="urn:atom">'), "text", F.lit("</a:feed>")))
    u = F.col("user_id") % 7
    batches = lists.select("user_id", "day", whole.alias("whole")).withColumn("payload", F.when(u == 3, F.expr("substring(whole, 1, length(whole) - 5)")).when(u == 4, "no markup").otherwise(F.col("whole")))
    good, bad = catalysts.syndicated(batches, "payload", ["user_id", "day"])
    return good.withColumn("reason", F.lit(None).cast("string")).unionByName(bad.drop("preview"), allowMissingColumns=True)


SYNDICATED = """
WITH e AS (SELECT *, ts::DATE AS day, user_id % 2 = 0 AS rss, date_trunc('second', ts) AS moment, row_number() OVER (PARTITION BY user_id, ts::DATE ORDER BY event_id) - 1 AS i, user_id % 7 IN (3, 4) AS bad FROM events)
SELECT user_id, day, i::INTEGER AS position, CASE WHEN rss AND event_id % 2 = 1 THEN 'l/' || event_id ELSE event_id::VARCHAR END AS source_item_id, 'Event <' || event_type || '> ' || event_id AS headline,
  CASE WHEN NOT rss THEN event_type END AS summary, 'l/' || event_id AS url, CASE WHEN rss THEN event_type ELSE 'me' END AS author, moment AS published_at, moment AS source_updated_at, NULL::VARCHAR AS reason FROM e WHERE NOT bad
UNION ALL SELECT DISTINCT user_id, day, NULL::INTEGER, NULL, NULL, NULL, NULL, NULL, NULL::TIMESTAMP, NULL::TIMESTAMP, 'parser_failure' FROM e WHERE bad"""


def html_tables(spark: SparkSession, d: str) -> DataFrame:
    """Each customer's orders as a table in markup with spans and missing end tags, and the tables of all pages; every cell in its place."""
    o = table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_totalprice", "o_orderstatus")
    lists = o.groupBy("o_custkey").agg(F.array_sort(F.collect_list(F.struct("o_orderkey", "o_totalprice", "o_orderstatus"))).alias("l"))

    def row(x: Column, i: Column) -> Column:
        key, price, status = x["o_orderkey"].cast("string"), x["o_totalprice"].cast("string"), x["o_orderstatus"]
        first = F.concat(F.lit("<TR><td rowspan='2'>"), key, F.lit("</td><td><b>"), price, F.lit("</b> &amp;<td> "), status)
        second = F.concat(F.lit("<tr><td>"), price, F.lit("</td><td><table><tr><td>"), status, F.lit("</table></td></tr>"))
        return F.when(i % 3 == 0, first).when(i % 3 == 1, second).otherwise(F.concat(F.lit("<tr><td>"), key, F.lit("</td><td colspan=2>"), price, F.lit("</td></tr>")))

    head = F.lit("<p>x</p><table><thead><tr><th>order</th><th colspan=\"2\">value<br>of it</th></tr></thead><tbody>")
    markup = lists.select(F.col("o_custkey").alias("page_id"), F.concat(head, F.array_join(F.transform("l", row), "\n"), F.lit("</table>")).alias("html"))
    pages = table(spark, d, "pages").select((-F.col("page_id") - 1).alias("page_id"), "html")
    return catalysts.markup_tables(markup.unionByName(pages), "page_id", "html")


TABLES = """
WITH o AS (SELECT o_custkey AS page_id, o_orderkey::VARCHAR AS k, o_totalprice::VARCHAR AS p, o_orderstatus AS s, (row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey, o_totalprice, o_orderstatus) - 1)::INTEGER AS i FROM orders),
c AS (
  SELECT DISTINCT page_id, 0 AS table_no, 0 AS row_no, 0 AS column_no, 1 AS row_span, 1 AS column_span, true AS is_header, 'order' AS text FROM o
  UNION ALL SELECT DISTINCT page_id, 0, 0, 1, 1, 2, true, 'value of it' FROM o
  UNION ALL SELECT page_id, 0, i + 1, 0, CASE WHEN i % 3 = 0 THEN 2 ELSE 1 END, 1, false, k FROM o WHERE i % 3 <> 1
  UNION ALL SELECT page_id, 0, i + 1, 1, 1, CASE WHEN i % 3 = 2 THEN 2 ELSE 1 END, false, CASE WHEN i % 3 = 0 THEN p || ' &' ELSE p END FROM o
  UNION ALL SELECT page_id, 0, i + 1, 2, 1, 1, false, CASE WHEN i % 3 = 0 THEN s ELSE '' END FROM o WHERE i % 3 <> 2
  UNION ALL SELECT page_id, i // 3 + 1, 0, 0, 1, 1, false, s FROM o WHERE i % 3 = 1
)
SELECT page_id, table_no::INTEGER AS table_no, row_no::INTEGER AS row_no, column_no::INTEGER AS column_no, row_span::INTEGER AS row_span, column_span::INTEGER AS column_span, is_header, text FROM c"""


_FEED_NAMES = ("massive_news", "alpaca_news", "alpha_vantage_news", "elsewhere")


def headline_versions(spark: SparkSession, d: str) -> DataFrame:
    """U16: five events each as observations of one headline by four feeds: published, edited, corrected and withdrawn."""
    e = table(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    k = F.get_json_object("props", "$.k").cast("int")
    text = F.element_at(F.array(F.lit("CPI release"), F.lit(" "), F.lit("CPI release, revised"), F.lit(None).cast("string"), F.lit("CPI release")), (k % 5 + 1).cast("int"))
    rows = e.select(
        F.concat(F.lit("H"), F.expr("event_id div 5").cast("string")).alias("headline_id"), F.col("ts").alias("observed_at"), F.col("event_id").alias("source_item_id"),
        F.element_at(F.array(*map(F.lit, _FEED_NAMES)), (F.pmod("user_id", F.lit(4)) + 1).cast("int")).alias("source_name"), text.alias("headline"), F.when(k % 3 == 0, F.col("event_type")).alias("summary"),
        F.lit(None).cast("string").alias("url"), F.when(k % 7 == 0, "").otherwise("me").alias("author"), F.when(k % 2 == 0, F.concat(F.lit("U"), F.col("user_id").cast("string"))).alias("tickers"),
        F.timestamp_micros(F.unix_micros("ts") - k.cast("long") * 60_000_000).alias("published_at"), F.when(k % 11 != 0, F.col("ts")).alias("source_updated_at"), (k >= 90).alias("withdrawn"))
    return operators.headline_versions(rows)


def _versions_sql() -> str:
    word = "{'at': ts, 'w': k >= 90, 'p': p, 'u': CASE WHEN k % 11 <> 0 THEN ts END, 'h': nullif(trim(h), ''), 's': CASE WHEN k % 3 = 0 THEN event_type END, 'a': CASE WHEN k % 7 <> 0 THEN 'me' END, 't': CASE WHEN k % 2 = 0 THEN 'U' || user_id END}"
    over = "OVER (PARTITION BY id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    words = [f"w{i}" for i in range(4)]
    return f"""
WITH e AS (SELECT *, (props::JSON ->> 'k')::INTEGER AS k FROM events),
r AS (SELECT *, 'H' || (event_id // 5) AS id, ts - to_minutes(k) AS p, ['CPI release', ' ', 'CPI release, revised', NULL, 'CPI release'][k % 5 + 1] AS h FROM e),
l AS (SELECT *, {', '.join(f"last_value(CASE WHEN user_id % 4 = {i} THEN {word} END IGNORE NULLS) {over} AS w{i}" for i in range(4))} FROM r),
n AS (
  SELECT id, ts, event_id, {', '.join(f"coalesce({', '.join(f'{w}.{f}' for w in words)}) AS {f}" for f in 'hsa')},
    list_max(list_filter([{', '.join(f"CASE WHEN {w}.t IS NOT NULL THEN {{'at': {w}.at, 'v': {w}.t}} END" for w in words)}], lambda x: x IS NOT NULL)).v AS t,
    least({', '.join(f'{w}.p' for w in words)}) AS p, greatest({', '.join(f'{w}.u' for w in words)}) AS u, coalesce(greatest({', '.join(f'{w}.w' for w in words)}), false) AS wd FROM l
), s AS (SELECT *, {{'h': h, 's': s, 'a': a, 't': t, 'p': p, 'u': u, 'w': wd}} AS now FROM n),
b AS (SELECT *, lag(now) OVER (PARTITION BY id ORDER BY ts, event_id) AS before, row_number() OVER (PARTITION BY id ORDER BY ts, event_id) AS i FROM s),
c AS (SELECT * FROM b WHERE i = 1 OR now IS DISTINCT FROM before)
SELECT id AS headline_id, row_number() OVER (PARTITION BY id ORDER BY ts, event_id)::INTEGER AS version_seq,
  CASE WHEN i = 1 THEN 'publish' WHEN wd AND NOT before.w THEN 'withdrawal' WHEN h IS DISTINCT FROM before.h OR s IS DISTINCT FROM before.s THEN 'edit' ELSE 'correction' END AS version_kind,
  ts AS version_observed_at, h AS headline, s AS summary, NULL::VARCHAR AS url, a AS author, t AS tickers, p AS published_at, u AS source_updated_at, wd AS withdrawn FROM c"""


def _gold(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Auctions and headlines from their payloads, the newest headline of each id, and days of what they are about.

    Events and headlines are stored: mentions, their parents and every view read them, payloads are made and parsed once.
    """
    auctions, _ = catalysts.auctions(_auction_batches(spark, d), "payload", ["o_custkey"], F.lit(FETCHED).cast("timestamp"))
    auctions, group = auctions.withColumn("event_group", macro.event_group(F.col("event_name"))), F.col("event_group")
    events = auctions.select(
        F.concat_ws("/", F.col("o_custkey").cast("string"), F.col("position").cast("string"), "source_event_key").alias("event_id"), "event_name", F.col("published_at").cast("timestamp").alias("published_at"), "effective_at",
        F.lit("US").alias("country"), F.lit("North America").alias("region"), F.lit("USD").alias("currency"), group, macro.factor_tags(group).alias("factors"),
        (macro.importance(F.col("event_name"), group) == "high").alias("high_impact"), F.when(F.col("summary") == "is open", "revised").otherwise(F.col("schedule_status")).alias("schedule_status"),
        (F.col("position") % 5 == 4).alias("withdrawal_flag"), F.to_date("effective_at").alias("as_of_date"))
    feeds, _ = catalysts.feed_headlines(_feed_batches(spark, d), "source", "payload", ["user_id", "day"])
    rows = feeds.select(F.concat_ws("/", F.col("user_id").cast("string"), "summary").alias("headline_id"), F.col("published_at").alias("observed_at"), F.col("position").alias("source_item_id"), "source_name", "headline", "summary", "url", "author",
                        F.array_join("tickers", ",").alias("tickers"), "published_at", "source_updated_at", F.col("headline").endswith("7").alias("withdrawn"))
    last = operators.current_headlines(operators.headline_versions(rows))
    headlines = last.select("headline_id", "headline", "published_at", F.lit(None).cast("string").alias("country"), F.lit(None).cast("string").alias("region"), F.col("summary").alias("event_group"),
                            F.split("tickers", ",").alias("tickers"), F.col("withdrawn").alias("withdrawal_flag"), F.to_date("published_at").alias("as_of_date"))
    events, headlines = stored(events, "catalyst-events"), stored(headlines, "catalyst-headlines")
    found = operators.mentions(events, headlines).unionByName(spark.createDataFrame([("event", "no such event", "country", "US")], "item_kind string, item_id string, entity_type string, entity_key string"))
    days = operators.entity_days(operators.with_parents(found, events, headlines), F.lit(FETCHED).cast("timestamp"))
    return events, headlines, days


def catalyst_gold(spark: SparkSession, d: str) -> DataFrame:
    """Payloads to events and headline versions to mentions to days of every entity."""
    return _gold(spark, d)[2]


GOLD_ROWS = f"""
o AS (
  SELECT o_custkey, o_orderkey, o_totalprice, o_orderdate::DATE AS day, o_orderpriority AS kind FROM orders WHERE o_orderkey % 11 <> 0 AND o_orderkey % 7 <> 0 AND o_custkey % 13 <> 0
), ev AS (
  SELECT o_custkey || '/' || (row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey, o_totalprice) - 1) || '/' || CASE WHEN o_orderkey % 4 = 0 THEN 'C' || o_orderkey ELSE kind || ':' || day END AS id,
    row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey, o_totalprice) - 1 AS position, 'U.S. Treasury ' || kind || ' auction' AS event_name,
    day::TIMESTAMP AS published_at, ((day + INTERVAL 690 MINUTE) AT TIME ZONE 'America/New_York') AT TIME ZONE 'UTC' AS effective_at,
    CASE WHEN o_orderkey % 2 = 1 THEN 'revised' WHEN day >= DATE '1997-01-01' THEN 'scheduled' ELSE 'released' END AS status FROM o
), f AS (
  SELECT *, date_trunc('second', ts) AS moment, row_number() OVER (PARTITION BY user_id, ts::DATE ORDER BY event_id) - 1 AS i FROM events
), g AS (SELECT * FROM f WHERE user_id % 4 < 3 AND NOT (user_id % 7 = 3 AND day(ts) % 2 = 1) AND event_id % 10 <> 0),
h AS (
  SELECT user_id || '/' || event_type AS id, any_value(event_type) AS grp, any_value(user_id) AS user_id, arg_max(moment, row(moment, i)) AS published_at, arg_max('Event ' || event_type || ' ' || event_id, row(moment, i)) AS headline,
    arg_max(event_id % 10 = 7, row(moment, i)) AS withdrawn FROM g GROUP BY 1
)"""

GOLD = f"""
WITH {GOLD_ROWS},
m AS (
  SELECT 'event' AS kind, id, published_at, effective_at, status, unnest([{{'t': 'country', 'k': 'US'}}, {{'t': 'region', 'k': 'North America'}}, {{'t': 'currency', 'k': 'USD'}}, {{'t': 'indicator', 'k': 'RatesFiscal'}}{''.join(f", {{{{'t': 'factor', 'k': '{x}'}}}}" for x in macro.FACTORS['RatesFiscal'])}]) AS e FROM ev
  UNION ALL SELECT 'headline', id, published_at, published_at, NULL, unnest([{{'t': 'indicator', 'k': grp}}, {{'t': 'symbol', 'k': 'U' || user_id}}]) FROM h
)
SELECT effective_at::DATE AS as_of_date, e.t AS entity_type, e.k AS entity_key, count_if(kind = 'headline')::BIGINT AS headline_count, count_if(kind = 'event')::BIGINT AS event_count, 0::BIGINT AS high_impact_event_count,
  count_if(coalesce(status IN ('released', 'revised'), false))::BIGINT AS release_count, count_if(coalesce(status = 'scheduled', false))::BIGINT AS scheduled_count, 0::BIGINT AS policy_event_count, 0::BIGINT AS inflation_event_count, 0::BIGINT AS labor_event_count,
  0::BIGINT AS growth_event_count, count_if(kind = 'event')::BIGINT AS rates_event_count, max(published_at) AS last_published_at, max(CASE WHEN kind = 'event' THEN effective_at END) AS last_effective_at
FROM m GROUP BY ALL""".replace("{{", "{").replace("}}", "}")


def catalyst_views(spark: SparkSession, d: str) -> DataFrame:
    """Rows of all views by SQL, some between two days by their table functions, and the first 25 symbols of a view in order."""
    events, headlines, days = _gold(spark, d)
    days = stored(days, "catalyst-days")
    register_views = operators.register_views(spark, "v_", events=events, headlines=headlines, entity_daily=days, market_data=daily_bars(spark, d).withColumnRenamed("date", "as_of_date"))
    spans = {"v_economic_catalyst_headlines_by_date": ("2024-01-05", "2024-01-20")}
    parts = []
    for view in register_views:
        first, last = spans.get(view, ("1995-01-01", "1996-06-30"))
        parts += [f"SELECT '{view}' AS source, as_of_date, count(*) AS n FROM {view} GROUP BY as_of_date", f"SELECT '{view}_between', as_of_date, count(*) FROM {view}_between(DATE '{first}', DATE '{last}') GROUP BY as_of_date"]
    sample = ranking.sample_symbols(spark.table("v_economic_catalyst_entity_daily_by_date").where("entity_type = 'symbol'"), "entity_key", 25)
    return spark.sql(" UNION ALL ".join(parts)).unionByName(sample.select(F.col("symbol").alias("source"), F.lit(None).cast("date").alias("as_of_date"), F.col("symbol_count").alias("n")))


def _views_sql() -> str:
    views = {
        "economic_catalyst_calendar_by_date": ("SELECT effective_at::DATE AS d FROM ev WHERE position % 5 <> 4 AND status = 'scheduled'", "1995-01-01", "1996-06-30"),
        "economic_catalyst_releases_by_date": ("SELECT effective_at::DATE AS d FROM ev WHERE position % 5 <> 4 AND status IN ('released', 'revised')", "1995-01-01", "1996-06-30"),
        "economic_catalyst_headlines_by_date": ("SELECT published_at::DATE AS d FROM h WHERE NOT withdrawn", "2024-01-05", "2024-01-20"),
        "economic_catalyst_entity_daily_by_date": ("SELECT as_of_date AS d FROM days", "1995-01-01", "1996-06-30"),
        "market_data_by_date": ("SELECT date AS d FROM bars", "1995-01-01", "1996-06-30"),
    }
    parts = []
    for name, (sql, first, last) in views.items():
        parts += [f"SELECT 'v_{name}' AS source, d AS as_of_date, count(*) AS n FROM ({sql}) GROUP BY d", f"SELECT 'v_{name}_between', d, count(*) FROM ({sql}) WHERE d BETWEEN DATE '{first}' AND DATE '{last}' GROUP BY d"]
    days = GOLD.strip().removeprefix("WITH")
    head, _, tail = days.rpartition("\nSELECT effective_at::DATE")
    return f"WITH {BD}, {head}, days AS (SELECT effective_at::DATE{tail}), s AS (SELECT DISTINCT 'U' || user_id AS y FROM h) " + " UNION ALL ".join(parts) + " UNION ALL (SELECT y, NULL, (SELECT count(*) FROM s) FROM s ORDER BY y LIMIT 25)"


def register_all(register) -> None:
    register("headline_versions", headline_versions, _versions_sql())
    register("catalyst_gold", catalyst_gold, GOLD)
    register("catalyst_views", catalyst_views, _views_sql())
    register("auction_xml", auction_xml, AUCTIONS)
    register("headline_feeds", headline_feeds, FEEDS)
    register("syndicated_feeds", syndicated_feeds, SYNDICATED)
    register("html_tables", html_tables, TABLES)
