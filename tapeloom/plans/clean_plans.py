"""Cleaning, parsing, merging and version queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeloom.functions import scalars as S
from tapeloom.operators import clean, maintain
from tapeloom.plans.fixtures import BW, weekly_bars
from tapeloom.session import table
from tapeloom.sources import payloads


def scalar_texts(spark: SparkSession, d: str) -> DataFrame:
    """F2-F4, F7, F8, F18-F20, F23, F26 on part, page and order texts."""
    p = table(spark, d, "part")
    amount = F.concat(F.lit("$"), F.format_string("%,d", F.col("p_size") * 1000 + 1), F.lit(" - $"), F.format_string("%,d", F.col("p_size") * 2000))
    human = F.concat(F.when(F.col("p_size") % 3 == 0, "(").otherwise(""), F.col("p_size").cast("string"), F.when(F.col("p_size") % 2 == 0, "M").otherwise("K"),
                     F.when(F.col("p_size") % 3 == 0, ")").otherwise(""))
    flag = F.element_at(F.array(F.lit("Yes"), F.lit("off"), F.lit("maybe"), F.lit(" T ")), (F.col("p_size") % 4 + 1).cast("int"))
    return p.select(
        "p_partkey", S.snake_case(F.concat(F.col("p_brand"), F.lit(" isA"), F.initcap("p_type"), F.lit("ATRValue"))).alias("snake"), S.range_middle(amount).alias("middle"),
        S.human_number(human).alias("human"), S.number(F.when(F.col("p_size") % 5 == 0, "n/a").otherwise(F.concat(F.col("p_size"), F.lit(",000")))).alias("num"),
        S.truth(flag).alias("truth"), S.clean_key(F.concat(F.lit("Net % of $ "), F.col("p_type"))).alias("clean"), F.size(S.listed(F.concat_ws(", ", "p_name", "p_brand", F.lit("")))).alias("n_listed"),
        S.real_text(F.when(F.col("p_size") % 7 == 0, " TBD ").otherwise(F.col("p_name"))).alias("real"),
        S.share_class(F.when(F.col("p_size") % 2 == 0, F.concat(F.col("p_name"), F.lit(" Class b"))).otherwise(F.col("p_name")), F.lit("ABC.A")).alias("class_"),
        S.market_code(F.when(F.col("p_size") % 2 == 0, "nasdaq ").otherwise("OTC")).alias("mic"),
        S.periods_per_year(F.concat(F.col("p_size"), F.element_at(F.array(*[F.lit(x) for x in ("m", "h", "d", "w")]), (F.col("p_size") % 4 + 1).cast("int")))).alias("ppy"),
        S.band_state(F.col("p_retailprice") - 950, 25.0, ("inverted", "flat", "steep")).alias("state"),
    )


SCALARS = r"""
SELECT p_partkey, lower(regexp_replace(regexp_replace(regexp_replace(regexp_replace(p_brand || ' isA' || upper(p_type[1]) || lower(p_type[2:]) || 'ATRValue', '(.)([A-Z][a-z]+)', '\1_\2', 'g'),
    '([a-z0-9])([A-Z])', '\1_\2', 'g'), '[^0-9A-Za-z]+', '_', 'g'), '^_+|_+$', '', 'g').regexp_replace('_+', '_', 'g')) AS snake,
  ((p_size * 1000 + 1) + p_size * 2000) / 2.0::DOUBLE AS middle, (CASE WHEN p_size % 3 = 0 THEN -1 ELSE 1 END) * p_size::DOUBLE * (CASE WHEN p_size % 2 = 0 THEN 1e6 ELSE 1e3 END) AS human,
  CASE WHEN p_size % 5 <> 0 THEN p_size * 1000.0::DOUBLE END AS num, CASE p_size % 4 WHEN 0 THEN true WHEN 1 THEN false WHEN 3 THEN true END AS truth,
  'net_pct_of_usd_' || lower(regexp_replace(p_type, '[^0-9A-Za-z]+', '_', 'g')) AS clean, 2 AS n_listed, CASE WHEN p_size % 7 <> 0 THEN trim(p_name) END AS real,
  CASE WHEN p_size % 2 = 0 THEN 'Class B' ELSE 'Class A' END AS class_, CASE WHEN p_size % 2 = 0 THEN 'XNAS' ELSE 'OTCM' END AS mic,
  CASE p_size % 4 WHEN 0 THEN 252 * 390 / p_size::DOUBLE WHEN 1 THEN 252 * 6.5::DOUBLE / p_size WHEN 2 THEN 252 / p_size::DOUBLE ELSE 52 / p_size::DOUBLE END AS ppy,
  CASE WHEN p_retailprice - 950 < -25 THEN 'inverted' WHEN p_retailprice - 950 > 25 THEN 'steep' ELSE 'flat' END AS state FROM part"""


def events_json(spark: SparkSession, d: str) -> DataFrame:
    """Payloads parsed, epochs read, hashed, deduplicated; odd ones rejected with a reason."""
    e = table(spark, d, "events").select("event_id", F.from_json("props", "k int")["k"].alias("k"), "props", F.unix_millis(F.col("ts").cast("timestamp")).cast("string").alias("epoch"))
    good, bad = payloads.split_rejects(e, {"missing_k": F.col("k").isNull(), "k_too_small": F.col("k") < 10}, F.col("event_id"), F.col("props"))
    good = clean.last_per_key(good, ["k"], F.desc("event_id")).select(
        F.lit("good").alias("kind"), F.col("event_id").cast("string").alias("identifier"), F.date_format(S.flexible_time(F.col("epoch")), "yyyy-MM-dd HH:mm:ss").alias("detail"))
    return good.unionByName(bad.select(F.lit("reject").alias("kind"), "identifier", F.concat_ws(" ", "reason", "preview").alias("detail")))


EVENTS_JSON = """
WITH e AS (SELECT *, json_extract(props, '$.k')::INTEGER AS k FROM events), g AS (
  SELECT *, row_number() OVER (PARTITION BY k ORDER BY event_id DESC) AS r FROM e WHERE k >= 10
)
SELECT 'good' AS kind, event_id::VARCHAR AS identifier, strftime(ts, '%Y-%m-%d %H:%M:%S') AS detail FROM g WHERE r = 1
UNION ALL SELECT 'reject', event_id::VARCHAR, CASE WHEN k IS NULL THEN 'missing_k ' ELSE 'k_too_small ' END || substr(props, 1, 200) FROM e WHERE k IS NULL OR k < 10"""


def page_links(spark: SparkSession, d: str) -> DataFrame:
    """S17 (markup branch), F18: links of every page."""
    return payloads.markup_links(table(spark, d, "pages").select("page_id", "html"), "html")


PAGE_LINKS = r"""
WITH l AS (SELECT page_id, regexp_extract_all(html, '(?s)<a\s[^>]*href="[^"]*"[^>]*>.*?</a>') AS a FROM pages),
u AS (SELECT page_id, unnest(a) AS x, unnest(range(len(a)))::INTEGER AS position FROM l)
SELECT page_id, position, regexp_extract(x, 'href="([^"]*)"', 1) AS target,
  trim(regexp_replace(replace(replace(regexp_replace(x, '<[^>]+>', ' ', 'g'), '&nbsp;', ' '), '&amp;', '&'), '\s+', ' ', 'g')) AS label FROM u"""


def csv_bars(spark: SparkSession, d: str) -> DataFrame:
    """Bars through CSV lines and back, lines without a date dropped."""
    b = weekly_bars(spark, d)
    line = F.concat_ws(",", F.when(F.weekofyear("date") % 10 == 0, "never").otherwise(F.col("date").cast("string")), "open", "high", "low", "close", F.when(F.col("volume") > 100, F.col("volume").cast("string")).otherwise("na"))
    return payloads.bars_from_csv(b.select("symbol", line.alias("value")))


CSV_BARS = f"""
WITH {BW} SELECT symbol, date, open, high, low, close, CASE WHEN volume > 100 THEN volume ELSE 0.0 END AS volume FROM bars WHERE week(date) % 10 <> 0"""


def rule_universe(spark: SparkSession, d: str) -> DataFrame:
    """Two nested rules over parts, both and either."""
    kinds = {"p_size": "number", "p_retailprice": "number", "p_brand": "string", "p_type": "string"}
    a = clean.rule({"and": [{"field": "p_size", "op": "gte", "value": 10}, {"or": [{"field": "p_type", "op": "in", "values": ["ECONOMY", "PROMO"]}, {"field": "p_retailprice", "op": "lt", "value": 950.0}]}]}, kinds)
    b = clean.rule({"or": [{"field": "p_brand", "op": "ne", "value": "Brand#2"}, {"field": "p_size", "op": "is_null"}]}, kinds)
    return table(spark, d, "part").where(a | b).select("p_partkey", a.alias("first"), b.alias("second"), (a & b).alias("both"))


RULES = """
SELECT * FROM (SELECT p_partkey, p_size >= 10 AND (p_type IN ('ECONOMY', 'PROMO') OR p_retailprice < 950) AS first, p_brand <> 'Brand#2' OR p_size IS NULL AS second,
  (p_size >= 10 AND (p_type IN ('ECONOMY', 'PROMO') OR p_retailprice < 950)) AND (p_brand <> 'Brand#2' OR p_size IS NULL) AS both FROM part) WHERE first OR second"""


def purge_top(spark: SparkSession, d: str) -> DataFrame:
    """Customers in the top five percent of balances, and all below zero."""
    c = table(spark, d, "customer").select("c_custkey", "c_acctbal")
    return clean.purge(c, "c_acctbal", "top_percent", 5).withColumn("rule", F.lit("top")).unionByName(clean.purge(c, "c_acctbal", "lt", 0).withColumn("rule", F.lit("negative")))


PURGE = """
SELECT c_custkey, c_acctbal, 'top' AS rule FROM customer WHERE c_acctbal >= (SELECT quantile_cont(c_acctbal, 0.95) FROM customer)
UNION ALL SELECT c_custkey, c_acctbal, 'negative' FROM customer WHERE c_acctbal < 0"""


def key_dedupe(spark: SparkSession, d: str) -> DataFrame:
    """One line per order and line number, the largest quantity (ties by price, part, supplier)."""
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")
    return clean.last_per_key(li, ["l_orderkey", "l_linenumber"], F.desc_nulls_last("l_quantity"), F.desc("l_extendedprice"), F.desc("l_partkey"), F.desc("l_suppkey"))


DEDUPE = """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_quantity DESC NULLS LAST, l_extendedprice DESC, l_partkey DESC, l_suppkey DESC) AS r FROM lineitem) WHERE r = 1"""


def contract_projection(spark: SparkSession, d: str) -> DataFrame:
    """Suppliers to a declared shape, with letter buckets."""
    s = clean.first_of(table(spark, d, "supplier").withColumn("Account Bal", F.col("s_acctbal")), "balance", ["accountbal", "acct"])
    s = clean.snake_names(s).withColumn("symbol", F.upper(F.trim("s_name")))
    out = clean.project(s, {"symbol": "string", "s_suppkey": "bigint", "balance": "double", "rating": "int"})
    return out.withColumn("bucket", maintain.bucket_letter(F.translate("symbol", "S", "")))


CONTRACT = """
SELECT upper(trim(s_name)) AS symbol, s_suppkey::BIGINT AS s_suppkey, s_acctbal AS balance, NULL::INTEGER AS rating,
  coalesce(nullif(regexp_extract(replace(upper(trim(s_name)), 'S', ''), '[A-Z]', 0), ''), 'X') AS bucket FROM supplier"""


def rotation_slice(spark: SparkSession, d: str) -> DataFrame:
    """30 suppliers from the 40th on, wrapping around."""
    return clean.rotation(table(spark, d, "supplier").select("s_name"), "s_name", 40, 30)


ROTATION = """
SELECT s_name, p::INTEGER AS position FROM (SELECT s_name, ((i - 40) % n + n) % n AS p FROM (SELECT s_name, row_number() OVER (ORDER BY s_name) - 1 AS i, count(*) OVER () AS n FROM supplier)) WHERE p < 30"""


def staged_apply(spark: SparkSession, d: str) -> DataFrame:
    """What replacing finished orders by a restated half of all orders does."""
    o = table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    current = o.where("o_orderstatus <> 'P'")
    stage = o.where("o_orderkey % 2 = 0").withColumn("o_totalprice", F.when(F.col("o_orderkey") % 3 == 0, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")))
    return maintain.staged_apply(current, stage, ["o_orderkey"], ["o_orderstatus", "o_totalprice"])


APPLY = """
WITH c AS (SELECT o_orderkey, o_orderstatus AS s, o_totalprice AS p FROM orders WHERE o_orderstatus <> 'P'),
g AS (SELECT o_orderkey, o_orderstatus AS s, CASE WHEN o_orderkey % 3 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS p FROM orders WHERE o_orderkey % 2 = 0)
SELECT o_orderkey, CASE WHEN c.s IS NULL THEN 'insert' WHEN g.s IS NULL THEN 'delete' WHEN c.s = g.s AND c.p = g.p THEN 'unchanged' ELSE 'update' END AS op,
  coalesce(g.s, c.s) AS o_orderstatus, coalesce(g.p, c.p) AS o_totalprice FROM c FULL JOIN g USING (o_orderkey)"""


def merge_upsert(spark: SparkSession, d: str) -> DataFrame:
    """Customers merged with restated segments and names, blanks never win."""
    c = table(spark, d, "customer").select("c_custkey", "c_name", "c_mktsegment")
    half = c.where("c_custkey % 2 = 0").select("c_custkey", F.when(F.col("c_custkey") % 4 == 0, F.lit(" ")).otherwise(F.upper("c_name")).alias("c_name"), F.lit("RESTATED").alias("c_mktsegment"))
    new = spark.range(5).select((F.col("id") + 10_000_000).alias("c_custkey"), F.lit("new").alias("c_name"), F.lit(None).cast("string").alias("c_mktsegment"))
    gentle = maintain.gentle_upsert(c.where("c_custkey % 3 <> 0"), maintain.union_all(half, new), ["c_custkey"], ["c_name", "c_mktsegment"])
    return maintain.merge_last(c.where("c_custkey % 3 = 0"), gentle, ["c_custkey"])


UPSERT = """
WITH c AS (SELECT c_custkey, c_name, c_mktsegment FROM customer), i AS (
  SELECT c_custkey, CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE upper(c_name) END AS n, 'RESTATED' AS s FROM c WHERE c_custkey % 2 = 0 UNION ALL SELECT 10000000 + r, 'new', NULL FROM range(5) t(r)
), g AS (SELECT c_custkey, coalesce(n, c_name) AS c_name, coalesce(s, c_mktsegment) AS c_mktsegment FROM (SELECT * FROM c WHERE c_custkey % 3 <> 0) x FULL JOIN i USING (c_custkey))
SELECT * FROM g UNION ALL SELECT * FROM c WHERE c_custkey % 3 = 0 AND c_custkey NOT IN (SELECT c_custkey FROM g)"""

SOURCES = {"purchase": 0, "signup": 1, "view": 2, "click": 3, "error": 4}


def version_history(spark: SparkSession, d: str) -> DataFrame:
    """users' fused value by event type, a version whenever it changes."""
    e = table(spark, d, "events").select("user_id", "ts", "event_type", "value")
    return maintain.versions(e, "user_id", "event_type", "ts", "value", SOURCES)


def _versions_sql() -> str:
    cols = ", ".join(f"last_value(CASE WHEN event_type = '{s}' THEN value END IGNORE NULLS) OVER w AS v{i}" for s, i in SOURCES.items())
    key = " || '|' || ".join(f"coalesce(v{i}::VARCHAR, '~')" for i in SOURCES.values())
    return f"""
WITH a AS (SELECT user_id, ts, event_type, {cols} FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_type ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
b AS (SELECT *, coalesce(v0, v1, v2, v3, v4) AS state, {key} AS h FROM a),
c AS (SELECT *, lag(state) OVER o AS before, lag(h) OVER o AS hb FROM b WINDOW o AS (PARTITION BY user_id ORDER BY ts, event_type))
SELECT user_id, ts, event_type, state, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_type)::INTEGER AS version_seq,
  CASE WHEN before IS NULL AND state IS NOT NULL THEN 'publish' WHEN before IS NOT DISTINCT FROM state THEN 'correction' ELSE 'revision' END AS version_kind
FROM c WHERE hb IS DISTINCT FROM h"""


def fusion(spark: SparkSession, d: str) -> DataFrame:
    """Per user the official value (purchase, signup), the vendors' consensus (view, click), their surprise and status."""
    e = table(spark, d, "events").withColumn("p", F.element_at(F.create_map(*[F.lit(x) for kv in SOURCES.items() for x in kv]), F.col("event_type")))
    at, official = F.col("ts").cast("timestamp"), F.col("p") <= 1
    order = [F.col("p"), -F.unix_micros(at)]
    g = e.groupBy("user_id").agg(
        maintain.pick_first(F.when(official, F.col("value")), *order).alias("actual"), maintain.pick_first(F.when(F.col("p").isin(2, 3), F.col("value")), *order).alias("consensus"),
        F.max_by("event_type", "ts").alias("latest_source"), F.bool_or(F.col("event_type") == "error").alias("withdrawn"), F.min("ts").alias("published_at"),
    )
    diff = F.col("actual") - F.col("consensus")
    return g.withColumns({"surprise_abs": diff, "surprise_pct": diff / F.nullif(F.abs("consensus"), F.lit(0.0)), "status": F.when(F.col("actual").isNotNull(), "released").otherwise("scheduled")})


FUSION = """
WITH e AS (SELECT *, CASE event_type WHEN 'purchase' THEN 0 WHEN 'signup' THEN 1 WHEN 'view' THEN 2 WHEN 'click' THEN 3 ELSE 4 END AS p FROM events),
g AS (
  SELECT user_id, arg_min(value, row(p, -epoch_us(ts))) FILTER (WHERE p <= 1) AS actual, arg_min(value, row(p, -epoch_us(ts))) FILTER (WHERE p IN (2, 3)) AS consensus,
    arg_max(event_type, ts) AS latest_source, bool_or(event_type = 'error') AS withdrawn, min(ts) AS published_at FROM e GROUP BY 1
)
SELECT *, actual - consensus AS surprise_abs, (actual - consensus) / nullif(abs(consensus), 0) AS surprise_pct, CASE WHEN actual IS NOT NULL THEN 'released' ELSE 'scheduled' END AS status FROM g"""


def mentions(spark: SparkSession, d: str) -> DataFrame:
    """Mentions of entities in events, one per key, rolled up by day and kind."""
    e = table(spark, d, "events")
    refs = F.array(F.struct(F.lit("user").alias("kind"), F.concat(F.lit("U"), "user_id").alias("entity")), F.struct(F.lit("type").alias("kind"), F.col("event_type").alias("entity")),
                   F.struct(F.lit("props").alias("kind"), F.get_json_object("props", "$.k").alias("entity")))
    m = e.select(F.to_date("ts").alias("day"), F.col("ts").cast("timestamp").alias("ts"), "value", F.explode(refs).alias("r")).select("day", "ts", "value", "r.*")
    return m.groupBy("day", "kind", "entity").agg(F.count(F.lit(1)).alias("mentions"), F.count_if(F.col("value") > 10).alias("large"), F.max("ts").alias("last_at"))


MENTIONS = """
WITH m AS (
  SELECT ts::DATE AS day, ts, value, 'user' AS kind, 'U' || user_id AS entity FROM events UNION ALL SELECT ts::DATE, ts, value, 'type', event_type FROM events
  UNION ALL SELECT ts::DATE, ts, value, 'props', json_extract_string(props, '$.k') FROM events)
SELECT day, kind, entity, count(*) AS mentions, count_if(value > 10)::BIGINT AS large, max(ts) AS last_at FROM m GROUP BY ALL"""


def snapshot_changes(spark: SparkSession, d: str) -> DataFrame:
    """Rows that differ between finished orders and the first three quarters of all."""
    o = table(spark, d, "orders").select("o_orderstatus", "o_orderpriority")
    return maintain.changed_snapshots(o.where("o_orderstatus <> 'P'"), table(spark, d, "orders").where("o_orderkey % 4 <> 0").select("o_orderstatus", "o_orderpriority"))


CHANGES = """
WITH a AS (SELECT o_orderstatus, o_orderpriority FROM orders WHERE o_orderstatus <> 'P'), b AS (SELECT o_orderstatus, o_orderpriority FROM orders WHERE o_orderkey % 4 <> 0)
SELECT *, 'removed' AS side FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b) UNION ALL SELECT *, 'added' FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a)"""


def register_all(register) -> None:
    for name, fn, sql in (
        ("scalar_texts", scalar_texts, SCALARS), ("events_json", events_json, EVENTS_JSON), ("page_links", page_links, PAGE_LINKS), ("csv_bars", csv_bars, CSV_BARS),
        ("rule_universe", rule_universe, RULES), ("purge_rules", purge_top, PURGE), ("key_dedupe", key_dedupe, DEDUPE), ("contract_projection", contract_projection, CONTRACT),
        ("rotation_slice", rotation_slice, ROTATION), ("staged_apply", staged_apply, APPLY), ("merge_upsert", merge_upsert, UPSERT), ("version_history", version_history, _versions_sql()),
        ("event_fusion", fusion, FUSION), ("entity_mentions", mentions, MENTIONS), ("snapshot_changes", snapshot_changes, CHANGES),
    ):
        register(name, fn, sql)
