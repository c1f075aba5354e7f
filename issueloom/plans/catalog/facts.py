"""Queries on official events, disclosures, filings and landed rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ...functions.text import period_bucket
from ...operators import backfill as O, events as V
from ...settings import Settings
from ...sources import landing, payloads
from . import query, table

AT = "2024-02-01 00:00:00"


def _now():
    return F.lit(AT).cast("timestamp")


DOCS_SQL = """
docs AS (
  SELECT 'U' || user_id || '_' || event_type || '_' || strftime(ts, '%Y-%m-%d') || '_' || (CAST(value AS BIGINT) // 40) AS key, event_id, ts AS created_at,
    CASE WHEN event_type = 'error' THEN NULL ELSE event_type END AS category, 'U' || user_id AS entity, strftime(ts, '%Y-%m-%d') AS period,
    value FROM events),
keyed AS (SELECT *, entity || '|' || coalesce(category, 'ETC') || '|' || period AS ak FROM docs),
once AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY created_at, event_id) AS rn FROM keyed) WHERE rn = 1),
stored AS (SELECT ak, CASE WHEN max(value) > 100 THEN 'archived' ELSE 'active' END AS status,
             CASE WHEN max(value) > 100 THEN 'e' || substr(sha1(ak), 1, 16) ELSE 'live-' || ak END AS id
           FROM keyed WHERE category = 'signup' GROUP BY ak),
todo AS (SELECT * FROM once WHERE key NOT IN (SELECT key FROM docs WHERE category = 'click')),
linked AS (SELECT t.*, s.id AS live_id, coalesce(s.id, 'e' || substr(sha1(t.ak), 1, 16)) AS issue_id
           FROM todo t LEFT JOIN stored s ON s.ak = t.ak AND s.status <> 'archived')
"""


def _documents(spark, sf):
    """Events as official event documents with one anchor, a timeline entry and a headline."""
    e = table(spark, sf, "events")
    entity = F.concat(F.lit("U"), F.col("user_id").cast("string"))
    day = F.date_format("ts", "yyyy-MM-dd")
    text_id = F.col("event_id").cast("string")
    at = F.col("ts").cast("timestamp")
    return e.select(
        F.concat_ws("_", entity, "event_type", day, F.floor(F.rint("value") / 40).cast("string")).alias("key"), "event_id",
        at.alias("created_at"), F.when(F.col("event_type") != "error", F.col("event_type")).alias("category"), entity.alias("entity"),
        day.alias("period"), F.concat(entity, F.lit(" news")).alias("title"), "value",
        F.array(F.struct(
            entity.alias("entity"), F.col("event_type").alias("metric"), F.col("value").alias("value"), F.lit("x").alias("unit"),
            F.lit(None).cast("double").alias("prev"), day.alias("period"), F.lit("src").alias("source"),
            F.when(F.col("value") > 60, at).alias("observed_at"))).alias("anchors"),
        F.struct(F.lit(None).cast("string").alias("kind"), F.concat(F.lit("t"), text_id).alias("title"), F.lit("src").alias("source"),
                 F.lit("u").alias("url")).alias("timeline"),
        F.array(F.struct(F.concat(F.lit(" head "), text_id).alias("title"),
                         F.concat(F.lit("HTTP://News.example/"), F.floor(F.col("event_id") / 2).cast("string"), F.lit("?utm_source=a")).alias("url"),
                         F.lit("s").alias("source"), F.lit(None).cast("string").alias("tier"), F.lit(None).cast("string").alias("lang"),
                         at.alias("published_at"))).alias("headlines"),
    )


def _linked(spark, sf):
    docs = _documents(spark, sf)
    once = V.latest_per_key(docs, ["key"], [F.col("created_at"), F.col("event_id")])
    done = docs.filter("category = 'click'").select("key").distinct()
    keyed = docs.withColumn("anchor_key", V.anchor_key()).filter("category = 'signup'")
    stored = keyed.groupBy("anchor_key").agg(F.max("value").alias("m")).select(
        "anchor_key", F.when(F.col("m") > 100, "archived").otherwise("active").alias("status"),
        F.when(F.col("m") > 100, V.official_id(F.col("anchor_key"))).otherwise(F.concat(F.lit("live-"), "anchor_key")).alias("id"),
    )
    return V.link_events(V.pending(once, done), stored), stored


@query("pending_events", f"WITH {DOCS_SQL} SELECT key, event_id FROM todo")
def pending_events(spark: SparkSession, sf: str) -> DataFrame:
    return _linked(spark, sf)[0].select("key", "event_id")


@query("event_to_issue", f"WITH {DOCS_SQL} SELECT key, ak AS anchor_key, issue_id FROM linked")
def event_to_issue(spark: SparkSession, sf: str) -> DataFrame:
    return _linked(spark, sf)[0].select("key", "anchor_key", "issue_id")


@query("issue_upsert", f"""
WITH {DOCS_SQL},
made AS (SELECT issue_id AS id, ak, coalesce(category, 'ETC') AS category, entity, created_at,
           row_number() OVER (PARTITION BY issue_id ORDER BY created_at, key) AS rn FROM linked WHERE live_id IS NULL)
SELECT s.id, s.status, 'cluster' AS origin, 'old' AS canonical_title, s.ak AS anchor_key, s.ak AS keys,
  CASE WHEN s.id IN (SELECT live_id FROM linked) THEN '{AT}' ELSE '2024-01-01 00:00:00' END AS last_update FROM stored s
UNION ALL
SELECT id, 'active', 'official_event', entity || ' news', ak, CASE WHEN entity = 'U1' THEN 'ONE' ELSE entity END, '{AT}'
FROM made WHERE rn = 1 AND id NOT IN (SELECT id FROM stored)""")
def issue_upsert(spark: SparkSession, sf: str) -> DataFrame:
    linked, stored = _linked(spark, sf)
    old = stored.select(
        "id", "anchor_key", "status", F.lit("cluster").alias("origin"), F.lit("old").alias("canonical_title"), F.lit("ETC").alias("category"),
        F.array("anchor_key").alias("keys"), F.lit("2024-01-01").cast("timestamp").alias("created_at"),
        F.lit("2024-01-01").cast("timestamp").alias("last_update"), F.lit(False).alias("frozen"),
    )
    rows = V.upsert_issues(linked, old, _now(), [("u1", "ONE")])
    return rows.select(
        "id", "status", "origin", "canonical_title", "anchor_key", F.array_join("keys", ",").alias("keys"),
        F.date_format("last_update", "yyyy-MM-dd HH:mm:ss").alias("last_update"),
    )


@query("anchor_upsert", f"""
WITH {DOCS_SQL},
two_sides AS (
  SELECT issue_id, entity, event_type AS metric, period, l.value, strftime(CASE WHEN l.value > 60 THEN ts ELSE created_at END, '%Y-%m-%d %H:%M:%S') AS observed_at, key, 1 AS fresh
  FROM linked l JOIN events USING (event_id)
  UNION ALL
  SELECT s.id, k.entity, k.category, k.period, -1.0, '2023-01-01 00:00:00', '', 0 FROM stored s JOIN (SELECT DISTINCT ak, entity, category, period FROM keyed) k USING (ak))
SELECT issue_id, entity, metric, period, value, observed_at FROM (
  SELECT *, row_number() OVER (PARTITION BY issue_id, entity, metric, period ORDER BY fresh DESC, key DESC) AS rn FROM two_sides) WHERE rn = 1""")
def anchor_upsert(spark: SparkSession, sf: str) -> DataFrame:
    linked, stored = _linked(spark, sf)
    parts = _documents(spark, sf).withColumn("anchor_key", V.anchor_key()).select(
        "anchor_key", "entity", F.col("category").alias("metric"), "period").distinct()
    old = stored.join(parts, "anchor_key").select(
        F.col("id").alias("issue_id"), "entity", "metric", "period", F.lit(-1.0).alias("value"), F.lit("").alias("unit"),
        F.lit("old").alias("source"), F.lit("official").alias("trust"), F.lit(None).cast("double").alias("prev"),
        F.lit("2023-01-01").cast("timestamp").alias("observed_at"), F.lit(0).cast("long").alias("seq"),
    )
    rows = V.upsert_anchors(old, V.event_anchors(linked, _now()))
    return rows.select(
        "issue_id", "entity", "metric", "period", "value", F.date_format("observed_at", "yyyy-MM-dd HH:mm:ss").alias("observed_at")
    )


@query("event_articles", f"""
WITH {DOCS_SQL},
h AS (SELECT issue_id, key, created_at, event_id, 'http://news.example/' || (event_id // 2) AS url FROM linked),
f AS (SELECT *, row_number() OVER (PARTITION BY url ORDER BY created_at, key) AS rn FROM h)
SELECT sha1(url) AS id, issue_id, url, 'head ' || event_id AS title, 'wire' AS tier, 'ko' AS lang FROM f
WHERE rn = 1 AND url NOT IN (SELECT 'http://news.example/' || doc_id FROM documents WHERE lang = 'fr')""")
def event_articles(spark: SparkSession, sf: str) -> DataFrame:
    from ...functions.text import url_id

    linked, _ = _linked(spark, sf)
    known = table(spark, sf, "documents").filter("lang = 'fr'").select(
        url_id(F.concat(F.lit("http://news.example/"), F.col("doc_id").cast("string"))).alias("id"))
    return V.event_articles(linked, known, _now(), []).select("id", "issue_id", "url", "title", "tier", "lang")


@query("event_timeline", f"""
WITH {DOCS_SQL} SELECT issue_id, 'official' AS kind, 't' || event_id AS title, strftime(created_at, '%Y-%m-%d %H:%M:%S') AS at FROM linked""")
def event_timeline(spark: SparkSession, sf: str) -> DataFrame:
    linked, _ = _linked(spark, sf)
    return V.event_timeline(linked, _now()).select("issue_id", "kind", "title", F.date_format("at", "yyyy-MM-dd HH:mm:ss").alias("at"))


@query("new_events", """
WITH k AS (SELECT event_id, ts, substr(regexp_replace(event_type || '/' || user_id || ' ' || strftime(ts, '%Y-%m-%d'), '[^0-9A-Za-z가-힣._-]', '_', 'g'), 1, 150) AS safe_key FROM events),
stored AS (SELECT DISTINCT safe_key FROM k WHERE ts < TIMESTAMP '2024-01-10')
SELECT safe_key, event_id FROM (SELECT *, row_number() OVER (PARTITION BY safe_key ORDER BY ts, event_id) AS rn FROM k) WHERE rn = 1
AND safe_key NOT IN (SELECT safe_key FROM stored)""")
def new_events(spark: SparkSession, sf: str) -> DataFrame:
    from ...functions.text import safe_key

    e = table(spark, sf, "events").withColumn("created_at", F.col("ts").cast("timestamp")).withColumn(
        "key", F.concat("event_type", F.lit("/"), F.col("user_id").cast("string"), F.lit(" "), F.date_format("ts", "yyyy-MM-dd")))
    stored = e.filter("ts < '2024-01-10'").select(safe_key("key").alias("safe_key")).distinct()
    return landing.new_events(e, stored).select("safe_key", "event_id")


REPORT_SQL = """
r AS (SELECT o_orderkey, o_custkey, c_name, strftime(o_orderdate, '%Y%m%d') AS day,
   CASE o_orderstatus WHEN 'F' THEN '분기보고서 (' || strftime(o_orderdate, '%Y.%m') || ')' WHEN 'O' THEN '[기재정정]연결 잠정실적' ELSE '임원 변동' END AS report_name,
   o_orderstatus, year(o_orderdate) || '-' || quarter(o_orderdate) || 'Q' AS period
   FROM orders JOIN customer ON c_custkey = o_custkey)
"""


def _reports(spark, sf):
    names = table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_name")
    name = (
        F.when(F.col("o_orderstatus") == "F", F.concat(F.lit("분기보고서 ("), F.date_format("o_orderdate", "yyyy.MM"), F.lit(")")))
        .when(F.col("o_orderstatus") == "O", "[기재정정]연결 잠정실적").otherwise("임원 변동")
    )
    return table(spark, sf, "orders").join(names, "o_custkey").select(
        F.col("o_orderkey").cast("string").alias("receipt_no"), F.col("o_custkey").cast("string").alias("corp_code"),
        F.col("c_name").alias("corp_name"), name.alias("report_name"), F.date_format("o_orderdate", "yyyyMMdd").alias("receipt_day"),
    )


@query("period_bucket_events", f"WITH {REPORT_SQL} SELECT CAST(o_orderkey AS VARCHAR) AS receipt_no, period FROM r")
def period_bucket_events(spark: SparkSession, sf: str) -> DataFrame:
    return _reports(spark, sf).select("receipt_no", period_bucket("report_name", "receipt_day").alias("period"))


@query("earnings_events", f"""
WITH {REPORT_SQL},
facts AS (SELECT o_custkey, year(l_shipdate) || '-' || quarter(l_shipdate) || 'Q' AS period,
    CASE l_linestatus WHEN 'O' THEN '매출액' ELSE '영업이익' END AS metric, round(l_extendedprice * 1000000 / 1e8, 1) AS value,
    row_number() OVER (PARTITION BY o_custkey, year(l_shipdate), quarter(l_shipdate)
      ORDER BY (l_orderkey * 10 + l_linenumber) * 1000000000 + l_partkey * 10000 + l_suppkey) AS rn
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE l_returnflag = 'A'),
packed AS (SELECT o_custkey, period, string_agg(metric || '=' || CAST(CAST(value AS DECIMAL(18, 1)) AS VARCHAR), ',' ORDER BY rn) AS anchors
  FROM facts WHERE rn <= 4 GROUP BY ALL)
SELECT 'dart_' || o_orderkey AS key, c_name AS entity, r.period, c_name || ' ' || r.period || ' ' ||
  CASE WHEN contains(report_name, '잠정') THEN '잠정' ELSE '' END || '실적 공시' AS title, coalesce(anchors, '') AS anchors
FROM r LEFT JOIN packed USING (o_custkey, period) WHERE o_orderstatus IN ('F', 'O')""")
def earnings_events(spark: SparkSession, sf: str) -> DataFrame:
    """Facts of the whole lineitem table, joined on the quarter each disclosure is about."""
    owner = table(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    code = F.element_at(F.array(*[F.lit(c) for c in ("11013", "11012", "11014", "11011")]), F.quarter("l_shipdate"))
    facts = table(spark, sf, "lineitem").join(owner, "l_orderkey").select(
        F.col("o_custkey").cast("string").alias("corp_code"), F.year("l_shipdate").cast("string").alias("year"), code.alias("report_code"),
        F.when(F.col("l_returnflag") == "A", "CFS").otherwise("OFS").alias("division"),
        F.when(F.col("l_linestatus") == "O", "매출액").otherwise("영업이익").alias("account"),
        F.format_number(F.col("l_extendedprice") * 1000000, 0).alias("amount"),
        ((F.col("l_orderkey") * 10 + F.col("l_linenumber")) * 1000000000 + F.col("l_partkey") * 10000 + F.col("l_suppkey")).alias("seq"),
    )
    rows = payloads.earnings_events(_reports(spark, sf), facts, [("customer#", "LISTED")])
    shown = F.transform("anchors", lambda a: F.concat(a["metric"], F.lit("="), a["value"].cast("decimal(18,1)").cast("string")))
    return rows.select("key", "entity", "period", "title", F.array_join(shown, ",").alias("anchors"))


@query("filing_events", """
SELECT 'edgar_' || lpad(CAST(o_custkey AS VARCHAR), 10, '0') || '-24-' || lpad(CAST(o_orderkey AS VARCHAR), 6, '0') AS key,
  c_name AS entity, CASE WHEN o_orderstatus <> 'P' THEN CAST(o_custkey AS VARCHAR) END AS cik, form
FROM (SELECT *, CASE o_orderpriority WHEN '1-URGENT' THEN '8-K' WHEN '2-HIGH' THEN '10-Q' ELSE '10-K' END AS form FROM orders)
JOIN customer ON c_custkey = o_custkey
WHERE o_orderpriority <> '5-LOW' AND (form <> '8-K' OR o_totalprice > 200000)""")
def filing_events(spark: SparkSession, sf: str) -> DataFrame:
    names = table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_name")
    p, key, cust = F.col("o_orderpriority"), F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string")
    form = F.when(p == "1-URGENT", "8-K").when(p == "2-HIGH", "10-Q").otherwise("10-K")
    number = F.concat(F.lpad(cust, 10, "0"), F.lit("-24-"), F.lpad(key, 6, "0"))
    entries = table(spark, sf, "orders").join(names, "o_custkey").select(
        form.alias("form"), F.concat("c_name", F.lit(" (0001234567) (Filer) ("), form, F.lit(")")).alias("title"),
        F.when(F.col("o_totalprice") > 200000, "Item 2.02 results").otherwise("other").alias("summary"),
        F.concat(
            F.when(F.col("o_orderstatus") != "P", F.concat(F.lit("https://s.example/?CIK="), cust)).otherwise("https://s.example/"),
            F.when(p == "5-LOW", "").when(p == "3-MEDIUM", F.concat(F.lit("&accession_number="), number)).otherwise(F.concat(F.lit("/"), number)),
        ).alias("link"),
    )
    return payloads.filing_events(entries).select("key", "entity", "cik", "form")


@query("latest_quarters", """
WITH c AS (SELECT CAST(l_suppkey AS VARCHAR) AS cik, l_returnflag AS metric,
  CASE WHEN l_linenumber = 7 THEN 1 WHEN l_linenumber >= 5 THEN 2 ELSE 3 END AS tag_rank,
  l_discount >= 0.05 AS unframed, strftime(l_shipdate, '%Y-%m-%d') AS "end", l_extendedprice * 1000 AS val,
  (l_orderkey * 10 + l_linenumber) * 1000000000 + l_partkey * 10000 + l_suppkey AS seq FROM lineitem WHERE l_quantity >= 10),
b AS (SELECT cik, metric, min((tag_rank, CAST(unframed AS INTEGER))) AS best FROM c GROUP BY ALL),
r AS (SELECT c.*, row_number() OVER (PARTITION BY cik, metric ORDER BY "end" DESC, seq) AS rn FROM c JOIN b USING (cik, metric)
      WHERE (tag_rank, CAST(unframed AS INTEGER)) = best)
SELECT cik, metric, "end", round(val / 1e6, 1) AS value, CAST(rn AS INTEGER) AS rank FROM r WHERE rn <= 4""")
def latest_quarters(spark: SparkSession, sf: str) -> DataFrame:
    n = F.col("l_linenumber")
    concepts = table(spark, sf, "lineitem").select(
        F.col("l_suppkey").cast("string").alias("cik"), F.col("l_returnflag").alias("metric"),
        F.when(n == 7, "A").when(n >= 5, "B").otherwise("C").alias("tag"), F.when(F.col("l_quantity") >= 10, "10-Q").otherwise("8-K").alias("form"),
        F.when(F.col("l_discount") < 0.05, "CY").alias("frame"), F.date_format("l_shipdate", "yyyy-MM-dd").alias("end"),
        (F.col("l_extendedprice") * 1000).alias("val"),
        ((F.col("l_orderkey") * 10 + n) * 1000000000 + F.col("l_partkey") * 10000 + F.col("l_suppkey")).alias("seq"),
    )
    return payloads.latest_quarters(concepts, ["A", "B", "C"])


@query("lookback_scan", """
SELECT event_id FROM events WHERE event_type = 'error' OR ts >= TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 26 HOUR""")
def lookback_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of the lookback; an unreadable time (here: of errors) stays."""
    e = table(spark, sf, "events").withColumn(
        "collected_at", F.when(F.col("event_type") == "error", "soon").otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")))
    return landing.recent(e, F.lit("2024-01-31").cast("timestamp"), Settings().lookback_h).select("event_id")


TOPICS = {"AUTOMOBILE": "click", "BUILDING": "view", "FURNITURE": "error", "HOUSEHOLD": "signup", "MACHINERY": "purchase"}
TOPIC_SQL = """CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'click' WHEN 'BUILDING' THEN 'view' WHEN 'FURNITURE' THEN 'error'
  WHEN 'HOUSEHOLD' THEN 'signup' ELSE 'purchase' END"""


@query("interval_join", f"""
WITH ev AS (SELECT c_custkey AS event_id, {TOPIC_SQL} AS topic, DATE '2024-01-01' + CAST(c_nationkey AS INTEGER) AS d FROM customer),
dates AS (SELECT DISTINCT topic, d FROM ev),
r AS (SELECT topic, d, e.event_id AS aid, row_number() OVER (PARTITION BY topic, d ORDER BY ts, e.event_id) AS rn
      FROM dates JOIN events e ON event_type = topic AND ts BETWEEN d - INTERVAL 3 DAY AND d + INTERVAL 3 DAY)
SELECT ev.event_id, aid, CAST(rn AS INTEGER) AS rank FROM ev JOIN r USING (topic, d) WHERE rn <= 25""")
def interval_join(spark: SparkSession, sf: str) -> DataFrame:
    from .views import mapped

    ev = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("event_id"), mapped("c_mktsegment", TOPICS).alias("topic"),
        F.date_add(F.lit("2024-01-01").cast("date"), F.col("c_nationkey")).alias("date"))
    arts = table(spark, sf, "events").select(
        F.col("event_type").alias("topic"), F.col("ts").cast("timestamp").alias("published_at"), F.col("event_id").alias("aid"))
    return O.around(ev, arts).select("event_id", "aid", "rank")


@query("seed_fallback", f"""
WITH ev AS (SELECT c_custkey AS event_id, {TOPIC_SQL} || c_nationkey AS topic, DATE '2024-01-01' + CAST(c_nationkey AS INTEGER) AS d FROM customer),
r AS (SELECT ev.event_id, e.event_id AS aid, row_number() OVER (PARTITION BY ev.event_id ORDER BY ts, e.event_id) AS rn
      FROM ev JOIN events e ON event_type || user_id = topic AND ts BETWEEN d - INTERVAL 3 DAY AND d + INTERVAL 3 DAY),
found AS (SELECT event_id, 'http://f/' || aid AS url FROM r WHERE rn <= 25),
thin AS (SELECT event_id FROM ev WHERE event_id NOT IN (SELECT event_id FROM found GROUP BY event_id HAVING count(*) >= 2))
SELECT event_id, url, 'found' AS origin FROM found
UNION ALL SELECT event_id, 'http://s/' || event_id || '/' || n, 'listed' FROM thin, (SELECT unnest([1, 2]) AS n)""")
def seed_fallback(spark: SparkSession, sf: str) -> DataFrame:
    from .views import mapped

    key, nation = F.col("c_custkey").cast("string"), F.col("c_nationkey").cast("string")
    ev = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("event_id"), F.concat(mapped("c_mktsegment", TOPICS), nation).alias("topic"),
        F.date_add(F.lit("2024-01-01").cast("date"), F.col("c_nationkey")).alias("date"),
        F.array(F.concat(F.lit("http://s/"), key, F.lit("/1")), F.concat(F.lit("http://s/"), key, F.lit("/2"))).alias("articles"))
    arts = table(spark, sf, "events").select(
        F.concat("event_type", F.col("user_id").cast("string")).alias("topic"), F.col("ts").cast("timestamp").alias("published_at"),
        F.col("event_id").alias("aid"))
    found = O.around(ev.drop("articles"), arts).select("event_id", F.concat(F.lit("http://f/"), F.col("aid").cast("string")).alias("url"))
    return O.with_seed_articles(ev, found)


@query("replay_window", """
SELECT event_id FROM events WHERE ts >= TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 240 HOUR""")
def replay_window(spark: SparkSession, sf: str) -> DataFrame:
    """A longer lookback replays older rows through the same path."""
    e = table(spark, sf, "events").withColumn("collected_at", F.col("ts").cast("timestamp"))
    return O.replay_window(e, F.lit("2024-01-31").cast("timestamp"), 240).select("event_id")


@query("filing_anchors", """
WITH c AS (SELECT l_suppkey AS cik, CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END AS kind, l_discount >= 0.05 AS unframed,
  strftime(l_shipdate, '%Y-%m-%d') AS "end", l_extendedprice * 1000 AS val, (l_orderkey * 10 + l_linenumber) * 1000000000 + l_partkey * 10000 + l_suppkey AS seq
  FROM lineitem WHERE l_quantity >= 10),
t AS (SELECT *, CASE WHEN kind = 2 THEN 1 ELSE 0 END AS o, CASE WHEN kind = 1 THEN 2 ELSE 1 END AS tag_rank FROM c),
b AS (SELECT cik, o, min((tag_rank, CAST(unframed AS INTEGER))) AS best FROM t GROUP BY ALL),
r AS (SELECT t.*, row_number() OVER (PARTITION BY cik, o ORDER BY "end" DESC, seq) AS rn FROM t JOIN b USING (cik, o)
      WHERE (tag_rank, CAST(unframed AS INTEGER)) = best),
f AS (SELECT *, row_number() OVER (PARTITION BY cik ORDER BY o, rn) AS k FROM r WHERE rn <= 4),
p AS (SELECT cik, string_agg(CASE o WHEN 0 THEN '매출' ELSE '영업이익' END || '=' || CAST(CAST(round(val / 1e6, 1) AS DECIMAL(18, 1)) AS VARCHAR) || '@' || "end", ',' ORDER BY k) AS anchors FROM f WHERE k <= 4 GROUP BY cik)
SELECT s_name AS key, coalesce(anchors, '') AS anchors FROM supplier LEFT JOIN p ON cik = s_suppkey""")
def filing_anchors(spark: SparkSession, sf: str) -> DataFrame:
    """Suppliers as filers; the facts of the whole lineitem table give each its latest quarters."""
    flag = F.col("l_returnflag")
    tag = F.when(flag == "A", "Revenues").when(flag == "N", "SalesRevenueNet").otherwise("OperatingIncomeLoss")
    concepts = table(spark, sf, "lineitem").select(
        F.col("l_suppkey").cast("string").alias("cik"), tag.alias("tag"), F.when(F.col("l_quantity") >= 10, "10-Q").otherwise("8-K").alias("form"),
        F.when(F.col("l_discount") < 0.05, "CY").alias("frame"), F.date_format("l_shipdate", "yyyy-MM-dd").alias("end"),
        (F.col("l_extendedprice") * 1000).alias("val"),
        ((F.col("l_orderkey") * 10 + F.col("l_linenumber")) * 1000000000 + F.col("l_partkey") * 10000 + F.col("l_suppkey")).alias("seq"))
    filers = table(spark, sf, "supplier").select(F.col("s_name").alias("key"), F.col("s_suppkey").cast("string").alias("cik"))
    rows = payloads.filing_anchors(filers, concepts)
    shown = F.transform("anchors", lambda a: F.concat(a["metric"], F.lit("="), a["value"].cast("decimal(18,1)").cast("string"), F.lit("@"), a["period"]))
    return rows.select("key", F.array_join(shown, ",").alias("anchors"))
