"""The test tables in the roles of the domain: issues, anchors, timeline, articles, summaries; each also as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import table

NOW = "2001-08-01 00:00:00"
SEGMENTS = {"AUTOMOBILE": "MARKET", "BUILDING": "RATE", "FURNITURE": "EARNINGS", "HOUSEHOLD": "ETC", "MACHINERY": "FX"}


def now():
    return F.lit(NOW).cast("timestamp")


def mapped(column: str, table_: dict):
    return F.element_at(F.create_map(*[F.lit(x) for kv in table_.items() for x in kv]), F.col(column))


ISSUES = """
issues AS (
  SELECT 'i' || c_custkey AS id, c_custkey AS iid,
    CASE WHEN c_mktsegment IN ('BUILDING', 'FURNITURE') THEN '한국은행 소식 中國 ' ELSE '' END || c_name AS canonical_title,
    CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'MARKET' WHEN 'BUILDING' THEN 'RATE' WHEN 'FURNITURE' THEN 'EARNINGS'
      WHEN 'HOUSEHOLD' THEN 'ETC' ELSE 'FX' END AS category,
    CASE WHEN c_acctbal < 0 THEN 'candidate' WHEN c_acctbal < 5000 THEN 'active' WHEN c_acctbal < 8500 THEN 'stale' ELSE 'archived' END AS status,
    CASE WHEN c_nationkey < 5 THEN 'official_event' ELSE 'cluster' END AS origin,
    CASE WHEN c_nationkey < 20 THEN ['N' || c_nationkey, 'S' || substr(c_mktsegment, 1, 1)] ELSE []::VARCHAR[] END AS keys,
    CAST(floor(abs(c_acctbal) / 1500) AS BIGINT) AS seen_sources, CAST(floor(c_acctbal) AS BIGINT) AS importance,
    'A' || c_custkey AS anchor_key,
    coalesce(created_at, TIMESTAMP '1995-01-01') AS created_at, coalesce(last_update, TIMESTAMP '1995-01-01') AS last_update
  FROM customer LEFT JOIN (SELECT o_custkey, min(o_orderdate) AS created_at, max(o_orderdate) AS last_update FROM orders GROUP BY 1)
    ON o_custkey = c_custkey)
"""


def issues(spark: SparkSession, sf: str) -> DataFrame:
    times = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.min("o_orderdate").alias("created_at"), F.max("o_orderdate").alias("last_update")
    )
    long_ago = F.lit("1995-01-01").cast("timestamp")
    b = F.col("c_acctbal")
    return table(spark, sf, "customer").join(times, "c_custkey", "left").select(
        F.concat(F.lit("i"), F.col("c_custkey").cast("string")).alias("id"), F.col("c_custkey").alias("iid"),
        F.concat(F.when(F.col("c_mktsegment").isin("BUILDING", "FURNITURE"), "한국은행 소식 中國 ").otherwise(""), "c_name").alias("canonical_title"),
        mapped("c_mktsegment", SEGMENTS).alias("category"),
        F.when(b < 0, "candidate").when(b < 5000, "active").when(b < 8500, "stale").otherwise("archived").alias("status"),
        F.when(F.col("c_nationkey") < 5, "official_event").otherwise("cluster").alias("origin"),
        F.when(F.col("c_nationkey") < 20, F.array(
            F.concat(F.lit("N"), F.col("c_nationkey").cast("string")), F.concat(F.lit("S"), F.substring("c_mktsegment", 1, 1))
        )).otherwise(F.array().cast("array<string>")).alias("keys"),
        F.floor(F.abs(b) / 1500).cast("long").alias("seen_sources"), F.floor(b).cast("long").alias("importance"),
        F.concat(F.lit("A"), F.col("c_custkey").cast("string")).alias("anchor_key"),
        F.coalesce("created_at", long_ago).cast("timestamp").alias("created_at"),
        F.coalesce("last_update", long_ago).cast("timestamp").alias("last_update"),
    )


ANCHORS = """
anchors AS (
  SELECT 'i' || o_custkey AS issue_id, 'P' || (l_partkey // 100) AS entity,
    CASE l_returnflag WHEN 'A' THEN '기준금리' WHEN 'N' THEN '변동폭' ELSE '주가 상승률' END AS metric,
    CASE WHEN l_tax < 0.075 THEN l_quantity END AS value,
    CASE WHEN l_linestatus = 'O' THEN '%' ELSE '원' END AS unit,
    CASE WHEN l_discount > 0.03 THEN l_quantity - round(l_discount * 50, 1) END AS prev,
    year(l_shipdate) || '-' || quarter(l_shipdate) || 'Q' AS period, 'S' || l_suppkey AS source,
    CASE WHEN l_tax < 0.04 THEN 'official' ELSE 'press' END AS trust, l_shipdate AS observed_at,
    CAST((l_orderkey * 10 + l_linenumber) * 1000000000 + l_partkey * 10000 + l_suppkey AS BIGINT) AS seq
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey)
"""


def anchors(spark: SparkSession, sf: str) -> DataFrame:
    owner = table(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    return table(spark, sf, "lineitem").join(owner, "l_orderkey").select(
        F.concat(F.lit("i"), F.col("o_custkey").cast("string")).alias("issue_id"),
        F.concat(F.lit("P"), F.floor(F.col("l_partkey") / 100).cast("string")).alias("entity"),
        F.when(F.col("l_returnflag") == "A", "기준금리").when(F.col("l_returnflag") == "N", "변동폭").otherwise("주가 상승률").alias("metric"),
        F.when(F.col("l_tax") < 0.075, F.col("l_quantity")).alias("value"),
        F.when(F.col("l_linestatus") == "O", "%").otherwise("원").alias("unit"),
        F.when(F.col("l_discount") > 0.03, F.col("l_quantity") - F.round(F.col("l_discount") * 50, 1)).alias("prev"),
        F.concat(F.year("l_shipdate").cast("string"), F.lit("-"), F.quarter("l_shipdate").cast("string"), F.lit("Q")).alias("period"),
        F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("source"),
        F.when(F.col("l_tax") < 0.04, "official").otherwise("press").alias("trust"),
        F.col("l_shipdate").cast("timestamp").alias("observed_at"),
        ((F.col("l_orderkey") * 10 + F.col("l_linenumber")) * 1000000000 + F.col("l_partkey") * 10000 + F.col("l_suppkey")).alias("seq"),
    )


ARTICLES = """
articles AS (
  SELECT o_orderkey AS aid, CAST(o_orderkey AS VARCHAR) AS id, CASE WHEN o_orderpriority <> '5-LOW' THEN 'i' || o_custkey END AS issue_id,
    o_orderstatus || substr(o_orderpriority, 1, 1) AS source,
    CASE WHEN o_orderpriority = '1-URGENT' THEN 'official' ELSE 'wire' END AS tier, 'http://a/' || o_orderkey AS url,
    CASE WHEN o_orderpriority = '3-MEDIUM' THEN 'これは見出し' ELSE '美 order ' END || o_orderkey AS title,
    CASE WHEN o_totalprice < 200000 THEN 'lead ' || o_orderkey ELSE '' END AS lead, o_orderdate AS published_at,
    CASE WHEN o_orderstatus = 'O' THEN 'ko' ELSE 'en' END AS lang, o_totalprice > 400000 AS is_dup,
    CAST(CASE WHEN o_totalprice < 50000 THEN 1 ELSE 0 END AS INTEGER) AS hold_count, o_orderdate + INTERVAL 2 HOUR AS collected_at
  FROM orders)
"""


def articles(spark: SparkSession, sf: str) -> DataFrame:
    key = F.col("o_orderkey").cast("string")
    p = F.col("o_orderpriority")
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("aid"), key.alias("id"),
        F.when(p != "5-LOW", F.concat(F.lit("i"), F.col("o_custkey").cast("string"))).alias("issue_id"),
        F.concat("o_orderstatus", F.substring(p, 1, 1)).alias("source"),
        F.when(p == "1-URGENT", "official").otherwise("wire").alias("tier"), F.concat(F.lit("http://a/"), key).alias("url"),
        F.concat(F.when(p == "3-MEDIUM", "これは見出し").otherwise("美 order "), key).alias("title"),
        F.when(F.col("o_totalprice") < 200000, F.concat(F.lit("lead "), key)).otherwise("").alias("lead"),
        F.col("o_orderdate").cast("timestamp").alias("published_at"), F.when(F.col("o_orderstatus") == "O", "ko").otherwise("en").alias("lang"),
        (F.col("o_totalprice") > 400000).alias("is_dup"), F.when(F.col("o_totalprice") < 50000, 1).otherwise(0).alias("hold_count"),
        (F.col("o_orderdate").cast("timestamp") + F.expr("INTERVAL 2 HOURS")).alias("collected_at"),
    )


TIMELINE = """
timeline AS (
  SELECT 'i' || o_custkey AS issue_id, CASE WHEN o_orderstatus = 'F' THEN 'official' ELSE 'headline' END AS kind,
    CASE WHEN o_orderpriority = '2-HIGH' THEN '外國標題新聞' ELSE '中 entry ' END || o_orderkey AS title, o_orderpriority AS source,
    'http://t/' || o_orderkey AS url, o_orderdate AS seen, o_orderkey AS seq FROM orders)
"""


def timeline(spark: SparkSession, sf: str) -> DataFrame:
    key = F.col("o_orderkey").cast("string")
    return table(spark, sf, "orders").select(
        F.concat(F.lit("i"), F.col("o_custkey").cast("string")).alias("issue_id"),
        F.when(F.col("o_orderstatus") == "F", "official").otherwise("headline").alias("kind"),
        F.concat(F.when(F.col("o_orderpriority") == "2-HIGH", "外國標題新聞").otherwise("中 entry "), key).alias("title"),
        F.col("o_orderpriority").alias("source"), F.concat(F.lit("http://t/"), key).alias("url"),
        F.col("o_orderdate").cast("timestamp").alias("at"), F.col("o_orderkey").alias("seq"),
    )


SUMMARIES = """
summaries AS (
  SELECT 'i' || c_custkey AS issue_id, CASE WHEN c_nationkey < 8 THEN NULL WHEN c_mktsegment = 'BUILDING' THEN 'model-a' ELSE 'template' END AS model,
    CASE WHEN c_nationkey > 15 THEN '' ELSE '요약 ' || c_custkey END AS title, '한 줄 ' || c_name AS one_liner, 'why ' || c_custkey AS why_now,
    'h' || (c_custkey // 3) AS fact_hash,
    TIMESTAMP '2001-07-31 00:00:00' + to_hours(c_nationkey) AS created_at
  FROM customer)
"""


def summaries(spark: SparkSession, sf: str) -> DataFrame:
    key = F.col("c_custkey").cast("string")
    return table(spark, sf, "customer").select(
        F.concat(F.lit("i"), key).alias("issue_id"),
        F.when(F.col("c_nationkey") >= 8, F.when(F.col("c_mktsegment") == "BUILDING", "model-a").otherwise("template")).alias("model"),
        F.when(F.col("c_nationkey") > 15, "").otherwise(F.concat(F.lit("요약 "), key)).alias("title"),
        F.concat(F.lit("한 줄 "), "c_name").alias("one_liner"), F.concat(F.lit("why "), key).alias("why_now"),
        F.concat(F.lit("h"), F.floor(F.col("c_custkey") / 3).cast("string")).alias("fact_hash"),
        (F.lit("2001-07-31").cast("timestamp") + F.make_dt_interval(hours="c_nationkey")).alias("created_at"),
    )
