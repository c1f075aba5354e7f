"""Queries on diagnostics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ...operators import diagnostics as D
from ...operators.lifecycle import calls_on
from ...operators.summary import review_listing as review_queue
from ...settings import Settings
from . import query, table
from .views import (
    ANCHORS, ARTICLES, ISSUES, NOW, SUMMARIES, TIMELINE, anchors, articles, issues, now, summaries, timeline,
)


@query("status_counts", f"WITH {ISSUES} SELECT status, CAST(count(*) AS BIGINT) AS n FROM issues GROUP BY status")
def status_counts(spark: SparkSession, sf: str) -> DataFrame:
    return D.status_counts(issues(spark, sf))


COUNTS = """
counts AS (SELECT CAST(count(*) AS BIGINT) AS total, CAST(count(*) FILTER (is_dup) AS BIGINT) AS dup,
  CAST(count(*) FILTER (NOT is_dup AND issue_id IS NOT NULL) AS BIGINT) AS assigned,
  CAST(count(*) FILTER (NOT is_dup AND issue_id IS NULL AND hold_count > 0) AS BIGINT) AS held,
  CAST(count(*) FILTER (NOT is_dup AND issue_id IS NULL AND hold_count = 0) AS BIGINT) AS unassigned FROM articles)
"""


@query("article_states", f"WITH {ARTICLES}, {COUNTS} SELECT * FROM counts")
def article_states(spark: SparkSession, sf: str) -> DataFrame:
    return D.article_counts(articles(spark, sf))


@query("article_listing", f"""
WITH {ARTICLES} SELECT aid, CASE WHEN is_dup THEN '중복' WHEN issue_id IS NOT NULL THEN '배정' WHEN hold_count > 0 THEN '보류' ELSE '미배정' END AS state
FROM articles WHERE collected_at >= TIMESTAMP '{NOW}' - INTERVAL 7200 HOUR ORDER BY collected_at DESC, aid LIMIT 1500""")
def article_listing(spark: SparkSession, sf: str) -> DataFrame:
    return D.article_listing(articles(spark, sf), now(), 7200).select("aid", "state")


@query("issue_listing", f"""
WITH {ISSUES} SELECT id, status, importance FROM issues WHERE status IN ('candidate', 'active', 'stale')
  OR (status = 'archived' AND last_update >= TIMESTAMP '{NOW}' - INTERVAL 7 DAY) ORDER BY importance DESC, last_update DESC, id LIMIT 500""")
def issue_listing(spark: SparkSession, sf: str) -> DataFrame:
    return D.issue_listing(issues(spark, sf), now()).select("id", "status", "importance")


@query("run_log_top", "SELECT event_id AS run_id, event_type AS kind FROM events ORDER BY ts DESC, event_id DESC LIMIT 20")
def run_log_top(spark: SparkSession, sf: str) -> DataFrame:
    log = table(spark, sf, "events").select(F.col("event_id").alias("run_id"), F.col("event_type").alias("kind"), F.col("ts").alias("at"))
    return D.newest_runs(log).select("run_id", "kind")


@query("review_listing", """
SELECT conv_id || '-' || turn AS issue_id, 'turn ' || turn AS reason FROM conversations WHERE role <> 'assistant'""")
def review_listing(spark: SparkSession, sf: str) -> DataFrame:
    """Review queue, newest first, with the reason read from its JSON."""
    c = table(spark, sf, "conversations").filter("role <> 'assistant'")
    rows = c.select(
        F.concat_ws("-", "conv_id", "turn").alias("issue_id"), F.timestamp_seconds("turn").alias("at"),
        F.to_json(F.struct(F.concat(F.lit("turn "), F.col("turn").cast("string")).alias("summary"))).alias("reason"))
    return review_queue(rows).select("issue_id", "reason")


@query("run_metadata", f"""
WITH {ISSUES}, {ARTICLES}, {COUNTS}
SELECT c.*, (SELECT string_agg(status || '=' || n, ',' ORDER BY status) FROM (SELECT status, count(*) AS n FROM issues GROUP BY status)) AS issue_counts,
  (SELECT CAST(sum(CAST(value AS BIGINT)) AS BIGINT) FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-15') AS calls_today,
  (SELECT CAST(count(*) AS BIGINT) FROM conversations WHERE role = 'user') AS review_queue, 0.82 AS tau_join,
  (SELECT 'now:{{}},' || string_agg(strftime(ts, '%H:%M:%S') || ':' || event_type, ',' ORDER BY ts DESC, event_id DESC) FROM (SELECT * FROM events ORDER BY ts DESC, event_id DESC LIMIT 20)) AS history
  FROM counts c""".replace("0.82 AS tau_join", "CAST(0.82 AS DOUBLE) AS tau_join"))
def run_metadata(spark: SparkSession, sf: str) -> DataFrame:
    log = table(spark, sf, "events").select(F.col("ts").alias("at"), F.rint("value").cast("long").alias("calls"))
    calls = calls_on(log, F.lit("2024-01-15 10:00:00").cast("timestamp"))
    reviews = table(spark, sf, "conversations").filter("role = 'user'")
    runs = table(spark, sf, "events").select(F.col("event_id").alias("run_id"), F.col("ts").cast("timestamp").alias("at"), F.col("event_type").alias("stats"))
    row = D.run_metadata(issues(spark, sf), articles(spark, sf), calls, reviews, {"tau_join": Settings().tau_join}, runs, now(), {})
    told = F.transform("history", lambda h, i: F.concat_ws(":", F.when(i == 0, "now").otherwise(F.date_format(h["at"], "HH:mm:ss")), h["stats"]))
    entries = F.transform(F.map_entries("issue_counts"), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string")))
    return row.select("article_counts.*", F.array_join(entries, ",").alias("issue_counts"), "calls_today", "review_queue", "thresholds.tau_join",
                      F.array_join(told, ",").alias("history"))


@query("issue_diagnostics", f"""
WITH {ISSUES}, {ARTICLES}, {ANCHORS}, {TIMELINE}, {SUMMARIES},
l AS (SELECT * FROM issues WHERE status IN ('candidate', 'active', 'stale') OR (status = 'archived' AND last_update >= TIMESTAMP '{NOW}' - INTERVAL 7 DAY)
      ORDER BY importance DESC, last_update DESC, id LIMIT 500),
m AS (SELECT issue_id, least(50, count(*)) AS n, arg_max(aid, (published_at, -aid)) AS newest FROM articles WHERE issue_id IS NOT NULL GROUP BY 1),
a AS (SELECT issue_id, least(20, count(*)) AS n FROM anchors GROUP BY 1),
t AS (SELECT issue_id, least(50, count(*)) AS n, arg_max(url, (seen, seq)) AS newest FROM timeline GROUP BY 1)
SELECT l.id AS issue_id, status, CAST(coalesce(m.n, 0) AS INTEGER) AS members, m.newest AS newest_member, CAST(coalesce(a.n, 0) AS INTEGER) AS anchors,
  CAST(coalesce(t.n, 0) AS INTEGER) AS timeline, t.newest AS newest_entry, s.model, iid IN (SELECT conv_id FROM conversations) AS in_review
FROM l LEFT JOIN m ON m.issue_id = id LEFT JOIN a ON a.issue_id = id LEFT JOIN t ON t.issue_id = id LEFT JOIN summaries s ON s.issue_id = id""")
def issue_diagnostics(spark: SparkSession, sf: str) -> DataFrame:
    none = F.lit(None).cast("array<float>").alias("vec")
    reviews = table(spark, sf, "conversations").select(
        F.concat(F.lit("i"), F.col("conv_id").cast("string")).alias("issue_id"), F.lit("why").alias("reason")).distinct()
    rows = D.issue_diagnostics(
        issues(spark, sf).select("*", none), articles(spark, sf).select("*", none), anchors(spark, sf), timeline(spark, sf),
        summaries(spark, sf), reviews, now())
    count = lambda c: F.when(F.col(c).isNull(), 0).otherwise(F.size(c)).alias(c)
    return rows.select(
        "issue_id", "status", count("members"), F.col("members")[0]["aid"].alias("newest_member"), count("anchors"), count("timeline"),
        F.col("timeline")[0]["url"].alias("newest_entry"), F.col("summary.model").alias("model"), F.col("review").isNotNull().alias("in_review"))
