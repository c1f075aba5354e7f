"""Queries on lifecycle, importance, ranking and work selection."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ...operators import cluster as C, lifecycle as L
from ...operators.dedup import member_counts
from ...settings import Settings
from . import query, table
from .views import ANCHORS, ARTICLES, ISSUES, NOW, SUMMARIES, anchors, articles, issues, now, summaries

CUT = f"TIMESTAMP '{NOW}'"
S = Settings()
GROUPS = {"N1": "institutions", "N7": "institutions", "SM": "kr_companies", "N3": "us_companies", "N4": "indices"}


@query("lifecycle_status", f"""
WITH {ISSUES}
SELECT id, CASE WHEN status IN ('active', 'stale', 'candidate') AND last_update < {CUT} - INTERVAL 30 DAY THEN 'archived'
  WHEN status = 'active' AND last_update < {CUT} - INTERVAL 72 HOUR THEN 'stale' ELSE status END AS status FROM issues""")
def lifecycle_status(spark: SparkSession, sf: str) -> DataFrame:
    return issues(spark, sf).select("id", L.aged_status(now(), S).alias("status"))


MAGNITUDE = f"""
{ANCHORS},
mag AS (SELECT issue_id AS id, CAST(least(40, round_even(max(abs(value) * CASE WHEN contains(metric, '변동폭') THEN 0.4 WHEN contains(metric, '상승률') THEN 1.2
  WHEN contains(metric, '급등') THEN 1.2 WHEN contains(metric, '변동') THEN 0.4 END), 0)) AS INTEGER) AS magnitude FROM anchors GROUP BY 1)
"""


@query("magnitude", f"WITH {MAGNITUDE} SELECT id AS issue_id, magnitude FROM mag WHERE magnitude IS NOT NULL")
def magnitude(spark: SparkSession, sf: str) -> DataFrame:
    return L.magnitude(anchors(spark, sf), S)


@query("importance", f"""
WITH {ISSUES}, {MAGNITUDE}, {ARTICLES},
off AS (SELECT DISTINCT issue_id AS id FROM articles WHERE tier = 'official' AND NOT is_dup AND issue_id IS NOT NULL)
SELECT id, CAST(greatest(0,
   CASE category WHEN 'RATE' THEN 100 WHEN 'MARKET' THEN 55 WHEN 'EARNINGS' THEN 40 WHEN 'FX' THEN 60 ELSE 10 END
   + CASE WHEN list_has_any(keys, ['N1', 'N7']) THEN 30 ELSE 0 END + CASE WHEN list_has_any(keys, ['SM', 'N3']) THEN 25 ELSE 0 END
   + least(seen_sources * 5, 25) + CASE WHEN origin = 'official_event' OR off.id IS NOT NULL THEN 10 ELSE 0 END + coalesce(magnitude, 0)
   - least(30, CAST(floor(greatest(0, epoch({CUT}) - epoch(last_update)) / 3600 / 24) AS BIGINT) * 5)) AS BIGINT) AS importance
FROM issues LEFT JOIN mag USING (id) LEFT JOIN off USING (id) WHERE status <> 'archived'""")
def importance(spark: SparkSession, sf: str) -> DataFrame:
    return L.importance(issues(spark, sf), anchors(spark, sf), articles(spark, sf), GROUPS, now(), S)


@query("ranked_feed", f"""
WITH {ISSUES} SELECT id, status, importance FROM issues WHERE status IN ('active', 'stale')
ORDER BY CASE status WHEN 'active' THEN 0 ELSE 1 END, importance DESC, last_update DESC, id LIMIT 200""")
def ranked_feed(spark: SparkSession, sf: str) -> DataFrame:
    return L.ranked_feed(issues(spark, sf)).select("id", "status", "importance")


WORK = f"""
{ISSUES}, {SUMMARIES},
w AS (SELECT i.*, 'h' || (iid // 4) AS facts, CAST(1 + seen_sources % 2 AS BIGINT) AS calls, s.model, s.fact_hash AS old_hash, s.created_at AS made
      FROM issues i LEFT JOIN summaries s ON s.issue_id = i.id WHERE status IN ('active', 'stale'))
"""


@query("work_queue", f"""
WITH {WORK} SELECT id, model IS NULL OR model = 'template' AS lacking, importance, strftime(last_update, '%Y-%m-%d') AS last_update FROM w
ORDER BY CASE WHEN lacking THEN 0 ELSE 1 END, importance DESC, w.last_update DESC, id""")
def work_queue(spark: SparkSession, sf: str) -> DataFrame:
    """All live issues in working order: a range-partitioned sort."""
    s = summaries(spark, sf).select(F.col("issue_id").alias("id"), "model")
    rows = issues(spark, sf).filter(F.col("status").isin(*L.LIVE)).join(s, "id", "left").orderBy(*L.work_order())
    lacking = F.col("model").isNull() | (F.col("model") == "template")
    return rows.select("id", lacking.alias("lacking"), "importance", F.date_format("last_update", "yyyy-MM-dd").alias("last_update"))


@query("work_split", f"""
WITH {WORK},
st AS (SELECT *, CASE WHEN old_hash = facts AND model <> 'template' THEN 'cached'
    WHEN model = 'template' AND made > {CUT} - INTERVAL 3 HOUR THEN 'backoff' ELSE 'candidate' END AS first FROM w),
r AS (SELECT *, row_number() OVER ord AS rn, coalesce(sum(calls) OVER (ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + 250 AS before
      FROM st WHERE first = 'candidate' WINDOW ord AS (ORDER BY CASE WHEN model IS NULL OR model = 'template' THEN 0 ELSE 1 END, importance DESC, last_update DESC, id))
SELECT id, first AS work_state FROM st WHERE first <> 'candidate'
UNION ALL SELECT id, CASE WHEN rn <= 40 AND before < 300 THEN 'process' ELSE 'deferred' END FROM r""")
def work_split(spark: SparkSession, sf: str) -> DataFrame:
    rows = issues(spark, sf).withColumn("fact_hash", F.concat(F.lit("h"), F.floor(F.col("iid") / 4).cast("string"))).withColumn(
        "calls", (1 + F.col("seen_sources") % 2).cast("long"))
    return L.work_split(rows, summaries(spark, sf), now(), F.lit(250), S).select("id", "work_state")


@query("calls_today", """
SELECT CAST(coalesce(sum(CAST(value AS BIGINT)), 0) AS BIGINT) AS calls FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-15'""")
def calls_today(spark: SparkSession, sf: str) -> DataFrame:
    log = table(spark, sf, "events").select(F.col("ts").alias("at"), F.rint("value").cast("long").alias("calls"))
    return L.calls_on(log, F.lit("2024-01-15 10:00:00").cast("timestamp"))


@query("repair_periods", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN l_linenumber <= 4 THEN year(l_shipdate) || '-' || CASE l_linenumber WHEN 1 THEN '1Q' WHEN 2 THEN '2Q'
  WHEN 3 THEN '3Q' ELSE '4Q' END WHEN l_linenumber = 5 THEN year(l_shipdate) || '-11099' ELSE strftime(l_shipdate, '%Y-%m') END AS period FROM lineitem""")
def repair_periods(spark: SparkSession, sf: str) -> DataFrame:
    n, y = F.col("l_linenumber"), F.year("l_shipdate").cast("string")
    code = F.when(n == 1, "11013").when(n == 2, "11012").when(n == 3, "11014").when(n == 4, "11011").when(n == 5, "11099")
    raw = F.when(n <= 5, F.concat_ws("-", y, code)).otherwise(F.date_format("l_shipdate", "yyyy-MM"))
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", L.repair_period(raw).alias("period"))


@query("repairs", f"""
WITH {ISSUES}, {ANCHORS}, {ARTICLES},
m AS (SELECT issue_id AS id, count(*) FILTER (NOT is_dup) AS n FROM articles WHERE issue_id IS NOT NULL GROUP BY 1),
oil AS (SELECT DISTINCT issue_id AS id FROM anchors WHERE entity = 'WTI' OR metric LIKE '%상승률%')
SELECT id, CASE WHEN origin = 'cluster' AND coalesce(n, 0) > 12 THEN 'archived' ELSE status END AS status,
  CASE WHEN category = 'FX' AND oil.id IS NOT NULL THEN 'COMMODITY' ELSE category END AS category
FROM issues LEFT JOIN m USING (id) LEFT JOIN oil USING (id)""")
def repairs(spark: SparkSession, sf: str) -> DataFrame:
    oil = anchors(spark, sf).withColumn("metric", F.replace("metric", F.lit("상승률"), F.lit("유가")))
    rows = L.repair_issues(issues(spark, sf), member_counts(articles(spark, sf)), oil, 12)
    return rows.select("id", "status", "category")


@query("repair_summaries", f"WITH {SUMMARIES} SELECT issue_id, CASE WHEN model <> 'template' THEN why_now END AS why_now FROM summaries")
def repair_summaries(spark: SparkSession, sf: str) -> DataFrame:
    return L.repair_summaries(summaries(spark, sf)).select("issue_id", "why_now")


MEMBERS = f"""
{ISSUES}, {ARTICLES},
m AS (SELECT issue_id, count(*) FILTER (NOT is_dup) AS members FROM articles GROUP BY issue_id)
"""
OPEN = f"{ARTICLES}, o AS (SELECT * FROM articles WHERE issue_id IS NULL AND collected_at >= TIMESTAMP '{NOW}' - INTERVAL 2000 DAY AND lang = 'en')"
WINDOW = Settings(active_window_h=24 * 1200, seed_pool_ttl_h=24 * 2000, max_members=12)


@query("eligible_issues", f"""
WITH {MEMBERS} SELECT id FROM issues LEFT JOIN m ON m.issue_id = id
WHERE status IN ('candidate', 'active') AND last_update > TIMESTAMP '{NOW}' - INTERVAL 1200 DAY AND seen_sources <> 3 AND coalesce(members, 0) < 12""")
def eligible_issues(spark: SparkSession, sf: str) -> DataFrame:
    """Issues that take articles: live enough, with a centroid (those of three sources have none here) and with room."""
    counts = member_counts(articles(spark, sf)).select(F.col("issue_id").alias("id"), "members")
    rows = issues(spark, sf).withColumn("vec", F.when(F.col("seen_sources") != 3, F.array(F.lit(1.0).cast("float"))))
    return C.eligible_issues(rows.join(counts, "id", "left").fillna(0, ["members"]), now(), WINDOW).select("id")


def _open(spark, sf):
    rows = articles(spark, sf).withColumn("vec", F.when(F.col("lang") == "en", F.array(F.lit(1.0).cast("float"))))
    return C.open_articles(rows, now(), WINDOW)


@query("open_articles", f"WITH {OPEN} SELECT aid FROM o")
def open_articles(spark: SparkSession, sf: str) -> DataFrame:
    """Articles of no issue that still count: recent, with a vector (those in one language have none here)."""
    return _open(spark, sf).select("aid")


@query("seed_pool", f"WITH {OPEN} SELECT aid FROM o WHERE hold_count = 0 OR hold_count >= 2")
def seed_pool(spark: SparkSession, sf: str) -> DataFrame:
    """Open articles that may seed an issue: never held, or held until their tries were over."""
    return C.seed_pool(_open(spark, sf), WINDOW).select("aid")
