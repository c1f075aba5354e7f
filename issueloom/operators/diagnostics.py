"""Counts and listings that explain what a run decided."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.vectors import dot
from .lifecycle import LIVE
from .ordered import top_n
from .summary import ordered_list


def status_counts(issues: DataFrame) -> DataFrame:
    return issues.groupBy("status").agg(F.count(F.lit(1)).alias("n"))


def article_counts(articles: DataFrame) -> DataFrame:
    alone = ~F.col("is_dup") & F.col("issue_id").isNull()
    return articles.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if("is_dup").alias("dup"),
        F.count_if(~F.col("is_dup") & F.col("issue_id").isNotNull()).alias("assigned"),
        F.count_if(alone & (F.col("hold_count") > 0)).alias("held"),
        F.count_if(alone & (F.col("hold_count") == 0)).alias("unassigned"),
    )


def article_state() -> Column:
    return (
        F.when(F.col("is_dup"), "중복").when(F.col("issue_id").isNotNull(), "배정")
        .when(F.col("hold_count") > 0, "보류").otherwise("미배정")
    )


def article_listing(articles: DataFrame, now: Column, hours: int = 72, limit: int = 1500) -> DataFrame:
    recent = articles.filter(F.col("collected_at") >= now - F.expr(f"INTERVAL {hours} HOURS"))
    return recent.withColumn("state", article_state()).orderBy(F.col("collected_at").desc(), "aid").limit(limit)


def issue_members(articles: DataFrame, issues: DataFrame, per_issue: int = 50) -> DataFrame:
    """Newest members per issue with their similarity to the centroid."""
    newest = top_n(
        articles.filter(F.col("issue_id").isNotNull()), ["issue_id"], [F.col("published_at").desc(), F.col("aid")], per_issue
    )
    centroid = issues.select(F.col("iid").alias("issue_id"), F.col("vec").alias("_c"))
    return newest.join(centroid, "issue_id", "left").withColumn("sim_to_centroid", F.round(dot("vec", "_c"), 4)).drop("_c")


def issue_listing(issues: DataFrame, now: Column, days: int = 7, limit: int = 500) -> DataFrame:
    """Live issues and those archived lately, most important first."""
    lately = (F.col("status") == "archived") & (F.col("last_update") >= now - F.expr(f"INTERVAL {days} DAYS"))
    return issues.filter(F.col("status").isin("candidate", *LIVE) | lately).orderBy(
        F.col("importance").desc(), F.col("last_update").desc(), "id"
    ).limit(limit)


def issue_diagnostics(
    issues: DataFrame, articles: DataFrame, anchors: DataFrame, timeline: DataFrame, summaries: DataFrame, reviews: DataFrame,
    now: Column,
) -> DataFrame:
    """The listed issues with 50 members and their similarity, 20 anchors, 50 timeline rows, summary and review reason."""
    listed = issue_listing(issues, now)
    of_listed = lambda df: df.join(listed.select(F.col("id").alias("issue_id")), "issue_id", "left_semi")
    centroids = listed.select(F.col("id").alias("iid"), "vec")
    m = ordered_list(issue_members(of_listed(articles), centroids), "issue_id", "rn", F.struct("aid", "title", "is_dup", "sim_to_centroid"), "members")
    a = top_n(of_listed(anchors), ["issue_id"], [F.col("observed_at").desc(), F.col("seq").desc()], 20)
    a = ordered_list(a, "issue_id", "rn", F.struct("entity", "metric", "value", "unit", "prev", "period", "source", "trust"), "anchors")
    t = top_n(of_listed(timeline), ["issue_id"], [F.col("at").desc(), F.col("seq").desc()], 50)
    t = ordered_list(t, "issue_id", "rn", F.struct("kind", "title", "source", "url", "at"), "timeline")
    s = summaries.select("issue_id", F.struct("model", "title", "one_liner", "fact_hash").alias("summary"))
    r = reviews.select("issue_id", F.col("reason").alias("review"))
    out = listed.drop("vec").withColumnRenamed("id", "issue_id")
    for part in (m, a, t, s, r):
        out = out.join(part, "issue_id", "left")
    return out


def newest_runs(log: DataFrame, n: int = 20) -> DataFrame:
    return log.orderBy(F.col("at").desc(), F.col("run_id").desc()).limit(n)


def run_metadata(issues: DataFrame, articles: DataFrame, calls: DataFrame, reviews: DataFrame, thresholds: dict,
                 log: DataFrame | None = None, now: Column | None = None, current: dict | None = None, kept: int = 20) -> DataFrame:
    """One row: status counts, article counts, calls of the day, review queue size, thresholds, and the run log, newest first.

    `log` is (run_id, at, stats) and gives its newest `kept` runs; the counts of a cycle that is not in it yet stand in front.
    """
    by_status = status_counts(issues).agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("status", "n")))).alias("issue_counts")
    )
    arts = article_counts(articles).select(F.struct("*").alias("article_counts"))
    entry = "struct<at:timestamp,stats:string>"
    history = F.array().cast(f"array<{entry}>")
    if log is not None:
        newest = newest_runs(log, kept).agg(F.collect_list(F.struct("at", "run_id", F.col("stats").cast("string").alias("stats"))).alias("l"))
        history = newest.select(F.transform(F.sort_array("l", asc=False), lambda r: F.struct(r["at"].alias("at"), r["stats"].alias("stats")))).scalar()
    if current is not None:
        history = F.concat(F.array(F.struct(now.alias("at"), F.lit(str(current)).alias("stats"))), history)
    return arts.select(
        "article_counts",
        by_status.scalar().alias("issue_counts"),
        calls.select(F.max("calls")).scalar().alias("calls_today"),
        reviews.agg(F.count(F.lit(1))).scalar().alias("review_queue"),
        F.struct(*[F.lit(v).alias(k) for k, v in thresholds.items()]).alias("thresholds"),
        history.alias("history"),
    )
