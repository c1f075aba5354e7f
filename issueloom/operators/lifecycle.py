"""Ageing, scoring, ranking and work selection of issues."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..settings import AUXILIARY_METRIC, Settings

LIVE = ["active", "stale"]


def aged_status(now: Column, s: Settings) -> Column:
    """active -> stale after stale_h, then anything live -> archived after archive_d."""
    stale = (F.col("status") == "active") & (F.col("last_update") < now - F.expr(f"INTERVAL {s.stale_h} HOURS"))
    old = F.col("status").isin("active", "stale", "candidate") & (
        F.col("last_update") < now - F.expr(f"INTERVAL {s.archive_d} DAYS")
    )
    return F.when(old, "archived").when(stale, "stale").otherwise(F.col("status"))


def magnitude(anchors: DataFrame, s: Settings) -> DataFrame:
    """(issue_id, magnitude): largest |value| times the factor of the first keyword in the metric, rounded half even."""
    factor = F.lit(None).cast("double")
    for word, weight in reversed(s.magnitude_factors):
        factor = F.when(F.coalesce(F.col("metric"), F.lit("")).contains(word), F.lit(weight)).otherwise(factor)
    weighted = anchors.filter(F.col("value").isNotNull()).select("issue_id", (F.abs("value") * factor).alias("w"))
    best = weighted.filter(F.col("w").isNotNull()).groupBy("issue_id").agg(F.max("w").alias("w"))
    return best.select("issue_id", F.least(F.lit(s.magnitude_cap), F.bround("w", 0)).cast("int").alias("magnitude"))


def recency_penalty(now: Column, s: Settings) -> Column:
    age_h = F.greatest(F.lit(0.0), (now.cast("double") - F.col("last_update").cast("double")) / 3600)
    steps = F.floor(age_h / s.recency_hours)
    return F.coalesce(F.least(F.lit(s.recency_cap).cast("long"), steps * s.recency_step), F.lit(0).cast("long"))


def importance(
    issues: DataFrame, anchors: DataFrame, articles: DataFrame, groups: dict[str, str], now: Column, s: Settings
) -> DataFrame:
    """(id, importance) of issues that are not archived. `groups` maps a dictionary key to its group."""
    weights = [x for c, w in s.category_weights.items() for x in (F.lit(c), F.lit(w))]
    weight = F.coalesce(F.element_at(F.create_map(*weights), F.col("category")), F.lit(s.category_weights["ETC"]))
    institutions = F.array(*[F.lit(k) for k, g in groups.items() if g == "institutions"]).cast("array<string>")
    companies = F.array(*[F.lit(k) for k, g in groups.items() if g in ("kr_companies", "us_companies")]).cast("array<string>")
    official = (
        articles.filter((F.col("tier") == "official") & ~F.col("is_dup") & F.col("issue_id").isNotNull())
        .select(F.col("issue_id").alias("id")).distinct().withColumn("_official", F.lit(True))
    )
    live = issues.filter(F.col("status").isin("candidate", *LIVE))
    rows = live.join(official, "id", "left").join(
        magnitude(anchors, s).withColumnRenamed("issue_id", "id"), "id", "left"
    )
    bonus = lambda cond, points: F.when(cond, F.lit(points)).otherwise(F.lit(0))
    score = (
        weight
        + bonus(F.arrays_overlap("keys", institutions), s.institution_bonus)
        + bonus(F.arrays_overlap("keys", companies), s.company_bonus)
        + F.least(F.coalesce("seen_sources", F.lit(0)) * s.source_per, F.lit(s.source_cap))
        + bonus((F.col("origin") == "official_event") | F.col("_official"), s.official_bonus)
        + F.coalesce("magnitude", F.lit(0))
        - recency_penalty(now, s)
    )
    return rows.select("id", F.greatest(F.lit(0).cast("long"), score).cast("long").alias("importance"))


def ranked_feed(issues: DataFrame, limit: int = 200) -> DataFrame:
    """Active before stale, then importance, then last update; ties by id."""
    return issues.filter(F.col("status").isin(*LIVE)).orderBy(
        F.when(F.col("status") == "active", 0).otherwise(1), F.col("importance").desc(), F.col("last_update").desc(), "id"
    ).limit(limit)


def work_order() -> list[Column]:
    lacking = F.col("model").isNull() | (F.col("model") == "template")
    return [F.when(lacking, 0).otherwise(1), F.col("importance").desc(), F.col("last_update").desc(), F.col("id")]


def work_split(issues: DataFrame, summaries: DataFrame, now: Column, calls_today: Column, s: Settings, capped: bool = True) -> DataFrame:
    """Live issues with their state this run: cached, backoff, process or deferred. Without a costly generator
    (capped=False) every candidate is processed.

    `issues` carries `fact_hash` of the current facts and `calls`, the attempts an issue will take. Only the first
    max_per_run candidates can be processed, so the running call count is a window over that bounded head.
    """
    last = summaries.select(
        F.col("issue_id").alias("id"), "model", F.col("fact_hash").alias("_old_hash"), F.col("created_at").alias("_made")
    )
    rows = issues.filter(F.col("status").isin(*LIVE)).join(last, "id", "left")
    cached = (F.col("_old_hash") == F.col("fact_hash")) & (F.col("model") != "template")
    waiting = (F.col("model") == "template") & (F.col("_made") > now - F.expr(f"INTERVAL {s.template_retry_h} HOURS"))
    rows = rows.withColumn(
        "_first", F.when(F.coalesce(cached, F.lit(False)), "cached").when(F.coalesce(waiting, F.lit(False)), "backoff").otherwise("candidate")
    )
    if not capped:
        state = F.when(F.col("_first") == "candidate", "process").otherwise(F.col("_first"))
        return rows.withColumn("work_state", state).drop("_first", "_old_hash", "_made")
    head = rows.filter(F.col("_first") == "candidate").orderBy(*work_order()).limit(s.max_per_run)
    before = W.partitionBy(F.lit(0)).orderBy(*work_order()).rowsBetween(W.unboundedPreceding, -1)
    granted = head.withColumn("_before", F.coalesce(F.sum("calls").over(before), F.lit(0)) + calls_today).filter(
        F.col("_before") < s.daily_cap
    ).select("id", F.lit(True).alias("_granted"))
    state = F.when(F.col("_first") != "candidate", F.col("_first")).when(F.col("_granted"), "process").otherwise("deferred")
    return rows.join(granted, "id", "left").withColumn("work_state", state).drop("_first", "_granted", "_old_hash", "_made")


def calls_on(run_log: DataFrame, now: Column) -> DataFrame:
    return run_log.filter(F.to_date("at") == F.to_date(now)).agg(F.coalesce(F.sum("calls"), F.lit(0)).cast("long").alias("calls"))


def repair_period(period) -> Column:
    """Report codes that slipped into a period become quarters (fixed codes)."""
    p = F.col(period) if isinstance(period, str) else period
    code = F.substring(p, 6, 5)
    quarter = (
        F.when(code == "11013", "1Q").when(code == "11012", "2Q").when(code == "11014", "3Q").when(code == "11011", "4Q")
    )
    coded = (F.length(p) == 10) & (F.substring(p, 5, 1) == "-") & quarter.isNotNull()
    return F.when(coded, F.concat(F.substring(p, 1, 4), F.lit("-"), quarter)).otherwise(p)


def repair_summaries(summaries: DataFrame) -> DataFrame:
    return summaries.withColumn("why_now", F.when(F.col("model") != "template", F.col("why_now")))


def repair_issues(issues: DataFrame, members: DataFrame, anchors: DataFrame, limit: int = 80) -> DataFrame:
    """Oversized clusters are archived; currency issues that own an oil anchor become COMMODITY."""
    oil = anchors.filter(F.col("entity").isin("WTI", "브렌트유") | F.col("metric").contains("유가"))
    oil = oil.select(F.col("issue_id").alias("id")).distinct().withColumn("_oil", F.lit(True))
    rows = issues.join(members.select(F.col("issue_id").alias("id"), "members"), "id", "left").join(oil, "id", "left")
    huge = (F.col("origin") == "cluster") & (F.coalesce("members", F.lit(0)) > limit)
    return (
        rows.withColumn("status", F.when(huge, "archived").otherwise(F.col("status")))
        .withColumn("category", F.when((F.col("category") == "FX") & F.col("_oil"), "COMMODITY").otherwise(F.col("category")))
        .drop("members", "_oil")
    )
