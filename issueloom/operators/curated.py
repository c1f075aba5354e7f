"""Curated content package: integrity report, tier ranks and the published documents."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import glossary_terms, or_empty
from ..settings import CATEGORY_ICONS, DEFAULT_ICON, EFFECT_DIRECTIONS, STAT_DIRECTIONS, TIER_BASE
from .ordered import spread_join, with_rank
from .readmodel import spark_values


def integrity_report(issues: DataFrame, topics: DataFrame, visuals: DataFrame, categories: DataFrame,
                     glossary: DataFrame) -> DataFrame:
    """(rule, item, value) for every broken rule; an empty report releases the package."""
    def row(df: DataFrame, rule: str, item: str, value: Column) -> DataFrame:
        return df.select(F.lit(rule).alias("rule"), F.col(item).alias("item"), value.cast("string").alias("value"))

    def dangling(df: DataFrame, rule: str, item: str, ids: Column, known: DataFrame, key: str) -> DataFrame:
        wanted = df.select(F.col(item).alias("_item"), F.explode(ids).alias("_ref"))
        missing = spread_join(wanted, known.select(F.col(key).alias("_ref")).distinct(), ["_ref"], "left_anti", ["_item"])
        return row(missing, rule, "_item", F.col("_ref"))

    double = issues.groupBy("id").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
    bad = lambda rows, allowed: F.filter(F.transform(rows, lambda x: x["direction"]), lambda d: ~d.isin(*allowed))
    stats = issues.select("id", F.explode(bad("key_stats", STAT_DIRECTIONS)).alias("d"))
    effects = issues.select("id", F.explode(bad("effect_rows", EFFECT_DIRECTIONS)).alias("d"))
    links = topics.select("id", F.explode("timeline").alias("t")).select("id", F.col("t.issue_ids").alias("issue_ids"))
    parts = [
        row(double, "duplicate id", "id", F.col("n")),
        row(spread_join(issues, categories.select("category").distinct(), ["category"], "left_anti", ["id"]),
            "unknown category", "id", F.col("category")),
        row(issues.filter(~F.col("tier").isin(*TIER_BASE)), "unknown tier", "id", F.col("tier")),
        row(issues.filter(F.size("key_stats") != 2), "not two key stats", "id", F.size("key_stats")),
        row(stats, "unknown stat direction", "id", F.col("d")),
        row(effects, "unknown effect direction", "id", F.col("d")),
        dangling(issues, "unknown visual", "id", F.col("visual_ids"), visuals, "visual_id"),
        dangling(issues, "unknown topic", "id", F.col("topic_ids"), topics, "id"),
        dangling(topics, "unknown visual of topic", "id", F.col("visual_ids"), visuals, "visual_id"),
        dangling(links, "unresolved timeline link", "id", F.col("issue_ids"), issues, "id"),
        row(glossary.filter((or_empty("term") == "") | (or_empty("easy") == "")), "incomplete glossary entry", "term", F.col("easy")),
    ]
    return reduce(DataFrame.unionByName, parts)


def tier_scores(issues: DataFrame) -> DataFrame:
    """Importance = base of the tier + size of the tier - rank by event time, newest first (rank from 0)."""
    base = F.element_at(F.create_map(*[F.lit(x) for kv in TIER_BASE.items() for x in kv]), F.col("tier"))
    ranked = with_rank(issues, "tier", "event_at", "id")
    return ranked.withColumn("importance", (base + F.col("size") - F.col("rank") + 1).cast("long")).drop("rank", "size")


def resolved_visuals(items: DataFrame, visuals: DataFrame, key: str = "id") -> DataFrame:
    """(key, visuals, primary): visuals in listed order, each with the last values of its chart; primary is the first chart.

    The whole series stays in the table of visuals: it is not copied into every document that shows it.
    """
    wanted = items.select(key, F.posexplode("visual_ids").alias("pos", "visual_id"))
    # several series: the first one speaks for the chart
    series = F.when(F.size("series") > 0, F.col("series")).otherwise(F.get("series_multi", F.lit(0)))
    told = visuals.select("visual_id", "kind", spark_values(series).alias("spark"))
    found = spread_join(wanted, told, ["visual_id"], "inner", [key])
    entry = F.struct("pos", "visual_id", "kind", "spark")
    packed = found.groupBy(key).agg(F.array_sort(F.collect_list(entry)).alias("visuals"))
    charts = F.filter("visuals", lambda v: F.coalesce(v["kind"], F.lit("chart")) == "chart")
    return packed.withColumn("primary", F.get(charts, F.lit(0)))


def curated_cards(issues: DataFrame, visuals: DataFrame) -> DataFrame:
    scored = tier_scores(issues)
    shown = resolved_visuals(scored, visuals).select("id", "visuals", "primary")
    emoji = F.element_at(F.create_map(*[F.lit(x) for kv in CATEGORY_ICONS.items() for x in kv]), F.col("category"))
    return scored.join(shown, "id", "left").select(
        "id", "title", F.col("title").alias("one_liner"), "impact_line", "category", F.lit("active").alias("status"),
        F.lit("curated").alias("origin"), F.lit(1).cast("long").alias("sources"), "importance", "event_at", "tier",
        F.col("primary").isNotNull().alias("has_visual"), F.col("primary.spark").alias("spark"),
        F.coalesce(emoji, F.lit(DEFAULT_ICON)).alias("icon"), "key_stats", "effect_rows", "details", "visuals",
    )


def curated_details(cards: DataFrame, surfaces: dict[str, str]) -> DataFrame:
    """Cards with the text of the effects and the terms found anywhere in the document."""
    effects = F.transform("effect_rows", lambda r: r["text"])
    text = F.array_join(F.filter(F.concat(
        F.array(or_empty("title")), F.coalesce("details", F.array().cast("array<string>")), effects,
        F.array(or_empty("impact_line")),
    ), lambda p: or_empty(p) != ""), " ")
    return cards.withColumn("effects", effects).withColumn("terms", glossary_terms(text, surfaces))


def curated_topics(topics: DataFrame, visuals: DataFrame) -> DataFrame:
    shown = resolved_visuals(topics, visuals).select("id", "visuals", "primary")
    return topics.drop("visual_ids").join(shown, "id", "left")
