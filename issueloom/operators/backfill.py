"""Past events: the articles around them and the rows to replay."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .ordered import spread_join, top_n


def around(events: DataFrame, articles: DataFrame, days: int = 3, per_event: int = 25) -> DataFrame:
    """Articles within +- days of an event of the same topic, the first per_event of each, with their rank.

    Event dates are whole days, so the list of a (topic, date) is the same for all its events: every article offers
    itself to the few dates it is close to, each date keeps its first rows on the map side, and events pick up a
    finished list. Nothing is paired inside a hot day.
    """
    start = F.to_date("published_at")
    reach = F.sequence(F.date_sub(start, days), F.date_add(start, days + 1))
    offered = articles.withColumn("date", F.explode(reach)).filter(
        F.col("published_at").between(
            F.col("date").cast("timestamp") - F.expr(f"INTERVAL {days} DAYS"),
            F.col("date").cast("timestamp") + F.expr(f"INTERVAL {days} DAYS"),
        )
    )
    wanted = events.select("topic", "date").distinct()
    near = spread_join(offered, wanted, ["topic", "date"], "left_semi", ["aid"])
    lists = top_n(near, ["topic", "date"], [F.col("published_at"), F.col("aid")], per_event, "rank")
    return spread_join(
        events, lists.select("topic", "date", "rank", "aid", "published_at"), ["topic", "date"], "inner", ["event_id"]
    )


def with_seed_articles(events: DataFrame, found: DataFrame, least: int = 2) -> DataFrame:
    """(event_id, url, origin): found articles, completed by the listed ones where fewer than `least` were found."""
    counts = found.groupBy("event_id").agg(F.count(F.lit(1)).alias("_n"))
    thin = events.join(counts, "event_id", "left").filter(F.coalesce("_n", F.lit(0)) < least)
    listed = thin.select("event_id", F.explode("articles").alias("url"), F.lit("listed").alias("origin"))
    return found.select("event_id", "url", F.lit("found").alias("origin")).unionByName(listed)


def replay_window(raw: DataFrame, now: Column, lookback_h: int) -> DataFrame:
    """Rows collected within the lookback; an unreadable time stays in."""
    return raw.filter(
        F.col("collected_at").isNull() | (F.col("collected_at") >= now - F.expr(f"INTERVAL {lookback_h} HOURS"))
    )
