"""Published read models: cards, details, topics and the index."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import display_number, glossary_terms, hangul_share, hanja_to_hangul, is_foreign, or_empty
from ..settings import AUXILIARY_METRIC, CATEGORY_ICONS, DEFAULT_ICON
from .glossary import union_terms
from .lifecycle import LIVE
from .ordered import spread_join, top_n
from .summary import ordered_list

SCHEMA_VERSION = 3


def newest_anchor(anchors: DataFrame) -> DataFrame:
    """(issue_id, a): newest anchor with a value that is not an auxiliary one."""
    usable = anchors.filter(F.col("value").isNotNull() & (F.col("metric") != AUXILIARY_METRIC))
    picked = F.max_by(F.struct("entity", "metric", "value", "unit", "prev", "trust", "period"), F.struct("observed_at", "seq"))
    return usable.groupBy("issue_id").agg(picked.alias("a"))


def headline_stat(anchors: DataFrame) -> DataFrame:
    """(issue_id, label, value, unit, direction, delta_text, prev_text) as shown on a card."""
    a, unit = F.col("a"), or_empty("a.unit")
    delta = F.col("a.value") - F.col("a.prev")
    sign = F.when(delta > 0, "+").when(delta < 0, "-").otherwise("±")
    delta_unit = F.when(unit == "%", "%p").otherwise(unit)
    return newest_anchor(anchors).select(
        "issue_id",
        F.trim(F.concat_ws(" ", "a.entity", "a.metric")).alias("label"),
        display_number("a.value").alias("value"),
        unit.alias("unit"),
        F.when(delta > 0, "up").when(delta < 0, "down").otherwise("flat").alias("direction"),
        F.when(delta.isNotNull(), F.concat(sign, display_number(F.abs(delta)), delta_unit)).alias("delta_text"),
        F.when(F.col("a.prev").isNotNull(), F.concat(F.lit("직전 "), display_number("a.prev"), unit)).alias("prev_text"),
    )


def spark_values(series) -> Column:
    """Last 8 numeric values of a chart series of structs (t, v); null with fewer than 2."""
    values = F.array_compact(F.transform(series, lambda p: p["v"]))
    n = F.size(values)
    return F.when(n >= 2, F.slice(values, F.greatest(F.lit(1), n - 7), 8))


def icon(entity_icons: dict[str, str]) -> Column:
    by_key = F.lit(None).cast("string")
    if entity_icons:
        table = F.create_map(*[F.lit(x) for kv in entity_icons.items() for x in kv])
        by_key = F.get(F.array_compact(F.transform("keys", lambda k: F.element_at(table, k))), F.lit(0))
    by_category = F.element_at(F.create_map(*[F.lit(x) for kv in CATEGORY_ICONS.items() for x in kv]), F.col("category"))
    return F.coalesce(by_key, by_category, F.lit(DEFAULT_ICON))


def related(issues: DataFrame, pool: int = 60, limit: int = 5) -> DataFrame:
    """(id, related): up to 5 of the 60 most important other live issues that share a key or the category.

    The pool is 61 rows whatever the table size, so it travels as one array value and every issue picks from it
    in a narrow step.
    """
    top = (
        issues.filter(F.col("status").isin(*LIVE))
        .orderBy(F.col("importance").desc(), F.col("last_update").desc(), "id").limit(pool + 1)
    )
    entry = F.struct(
        (-F.col("importance")).alias("o1"), (-F.unix_micros("last_update")).alias("o2"), "id",
        hanja_to_hangul("canonical_title").alias("title"), "category", "keys",
    )
    heads = top.agg(F.array_sort(F.collect_list(entry)).alias("heads")).scalar()
    others = F.slice(F.filter("_heads", lambda h: h["id"] != F.col("id")), 1, pool)
    alike = F.filter(
        "_others", lambda h: (h["category"] == F.col("category")) | F.arrays_overlap(h["keys"], F.col("keys"))
    )
    shown = F.transform(F.slice("_alike", 1, limit), lambda h: F.struct(
        h["id"].alias("id"), h["title"].alias("title"), h["category"].alias("category"),
        F.array_sort(F.array_intersect(h["keys"], F.col("keys"))).alias("shared"),
    ))
    return (
        issues.withColumn("_heads", heads).withColumn("_others", others).withColumn("_alike", alike)
        .select("id", shown.alias("related"))
    )


def consistent(anchor: Column, words: Column, tol: Column, last_t: Column, last_v: Column) -> Column:
    """Whether a chart may be shown beside the newest anchor.

    Only an official anchor of the same measure and period is compared with the last chart value.
    """
    metric = F.lower(or_empty(anchor["metric"]))
    same_measure = F.exists(words, lambda w: metric.contains(F.lower(w)))
    period, t = or_empty(anchor["period"]), or_empty(last_t)
    other_period = (period != "") & (t != "") & ~(t.startswith(period) | period.startswith(F.left(t, F.length(period))))
    close = F.abs(anchor["value"] - last_v) <= tol * F.greatest(F.abs(last_v), F.lit(1e-9))
    skip = (
        words.isNull() | last_v.isNull() | anchor.isNull() | (F.coalesce(anchor["trust"], F.lit("")) != "official")
        | ~F.coalesce(same_measure, F.lit(False)) | other_period
    )
    return F.when(skip, F.lit(True)).otherwise(close)


def event_times(issues: DataFrame, timeline: DataFrame) -> DataFrame:
    latest = timeline.groupBy(F.col("issue_id").alias("id")).agg(F.max("at").alias("_at"))
    return issues.join(latest, "id", "left").withColumn("event_at", F.coalesce("_at", "created_at")).drop("_at")


def cards(issues: DataFrame, summaries: DataFrame, timeline: DataFrame, anchors: DataFrame, charts: DataFrame,
          entity_icons: dict[str, str] | None = None) -> DataFrame:
    """One row per issue. `charts` is (issue_id, visual_type, series, words, tol), resolved for the issue's category."""
    stat = headline_stat(anchors).select(F.col("issue_id").alias("id"), F.struct(
        "label", "value", "unit", "direction", "delta_text", "prev_text").alias("headline_stat"))
    last = F.element_at("series", -1)
    anchor = newest_anchor(anchors)
    shown = charts.join(anchor, "issue_id", "left").filter(
        consistent(F.col("a"), F.col("words"), F.col("tol"), last["t"], last["v"])
    ).select(F.col("issue_id").alias("id"), F.lit(True).alias("has_visual"), spark_values(F.col("series")).alias("spark"))
    s = summaries.select(
        F.col("issue_id").alias("id"), F.col("title").alias("_title"), F.col("one_liner").alias("_one"), "why_now",
        "impact_line",
    )
    fallback = hanja_to_hangul("canonical_title")
    rows = event_times(issues, timeline).join(s, "id", "left").join(stat, "id", "left").join(shown, "id", "left")
    nonblank = lambda c: F.when(or_empty(c) != "", F.col(c))
    return rows.select(
        "id", F.coalesce(nonblank("_title"), fallback).alias("title"), F.coalesce(nonblank("_one"), fallback).alias("one_liner"),
        "why_now", "impact_line", fallback.alias("raw_title"), "category", "status", "origin",
        F.col("seen_sources").alias("sources"), "importance", "last_update", "event_at",
        F.coalesce("has_visual", F.lit(False)).alias("has_visual"), "headline_stat", "spark",
        icon(entity_icons or {}).alias("icon"),
    )


def shown_rows(rows: DataFrame, newest: int, keep: int, order: list[Column]) -> DataFrame:
    """Per issue the newest rows, foreign-script titles dropped, then the first `keep`, with rank `rn`."""
    recent = top_n(rows, ["issue_id"], order, newest, "_n")
    tidy = recent.withColumn("title", hanja_to_hangul("title")).filter(~is_foreign("title"))
    return top_n(tidy, ["issue_id"], [F.col("_n")], keep).drop("_n")


def detail_lists(timeline: DataFrame, articles: DataFrame, anchors: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Timeline (40 -> 30), headlines (20 -> 10) and distinct anchors (12) per issue, as ordered lists."""
    t = shown_rows(timeline, 40, 30, [F.col("at").desc(), F.col("seq").desc()])
    t = ordered_list(t, "issue_id", "rn", F.struct("kind", "title", "source", "url", "at"), "timeline")
    members = articles.filter(F.col("issue_id").isNotNull() & ~F.col("is_dup"))
    h = shown_rows(members, 20, 10, [F.col("published_at").desc(), F.col("aid")])
    h = ordered_list(h, "issue_id", "rn", F.struct("title", "source", "url", "published_at", "lang"), "headlines")
    current = anchors.groupBy("issue_id", "entity", "metric", "period").agg(
        F.max_by(F.struct("value", "unit", "prev", "source", "observed_at"), "seq").alias("x"), F.max("seq").alias("seq")
    )
    a = top_n(current, ["issue_id"], [F.col("x.observed_at").desc(), F.col("seq").desc()], 12)
    a = ordered_list(a, "issue_id", "rn", F.struct(
        "entity", "metric", "x.value", "x.unit", "x.prev", "period", "x.source"), "anchors")
    return t, h, a


def details(card_rows: DataFrame, lists: tuple[DataFrame, DataFrame, DataFrame], summaries: DataFrame,
            links: DataFrame) -> DataFrame:
    out = card_rows
    for part in lists:
        out = out.join(part.withColumnRenamed("issue_id", "id"), "id", "left")
    s = summaries.select(F.col("issue_id").alias("id"), "details", "effects", "model")
    return out.join(s, "id", "left").join(links, "id", "left")


TERM = "array<struct<term:string,easy:string,example:string>>"


def with_glossary(rows: DataFrame, summaries: DataFrame, surfaces: dict[str, str], entries: dict[str, tuple[str, str]]) -> DataFrame:
    """Details with `glossary`: reviewed terms found in the title, the line, the reason and the paragraphs, then generated ones
    under new names. `entries` maps a term to (easy, example); both dictionaries are configuration."""
    told = summaries.select(F.col("issue_id").alias("id"), F.col("glossary").cast(TERM).alias("_generated"))
    text = F.array_join(F.filter(F.concat(F.array(or_empty("title"), or_empty("one_liner"), or_empty("why_now")),
                                          F.coalesce("details", F.array().cast("array<string>"))), lambda p: or_empty(p) != ""), " ")
    known = {t: e for t, e in entries.items() if t in set(surfaces.values())}
    pairs = [x for t, (easy, example) in known.items() for x in (F.lit(t), F.struct(F.lit(easy).alias("easy"), F.lit(example).alias("example")))]
    found = F.array().cast(TERM)
    if pairs:
        table = F.create_map(*pairs)
        found = F.transform(F.filter(glossary_terms(text, surfaces), lambda t: F.map_contains_key(table, t)), lambda t: F.struct(
            t.alias("term"), F.element_at(table, t)["easy"].alias("easy"), F.element_at(table, t)["example"].alias("example")))
    joined = rows.join(told, "id", "left")
    generated = F.transform(F.coalesce("_generated", F.array().cast(TERM)), lambda g: F.struct(
        F.trim(or_empty(g["term"])).alias("term"), or_empty(g["easy"]).alias("easy"), or_empty(g["example"]).alias("example")))
    return joined.withColumn("glossary", union_terms(found, generated)).drop("_generated")


def with_visual(rows: DataFrame, charts: DataFrame) -> DataFrame:
    """Details with `visual`, the chart that the card announces: one that its consistency rule refused is absent here too."""
    shown = charts.select(F.col("issue_id").alias("id"), F.struct(
        *[c for c in ("visual_type", "chart", "unit", "source", "series", "groups") if c in charts.columns]).alias("_visual"))
    joined = rows.join(shown, "id", "left")
    return joined.withColumn("visual", F.when(F.col("has_visual"), F.col("_visual"))).drop("_visual")


def publishable(issues: DataFrame, summaries: DataFrame, anchors: DataFrame, sources: DataFrame) -> DataFrame:
    """Issues with `publish`: generated summary, else readable title, else some economic signal, else 2 sources."""
    s = summaries.select(F.col("issue_id").alias("id"), F.col("title").alias("_title"), F.col("model").alias("_model"))
    a = anchors.groupBy(F.col("issue_id").alias("id")).agg(F.count(F.lit(1)).alias("_anchors"))
    n = sources.select(F.col("issue_id").alias("id"), F.col("seen_sources").alias("_sources"))
    rows = issues.join(s, "id", "left").join(a, "id", "left").join(n, "id", "left")
    anchored = F.coalesce("_anchors", F.lit(0)) > 0
    shown = F.when(or_empty("_title") != "", F.col("_title")).otherwise(or_empty("canonical_title"))
    keep = (
        F.when((or_empty("_model") != "") & (F.col("_model") != "template"), F.lit(True))
        .when(hangul_share(shown) < 0.3, F.lit(False))
        .when(~anchored & (F.size("keys") == 0) & (F.col("category") == "ETC"), F.lit(False))
        .when(anchored, F.lit(True))
        .otherwise(F.coalesce("_sources", F.lit(0)) >= 2)
    )
    return rows.withColumn("publish", keep).drop("_title", "_model", "_anchors", "_sources")


def latest_match(rules: list[dict], issues: DataFrame) -> DataFrame:
    """(rule_id, id): the newest live issue per rule, by event time, then last update.

    A rule names any of categories, keywords and entities (all named kinds must match, one entry of each suffices),
    or pins an id or anchor key. Rules are configuration, so all are tested in one pass over the issues.
    """
    def matches(rule: dict) -> Column:
        if rule.get("issue_id"):
            return F.col("id") == rule["issue_id"]
        if rule.get("anchor_key"):
            return F.col("anchor_key") == rule["anchor_key"]
        ok = F.lit(True)
        if rule.get("categories"):
            ok = ok & F.col("category").isin(*rule["categories"])
        if rule.get("keywords"):
            text = F.lower(F.concat_ws(" ", or_empty("canonical_title"), or_empty("summary_title")))
            hit = F.lit(False)
            for k in rule["keywords"]:
                hit = hit | text.contains(k.lower())
            ok = ok & hit
        if rule.get("entities"):
            ok = ok & F.arrays_overlap("keys", F.array(*[F.lit(e) for e in rule["entities"]]))
        return ok

    live = issues.filter(F.col("status").isin(*LIVE))
    hits = F.array_compact(F.array(*[F.when(matches(r), F.lit(r["rule_id"])) for r in rules]))
    wanted = live.withColumn("rule_id", F.explode(hits))
    order = F.struct("event_at", "last_update", "id")
    return wanted.groupBy("rule_id").agg(F.max_by(F.struct("id", "canonical_title", "last_update"), order).alias("b")).select(
        "rule_id", "b.id", "b.canonical_title", "b.last_update"
    )


def live_refs(paragraphs: DataFrame, issues: DataFrame) -> DataFrame:
    """Paragraphs (topic, pos, text, refs) with the references whose phrase occurs and whose issue is live.

    A reference names an issue id or an anchor key.
    """
    live = issues.filter(F.col("status").isin(*LIVE))
    ids = live.select(F.col("id").alias("_id")).distinct()
    anchors = live.filter(F.col("anchor_key").isNotNull()).groupBy("anchor_key").agg(F.min("id").alias("_by_anchor"))
    # phrases are looked for where the paragraph lies; its text is neither repeated for each reference nor shuffled for them
    told = F.filter("refs", lambda r: (or_empty(r["phrase"]) != "") & F.col("text").contains(r["phrase"]))
    refs = paragraphs.select("topic", "pos", F.posexplode(told).alias("n", "r"))
    refs = refs.withColumn("anchor_key", F.col("r.anchor_key"))
    refs = spread_join(refs, anchors, ["anchor_key"], "left", ["topic", "pos", "n"])
    good = refs.withColumn("issue_id", F.coalesce("r.issue_id", "_by_anchor")).join(
        ids, F.col("issue_id") == F.col("_id"), "left_semi"
    )
    kept = good.groupBy("topic", "pos").agg(
        F.array_sort(F.collect_list(F.struct("n", F.col("r.phrase").alias("phrase"), "issue_id"))).alias("refs")
    )
    return paragraphs.drop("refs").filter(or_empty("text") != "").join(kept, ["topic", "pos"], "left")


def table_rows(columns, rows) -> Column:
    """Rows of a curated table that have one cell per column; null when columns or rows are empty."""
    c, r = F.col(columns), F.col(rows)
    kept = F.filter(r, lambda x: F.size(x) == F.size(c))
    return F.when((F.size(c) > 0) & (F.size(kept) > 0), kept)


def orphaned(published: DataFrame, live: DataFrame, key: str = "id") -> DataFrame:
    """Published details whose issue is no longer live."""
    return published.join(live.select(key), key, "left_anti")


def topic_documents(topics: DataFrame, paragraphs: DataFrame, issues: DataFrame, charts: DataFrame | None = None) -> DataFrame:
    """Steady topics as published: (id, pos, icon, title, one_liner, status_note, impact, table, visual, latest_issue, detail).

    `topics` is (id, pos, icon, title, one_liner, status_note, impact array, columns array, cells array of arrays, visual_type,
    rule array of at most one struct(categories, keywords, entities, issue_id, anchor_key)); rows without id or title are left out.
    `paragraphs` is (topic, pos, text, refs) and keeps only references whose phrase occurs and whose issue is live. `issues` carry
    event_at and summary_title. Topics are curated by hand; all their rules are tested in one pass over the issues.
    """
    usable = topics.filter((or_empty("id") != "") & (or_empty("title") != ""))
    rules = [{"rule_id": r["id"], **{k: v for k, v in r["rule"][0].asDict().items() if v}}
             for r in usable.filter(F.size("rule") > 0).select("id", "rule").collect()]  # configuration, a row a topic
    out = usable.select(
        "id", "pos", "icon", "title", or_empty("one_liner").alias("one_liner"), "status_note", "visual_type",
        F.filter(F.coalesce("impact", F.array().cast("array<string>")), lambda x: F.trim(or_empty(x)) != "").alias("impact"),
        F.struct("columns", table_rows("columns", "cells").alias("rows")).alias("_table"))
    out = out.withColumn("table", F.when(F.col("_table.rows").isNotNull(), F.col("_table"))).drop("_table")
    if rules:
        latest = latest_match(rules, issues).select(F.col("rule_id").alias("id"), F.struct(
            F.col("id"), hanja_to_hangul("canonical_title").alias("title"), "last_update").alias("latest_issue"))
        out = out.join(latest, "id", "left")
    else:
        out = out.withColumn("latest_issue", F.lit(None).cast("struct<id:string,title:string,last_update:timestamp>"))
    lines = live_refs(paragraphs, issues).groupBy(F.col("topic").alias("id")).agg(
        F.array_sort(F.collect_list(F.struct("pos", "text", "refs"))).alias("_l"))
    shown = F.transform("_l", lambda x: F.struct(x["text"].alias("text"), F.transform(
        x["refs"], lambda r: F.struct(r["phrase"].alias("phrase"), r["issue_id"].alias("issue_id"))).alias("refs")))
    out = out.join(lines, "id", "left").withColumn("detail", shown).drop("_l")
    if charts is None:
        return out.withColumn("visual", F.lit(None).cast("string")).drop("visual_type")
    return out.join(charts.select("visual_type", F.struct(*charts.columns).alias("visual")), "visual_type", "left").drop("visual_type")


def index_document(cards: DataFrame, now: Column, attribution: str, topics: DataFrame | None = None) -> DataFrame:
    """One row: version, time, sources named, the published cards in rank order (at most the 200 of the feed) and the topics in
    their own order (`pos`). Both lists are bounded: the feed by its limit, topics as they are written by hand."""
    order = F.struct(F.when(F.col("status") == "active", 0).otherwise(1).alias("s"), (-F.col("importance")).alias("i"),
                     (-F.unix_micros("last_update")).alias("u"), F.col("id").alias("d"))
    packed = F.array_sort(F.collect_list(F.struct(order.alias("o"), F.to_json(F.struct(*cards.columns)).alias("card"))))
    listed = F.lit(None).cast("array<string>")
    if topics is not None:
        place = F.struct(F.col("pos").alias("p"), F.col("id").alias("d")) if "pos" in topics.columns else F.struct(F.col("id").alias("d"))
        document = F.to_json(F.struct(*[c for c in topics.columns if c != "pos"]))
        one = topics.agg(F.array_sort(F.collect_list(F.struct(place.alias("o"), document.alias("t")))).alias("l"))
        listed = one.select(F.transform("l", lambda x: x["t"])).scalar()
    return cards.agg(F.transform(packed, lambda x: x["card"]).alias("issues")).select(
        F.lit(SCHEMA_VERSION).alias("schema_version"), now.alias("generated_at"), F.lit(attribution).alias("attribution"), "issues",
        listed.alias("topics"))
