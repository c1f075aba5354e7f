"""One cycle over the state tables: ingest, events, clustering, scoring, summaries, publication.

A cycle reads one version of the state and commits the next one (`state.py`), so a cycle that fails leaves the last one
untouched. What it writes is bounded by what arrived and changed, not by what has ever been stored.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from ..functions.vectors import dot, half_precision
from ..operators import (
    classify as K, cluster as C, dedup as D, diagnostics as G, embed as E, events as V, lifecycle as L, readmodel as R, summary as Y,
)
from ..operators.ordered import spread_join, top_n
from ..operators.series import allowed_visuals, quarterly_groups, resolve_visual
from ..session import cut, fresh_path
from ..settings import Settings
from ..sources.landing import normalize
from .state import TABLES, Snapshot, changed_parts, day_part, empty_state, load_state, part_of, save_state, shaped  # noqa: F401

@dataclass
class Dictionaries:
    """Configuration of a run; small by nature."""

    aliases: list = field(default_factory=list)
    groups: dict = field(default_factory=dict)
    categories: list = field(default_factory=list)
    prototypes: dict = field(default_factory=dict)
    entity_icons: dict = field(default_factory=dict)
    surfaces: dict = field(default_factory=dict)  # surface -> glossary term
    terms: dict = field(default_factory=dict)  # glossary term -> (easy, example)


State = dict[str, DataFrame]


class Articles:
    """Articles of a cycle. `hot` rows may change in every step: those of the last days, those that still lack a vector, and new
    ones. Older rows are only read, and change only where their issue is merged or archived; those changes are applied as they
    are read, and only days that have any are written again.
    """

    def __init__(self, state: Snapshot, now: Column, s: Settings):
        self.state, self.spark = state, state.spark
        at = self.spark.range(1).select((now - F.expr(f"INTERVAL {s.seed_pool_ttl_h} HOURS")).alias("t")).select(day_part("t")).first()[0]
        self.first_day = int(at[1:])
        dead = archived(state["issues"])
        bare = self._older().filter(F.col("vec").isNull())
        self.bare = cut(spread_join(bare, dead, ["issue_id"], "left_anti", ["aid"]))
        self.has_bare = not self.bare.isEmpty()
        self.before = state.read("articles", self._recent).unionByName(self.bare)
        self.hot = self.before
        self.moves: list = []

    def _recent(self, part: str) -> bool:
        return part != "none" and int(part[1:]) >= self.first_day

    def _older(self, only=None) -> DataFrame:
        return self.state.read("articles", lambda p: not self._recent(p) and (only is None or p in only))

    def cold(self, only=None) -> DataFrame:
        """Older rows, of some parts if named, with the changes so far."""
        rows = self._older(only)
        if self.has_bare:
            rows = rows.join(self.bare.select("aid"), "aid", "left_anti")
        for move in self.moves:
            rows = move(rows)
        return rows

    def all(self) -> DataFrame:
        return self.cold().unionByName(self.hot)

    def add(self, rows: DataFrame) -> None:
        self.hot = self.hot.unionByName(shaped(rows, "articles"))

    def change(self, move: Callable[[DataFrame], DataFrame]) -> None:
        """Apply a change of issues to all rows, to the older ones as they are read."""
        self.hot = move(self.hot)
        self.moves.append(move)

    def touched(self, issues: DataFrame) -> tuple[DataFrame, list[str]]:
        """(rows, parts) to write: parts with changed hot rows, and older ones with rows of the given issues."""
        self.hot = cut(shaped(self.hot, "articles"))
        parts = set(changed_parts("articles", self.before, self.hot))
        if not issues.isEmpty():
            rows = spread_join(self._older().select("aid", "issue_id", "collected_at"), issues, ["issue_id"], "left_semi", ["aid"])
            parts |= {r["part"] for r in rows.select(part_of("articles").alias("part")).distinct().collect()}  # a row a day
        rows = self.cold(parts).unionByName(self.hot.filter(part_of("articles").isin(sorted(parts))))
        return rows, sorted(parts)


class Lines:
    """Timeline rows of a cycle: stored ones are read, new ones go to the last parts."""

    def __init__(self, state: Snapshot):
        self.state, self.added, self.moves = state, state.spark.createDataFrame([], TABLES["timeline"]), []

    def _stored(self, only=None) -> DataFrame:
        return self.state.read("timeline", None if only is None else lambda p: p in only)

    def add(self, fresh: DataFrame) -> None:
        new = numbered(fresh, ["at", "issue_id", "title"], self._stored().select("seq").unionByName(self.added.select("seq")), "seq")
        self.added = self.added.unionByName(shaped(new, "timeline"))

    def change(self, move: Callable[[DataFrame], DataFrame]) -> None:
        self.moves.append(move)

    def _moved(self, rows: DataFrame) -> DataFrame:
        for move in self.moves:
            rows = move(rows)
        return rows

    def all(self) -> DataFrame:
        return self._moved(self._stored().unionByName(self.added))

    def touched(self, issues: DataFrame) -> tuple[DataFrame, list[str]]:
        parts = {r["part"] for r in self.added.select(part_of("timeline").alias("part")).distinct().collect()}
        if not issues.isEmpty():
            old = spread_join(self._stored().select("seq", "issue_id"), issues, ["issue_id"], "left_semi", ["seq"])
            parts |= {r["part"] for r in old.select(part_of("timeline").alias("part")).distinct().collect()}  # a row for many lines
        return self._moved(self._stored(parts).unionByName(self.added)), sorted(parts)


def archived(issues: DataFrame) -> DataFrame:
    return issues.filter("status = 'archived'").select(F.col("id").alias("issue_id"))


def counted(df: DataFrame, **metrics: Column) -> tuple[DataFrame, dict]:
    """A written table, and metrics of its rows that were observed while it was written; no second pass counts them."""
    seen = Observation()
    out = cut(df.observe(seen, F.count(F.lit(1)).alias("rows"), *[F.sum(c.cast("long")).alias(n) for n, c in metrics.items()]))
    return out, {k: v or 0 for k, v in seen.get.items()}


def numbered(df: DataFrame, order: list[str], stored: DataFrame, name: str) -> DataFrame:
    """New rows get increasing numbers in the given order, after all stored numbers.

    A range-partitioned sort numbers rows without a single-task window; the result is written so that it stays.
    """
    start = stored.agg(F.coalesce(F.max(name) + 1, F.lit(0).cast("long"))).scalar()
    ranked = cut(df.orderBy(*order).withColumn("_n", F.monotonically_increasing_id()))
    return ranked.withColumn(name, F.col("_n") + start).drop("_n")


def ingest(work: Articles, raw: DataFrame, now: Column, d: Dictionaries, s: Settings) -> dict:
    """Add new articles, normalised, with exact and near duplicates handled; counts of them."""
    stored = work.state["articles"]
    rows = normalize(raw, d.aliases)
    fresh = D.first_by_id(rows, "id", [F.col("collected_at"), F.col("source")]).join(stored.select("id"), "id", "left_anti")
    # the numbering samples its input before it sorts, so the tagged rows are written first
    fresh = numbered(cut(fresh), ["collected_at", "id"], stored, "aid")
    recent = F.col("published_at").isNull() | (F.col("published_at") >= now - F.expr(f"INTERVAL {2 * s.dup_window_h} HOURS"))
    cols = ["aid", "simhash", "published_at"]
    pool = stored.select(*cols).unionByName(fresh.select(*cols)).filter(recent)
    marked = D.mark_near_duplicates(pool, "simhash", "aid", "published_at", s.simhash_k, s.dup_window_h).select("aid", "is_dup")
    fresh = fresh.join(marked, "aid", "left").withColumn("is_dup", F.coalesce("is_dup", F.lit(False)))
    fresh, n = counted(shaped(fresh.withColumn("hold_count", F.lit(0)), "articles"), near_dups=F.col("is_dup"))
    work.add(fresh)
    return {"inserted": n["rows"], "near_dups": n["near_dups"]}


def official(state: State, events: DataFrame, work: Articles, lines: Lines, now: Column, d: Dictionaries) -> tuple[State, int]:
    """Unprocessed events as issues, anchors, timeline rows and linked articles; the number of events."""
    linked, n = counted(V.link_events(V.pending(events, state["processed"]), state["issues"]))
    issues = V.upsert_issues(linked, state["issues"], now, d.aliases)
    known = issues.filter(F.col("iid").isNotNull())
    made = numbered(issues.filter(F.col("iid").isNull()).drop("iid"), ["created_at", "id"], state["issues"], "iid")
    articles = work.all()
    listed = V.event_articles(linked, articles, now, d.aliases)
    work.add(numbered(listed, ["collected_at", "id"], articles.select("aid"), "aid").withColumn("hold_count", F.lit(0)))
    lines.add(V.event_timeline(linked, now))
    return {
        "issues": cut(shaped(known.unionByName(made, allowMissingColumns=True), "issues")),
        "anchors": numbered_anchors(state["anchors"], V.event_anchors(linked, now)),
        "processed": state["processed"].unionByName(linked.select("key")),
    }, n["rows"]


def numbered_anchors(stored: DataFrame, fresh: DataFrame) -> DataFrame:
    """Upserted anchors; replaced or new rows count as written last."""
    both = V.upsert_anchors(stored, fresh)
    old = both.filter(F.col("seq") > 0)
    new = numbered(both.filter(F.col("seq") == 0).drop("seq"), ["issue_id", "entity", "metric", "period"], stored, "seq")
    return cut(shaped(old.unionByName(new.withColumn("seq", F.col("seq") + 1)), "anchors"))


def stored_vec(vec: str, s: Settings) -> Column:
    """A vector with the precision that the state keeps, so a cycle computes with what the next one will read."""
    return half_precision(vec) if s.half_precision else F.col(vec)


def add_vectors(work: Articles, issues: DataFrame, s: Settings, embed: Callable | None) -> DataFrame:
    """Vectors for the newest articles without one (not of archived issues) and for official issues; the issues."""
    lacking = spread_join(work.hot.filter(F.col("vec").isNull()), archived(issues), ["issue_id"], "left_anti", ["aid"])
    # written once: a costly model runs once for each text, and the rounding reads its result
    some = cut(E.text_vectors(lacking.drop("vec"), s, embed, s.max_vectors_per_run, "collected_at").select("id", "vec"))
    work.hot = cut(work.hot.join(some.select("id", stored_vec("vec", s).alias("_v")), "id", "left").withColumn("vec", F.coalesce("vec", "_v")).drop("_v"))
    bare = V.missing_centroids(issues).select("id", F.col("canonical_title").alias("title"), F.lit("").alias("lead"))
    heads = cut(E.text_vectors(bare, s, embed).select("id", "vec"))
    return cut(issues.join(heads.select("id", stored_vec("vec", s).alias("_v")), "id", "left").withColumn("vec", F.coalesce("vec", "_v")).drop("_v"))


def _counted(issues: DataFrame, articles: DataFrame) -> DataFrame:
    counts = D.member_counts(articles).select(F.col("issue_id").alias("id"), "members")
    return issues.join(counts, "id", "left").withColumn("members", F.coalesce("members", F.lit(0).cast("long"))).withColumn(
        "official", F.col("origin") == "official_event")


def _entries(rows: DataFrame, now: Column) -> DataFrame:
    return rows.select(
        "issue_id", F.when(F.col("tier") == "official", "official").otherwise("headline").alias("kind"), "title", "source", "url",
        F.coalesce("published_at", now).alias("at"))


def cluster(work: Articles, issues: DataFrame, lines: Lines, now: Column, s: Settings) -> tuple[DataFrame, dict]:
    """Assign, seed, recount and promote; the issues and counts."""
    names = issues.select(F.col("iid").alias("best_issue"), F.col("id").alias("_best"))
    near_names = issues.select(F.col("iid").alias("last_sim_issue"), F.col("id").alias("_near"))
    open_ = C.open_articles(work.hot, now, s)  # open articles arrived within the hot days
    targets = C.eligible_issues(_counted(issues, work.all()), now, s)
    decided = C.assign(open_.select("aid", "vec", "keys", "hold_count"), targets.select("iid", "vec", "keys", "official"), s)
    decided = spread_join(decided, names, ["best_issue"], "left", ["aid"])
    said = {k: F.col("decision") == k for k in ("joined", "held", "pooled")}
    decided, stats = counted(spread_join(decided, near_names, ["last_sim_issue"], "left", ["aid"]), **said)

    joined = decided.filter("decision = 'joined'").select("aid", F.col("best_issue").alias("iid")).join(
        open_.select("aid", "vec", "keys", "is_dup"), "aid")
    joined = cut(joined)
    touched = joined.select("iid").distinct()
    grown = targets.join(touched, "iid", "left_semi")
    moved = C.moving_centroids(grown.select("iid", "vec", "members"), joined, s).withColumnRenamed("vec", "_vec")
    keys = C.merged_keys(grown.select("iid", "keys"), joined).withColumnRenamed("keys", "_keys")
    issues = issues.join(moved, "iid", "left").join(keys, "iid", "left").withColumn(
        "last_update", F.when(F.col("_vec").isNotNull(), now).otherwise(F.col("last_update"))
    ).withColumn("vec", F.coalesce("_vec", "vec")).withColumn("keys", F.coalesce("_keys", "keys")).drop("_vec", "_keys")

    seen = decided.select("aid", F.when(F.col("decision") == "joined", F.col("_best")).alias("_issue"),
                          F.col("hold_count").alias("_hold"), F.col("last_sim").alias("_sim"), F.col("_near"))
    articles = work.hot.join(seen, "aid", "left").withColumns({
        "issue_id": F.coalesce("issue_id", "_issue"), "hold_count": F.coalesce("_hold", "hold_count"),
        "last_sim": F.coalesce("_sim", "last_sim"), "last_sim_issue": F.coalesce("_near", "last_sim_issue"),
    }).drop("_issue", "_hold", "_sim", "_near")
    articles = cut(articles)
    entries = _entries(articles.join(joined.select("aid"), "aid", "left_semi"), now)

    pool = C.seed_pool(C.open_articles(articles, now, s), s)
    pairs, n = counted(C.seed_pairs(pool.select("aid", "vec", "keys"), s))
    made = cut(C.issues_from_pairs(pairs, pool.withColumn("article_key", F.col("id"))))
    rows = made.select("id", "canonical_title", stored_vec("vec", s).alias("vec"), "keys", F.lit("candidate").alias("status"), F.lit("cluster").alias("origin"),
                       F.lit("ETC").alias("category"), now.alias("created_at"), now.alias("last_update"), F.lit(False).alias("frozen"))
    issues = cut(issues.unionByName(shaped(numbered(rows, ["id"], issues, "iid"), "issues")))
    links = made.select(F.col("a").alias("aid"), F.col("id").alias("_issue")).unionByName(made.select(F.col("b").alias("aid"), F.col("id").alias("_issue")))
    articles = work.hot = cut(articles.join(links, "aid", "left").withColumn("hold_count", F.when(F.col("_issue").isNotNull(), 0).otherwise(F.col("hold_count")))
                   .withColumn("issue_id", F.coalesce("issue_id", "_issue")).drop("_issue"))
    entries = entries.unionByName(_entries(articles.join(links.select("aid"), "aid", "left_semi"), now))
    lines.add(entries)

    sources = D.distinct_sources(work.all()).join(issues.select(F.col("id").alias("issue_id"), "iid"), "issue_id").select("iid", "seen_sources")
    before = issues.select("iid", F.col("status").alias("_old"))
    promoted = C.promote(issues, sources, s).join(before, "iid").withColumn(
        "last_update", F.when(F.col("_old") != F.col("status"), now).otherwise(F.col("last_update"))).drop("_old")
    return cut(shaped(promoted, "issues")), {"joined": stats["joined"], "held": stats["held"], "seeded": n["rows"]}


def categorise(issues: DataFrame, articles: DataFrame, d: Dictionaries, s: Settings, embed: Callable | None) -> DataFrame:
    names = issues.select(F.col("id").alias("issue_id"), "iid")
    some = top_n(articles.filter(F.col("issue_id").isNotNull()).select("issue_id", "aid", "title"), ["issue_id"], [F.col("aid")], 10)
    members = some.join(names, "issue_id")
    keyword = K.keyword_category(issues.select("iid", "canonical_title"), members, d.categories)
    sentences = [(i, c, t) for i, (c, _) in enumerate(d.categories) if c != K.FALLBACK for t in d.prototypes.get(c, [])]
    if sentences:
        told = issues.sparkSession.createDataFrame(sentences, "tord long, category string, title string").withColumn("lead", F.lit(""))
        protos = K.prototypes(E.text_vectors(told, s, embed), s.dim)
        nearest = K.prototype_category(issues.filter(F.col("vec").isNotNull()).select("iid", "vec"), protos, s.proto_min)
    else:
        nearest = issues.select("iid", F.lit(None).cast("string").alias("prototype_category"))
    return cut(shaped(K.classify(issues, keyword, nearest), "issues"))


def merge(state: State, work: Articles, lines: Lines, now: Column, s: Settings) -> tuple[State, DataFrame, int]:
    """Merged issues are archived, their children move, their summary goes; the mapping and its size."""
    issues = state["issues"]
    steps = C.merge_steps(_counted(issues, work.all()), s)
    final = C.final_winner(steps)
    name = lambda c, out: issues.select(F.col("iid").alias(c), F.col("id").alias(out))
    mapping, n = counted(final.join(name("loser", "l"), "loser").join(name("winner", "w"), "winner").select(F.col("l").alias("loser"), F.col("w").alias("winner")))
    if not n["rows"]:
        return state, mapping, 0
    gathered = mapping.join(issues.select(F.col("id").alias("loser"), F.explode("keys").alias("k")), "loser")
    extra = gathered.groupBy(F.col("winner").alias("id")).agg(F.collect_set("k").alias("_k"))
    won = mapping.select(F.col("winner").alias("id"), F.lit(True).alias("_won")).distinct()
    lost = mapping.select(F.col("loser").alias("id"), F.lit(True).alias("_lost"))
    out = dict(state)
    work.change(lambda rows: C.repoint(rows, mapping))
    lines.change(lambda rows: C.repoint(rows, mapping))
    out["anchors"] = cut(shaped(C.repoint(state["anchors"], mapping), "anchors"))
    sources = D.distinct_sources(work.all()).select(F.col("issue_id").alias("id"), F.col("seen_sources").alias("_n"))
    rows = issues.join(extra, "id", "left").join(won, "id", "left").join(lost, "id", "left").join(sources, "id", "left")
    moved = F.col("_won") | F.col("_lost")
    rows = rows.withColumns({
        "keys": F.when(F.col("_k").isNotNull(), F.array_sort(F.array_union("keys", "_k"))).otherwise(F.col("keys")),
        "status": F.when(F.col("_lost"), "archived").otherwise(F.col("status")),
        "last_update": F.when(F.coalesce(moved, F.lit(False)), now).otherwise(F.col("last_update")),
        "seen_sources": F.when(F.col("_won"), F.coalesce("_n", F.lit(0).cast("long"))).otherwise(F.col("seen_sources")),
    })
    out["issues"] = cut(shaped(rows, "issues"))
    out["summaries"] = state["summaries"].join(mapping.select(F.col("loser").alias("issue_id")), "issue_id", "left_anti")
    return out, mapping, n["rows"]


def age_and_score(issues: DataFrame, anchors: DataFrame, articles: DataFrame, d: Dictionaries, now: Column, s: Settings) -> DataFrame:
    aged = issues.withColumn("status", L.aged_status(now, s))
    scores = L.importance(aged, anchors, articles, d.groups, now, s).withColumnRenamed("importance", "_i")
    rows = aged.join(scores, "id", "left").withColumn("importance", F.coalesce("_i", "importance", F.lit(0).cast("long"))).drop("_i")
    return cut(shaped(rows, "issues"))


def facts_of(state: State, articles: DataFrame, s: Settings) -> DataFrame:
    issues = state["issues"]
    live = issues.filter(F.col("status").isin(*L.LIVE))
    centroid = live.select(F.col("id").alias("iid"), F.col("vec").alias("_c"))
    members = articles.filter(F.col("issue_id").isNotNull() & ~F.col("is_dup")).select(
        F.col("issue_id").alias("iid"), "aid", "published_at", "title", "vec")
    members = spread_join(members, centroid, ["iid"], "inner", ["aid"]).withColumn(
        "sim", F.when(F.col("_c").isNotNull() & F.col("vec").isNotNull(), dot("vec", "_c"))).withColumn("has_centroid", F.col("_c").isNotNull())
    heads = C.representative_rows(members.drop("vec", "_c"), s.max_headlines).select(F.col("iid").alias("issue_id"), "rank", "title")
    return Y.payloads(live, state["anchors"], heads, articles, s).withColumn("fact_hash", Y.fingerprint())


SAID = ["title", "one_liner", "why_now", "impact_line", "details", "visual_type", "effects", "glossary"]


def attempted(todo: DataFrame, generate: Callable[[DataFrame], DataFrame]) -> tuple[DataFrame, int]:
    """(issue_id, raw, the parts of the text, errors, attempts) of the last attempt, and how many issues had a second one.

    A text that breaks a rule is asked for once more; an issue without an answer is not. `attempts` keeps what each was told.
    """
    def asked(rows: DataFrame) -> DataFrame:
        told = rows.join(generate(rows).select("issue_id", "text"), "issue_id", "left")
        parsed = Y.parse_generated(told, "text").withColumn("facts_json", F.to_json(F.struct("category", "anchors", "headlines", "official_lines")))
        checked = Y.validate(parsed.withColumn("allowed_visuals", allowed_visuals("category")))
        errors = F.when(F.col("text").isNull(), F.array(F.lit("no answer"))).otherwise(F.col("errors"))
        return cut(checked.select("issue_id", F.col("text").alias("raw"), *SAID, errors.alias("errors")))

    tried = lambda c: F.array(F.struct(F.col(c).alias("errors")))
    first = asked(todo)
    failed = first.filter((F.size("errors") > 0) & F.col("raw").isNotNull()).select("issue_id", F.col("errors").alias("_before"))
    once = first.withColumn("attempts", tried("errors"))
    n = failed.count()
    if not n:
        return once, 0
    second = asked(todo.join(failed.select("issue_id"), "issue_id", "left_semi"))
    twice = second.join(failed, "issue_id").withColumn("attempts", F.concat(tried("_before"), tried("errors"))).drop("_before")
    return cut(once.join(failed.select("issue_id"), "issue_id", "left_anti").unionByName(twice)), n


def summarise(state: State, work: Articles, now: Column, s: Settings, generate: Callable[[DataFrame], DataFrame] | None) -> tuple[State, dict]:
    """Process the issues the budget allows: generated text is validated, what fails becomes a template and a review row.

    `generate` maps payload rows to (issue_id, text); without it every processed issue gets its template.
    """
    payload = cut(facts_of(state, work.all(), s))
    today = L.calls_on(state["runs"], now).scalar()
    rows = state["issues"].join(payload.select(F.col("issue_id").alias("id"), "fact_hash"), "id").withColumn("calls", F.lit(1).cast("long"))
    split = L.work_split(rows, state["summaries"], now, today, s, capped=generate is not None).select("id", "work_state")
    split = cut(split)
    handled = {r["work_state"]: r["count"] for r in split.groupBy("work_state").count().collect()}  # at most four rows
    todo = payload.join(split.filter("work_state = 'process'").select(F.col("id").alias("issue_id")), "issue_id", "left_semi")
    out = dict(state)
    templates = Y.template_summary(todo)
    if generate is not None:
        checked, handled["retried"] = attempted(todo, generate)
        good = Y.accepted(checked).withColumn("model", F.lit("generated"))
        bad = Y.rejected(checked)
        templates = templates.join(bad.select("issue_id", "errors", "attempts", "raw"), "issue_id")
        fresh = good.unionByName(templates, allowMissingColumns=True)
        reviews = state["reviews"].unionByName(Y.review_rows(checked, now))
        out["reviews"] = cut(D.first_by_id(reviews, "issue_id", [F.col("at").desc()]))
    else:
        fresh = templates
    fresh = fresh.join(payload.select("issue_id", "fact_hash"), "issue_id").withColumn("created_at", now)
    out["summaries"] = cut(shaped(Y.upsert_summaries(state["summaries"], shaped(fresh, "summaries")), "summaries"))
    return out, handled


NO_SERIES = "visual_type string, series array<struct<t:string,v:double>>"


def charts_of(state: State, series: DataFrame | None, s: Settings = Settings()) -> DataFrame:
    """Charts of summaries whose type the category allows: (issue_id, visual_type, chart, unit, source, series, groups, words, tol).

    `series` is (visual_type, series). The quarterly chart of an issue needs none: it is made of the issue's own anchors."""
    spark = state["issues"].sparkSession
    if series is None:
        series = spark.createDataFrame([], NO_SERIES)
    asked = state["summaries"].filter(F.col("visual_type") != "none").select("issue_id", "visual_type").join(
        state["issues"].select(F.col("id").alias("issue_id"), "category"), "issue_id")
    wanted = resolve_visual(asked)
    own = quarterly_groups(state["anchors"]).groupBy("issue_id").agg(
        F.array_sort(F.collect_list(F.struct(F.col("metric").alias("name"), "series", "unit"))).alias("groups"))
    bars = wanted.filter("visual.chart = 'bar'").join(own, "issue_id").select(
        "issue_id", "visual_type", "visual", F.col("groups")[0]["series"].alias("series"), F.col("groups")[0]["unit"].alias("_unit"), "groups")
    lines = wanted.filter("visual.chart <> 'bar'").join(series, "visual_type").select(
        "issue_id", "visual_type", "visual", "series", F.col("visual.unit").alias("_unit"), F.lit(None).cast(bars.schema["groups"].dataType).alias("groups"))
    both = lines.unionByName(bars)
    return both.select("issue_id", "visual_type", F.col("visual.chart").alias("chart"), F.col("_unit").alias("unit"),
                       F.col("visual.source").alias("source"), "series", "groups", "visual.words", "visual.tol")


def publish(state: State, d: Dictionaries, series: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(cards, details) of the issues that may be published, at most 200 in rank order."""
    issues = state["issues"]
    gated = R.publishable(issues, state["summaries"], state["anchors"], D.distinct_sources(state["articles"]))
    feed = cut(L.ranked_feed(gated).filter("publish").drop("publish"))
    charts = cut(charts_of(state, series).join(feed.select(F.col("id").alias("issue_id")), "issue_id", "left_semi"))
    cards = R.cards(feed, state["summaries"], state["timeline"], state["anchors"], charts, d.entity_icons)
    mine = lambda t: state[t].join(feed.select(F.col("id").alias("issue_id")), "issue_id", "left_semi")
    lists = R.detail_lists(mine("timeline"), mine("articles"), mine("anchors"))
    links = R.related(issues).join(feed.select("id"), "id", "left_semi")
    told = mine("summaries")
    details = R.with_glossary(R.details(cards, lists, told, links), told, d.surfaces, d.terms)
    details = R.with_visual(details, charts).join(feed.select("id", "created_at"), "id", "left")
    return cards, details


def topics_of(state: State, topics: DataFrame, paragraphs: DataFrame, series: DataFrame | None = None) -> DataFrame:
    """Steady topics with their newest issue, live references and charts."""
    told = state["summaries"].select(F.col("issue_id").alias("id"), F.col("title").alias("summary_title"))
    issues = R.event_times(state["issues"], state["timeline"]).join(told, "id", "left")
    return R.topic_documents(topics, paragraphs, issues, series)


def diagnose(state: State, now: Column, s: Settings, stats: dict | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(metadata, issues, articles) that explain a cycle: counts, thresholds and the run log with this cycle in front; the listed
    issues with their members, anchors, timeline and summaries; the articles of the last days with what became of them."""
    spark = state["issues"].sparkSession
    calls = spark.range(1).select(L.calls_on(state["runs"], now).scalar().alias("calls"))
    kept = {k: getattr(s, k) for k in ("tau_join", "tau_hold", "min_publish", "merge_sim", "active_window_h", "daily_cap")}
    metadata = G.run_metadata(state["issues"], state["articles"], calls, state["reviews"], kept, state["runs"], now, stats)
    listed = state["issues"].withColumnRenamed("iid", "number")
    issues = G.issue_diagnostics(listed, state["articles"], state["anchors"], state["timeline"], state["summaries"], state["reviews"], now)
    return metadata, issues, G.article_listing(state["articles"].drop("vec", "lead"), now)


def without_vectors(rows: DataFrame, dead: DataFrame) -> DataFrame:
    """Articles of dead issues lose their vector."""
    marked = dead.withColumn("_dead", F.lit(True))
    return spread_join(rows, marked, ["issue_id"], "left", ["aid"]).withColumn("vec", F.when(F.col("_dead").isNull(), F.col("vec"))).drop("_dead")


def run_cycle(
    spark: SparkSession, state: Snapshot, raw: DataFrame, events: DataFrame, now: Column, d: Dictionaries, s: Settings = Settings(),
    embed: Callable | None = None, generate: Callable | None = None, folder: str | None = None, version: int | None = None,
    series: DataFrame | None = None,
) -> tuple[Snapshot, dict, DataFrame, DataFrame]:
    """One cycle. Returns the written state, its counts, the published cards and details.

    The state is written as the next version of its own folder, parts that did not change stay where they are. With another
    `folder` it is written there as a whole. `series` are the chart series by type (visual_type, series).
    """
    if folder is None:
        folder = state.root or fresh_path(spark, "state")
    work, lines = Articles(state, now, s), Lines(state)
    stats = ingest(work, raw, now, d, s)
    made, stats["express"] = official(state, events, work, lines, now, d)
    issues = add_vectors(work, made["issues"], s, embed)
    issues, more = cluster(work, issues, lines, now, s)
    current = {**state, **made, "issues": categorise(issues, work.all(), d, s, embed)}
    current, mapping, merged = merge(current, work, lines, now, s)
    current["issues"] = age_and_score(current["issues"], current["anchors"], work.all(), d, now, s)
    current, work_states = summarise(current, work, now, s, generate)
    dead = cut(archived(current["issues"]).join(archived(state["issues"]), "issue_id", "left_anti"))
    if not dead.isEmpty():
        work.change(lambda rows: without_vectors(rows, dead))
    stats = {**stats, **more, "merged": merged, **work_states}
    run = spark.createDataFrame([(stats.get("process", 0) + stats.get("retried", 0), str(stats))], "calls long, stats string").withColumn("at", now)
    run = run.withColumn("run_id", state["runs"].agg(F.coalesce(F.max("run_id") + 1, F.lit(0).cast("long"))).scalar())
    current["runs"] = state["runs"].unionByName(shaped(run, "runs"))
    written = store(state, current, work, lines, mapping, dead, folder, version)
    cards, details = publish(written, d, series)
    return written, stats, cards, details


def store(state: Snapshot, current: State, work: Articles, lines: Lines, mapping: DataFrame, dead: DataFrame, folder: str, version: int | None) -> Snapshot:
    """The next version: of articles and timeline only the parts that the cycle touched, of other tables those that differ."""
    moved = mapping.select(F.col("loser").alias("issue_id"))
    if folder != state.root:
        return save_state(state, {**current, "articles": work.all(), "timeline": lines.all()}, folder, version)
    touched = {}
    current["articles"], touched["articles"] = work.touched(moved.unionByName(dead))
    current["timeline"], touched["timeline"] = lines.touched(moved)
    return save_state(state, current, folder, version, touched)
