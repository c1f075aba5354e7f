"""Fact payloads, template summaries, and validation of generated summaries against the facts they cite."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import (
    EXCLAIMED, clip, clip_sentence, has_han_or_kana, is_free_number, is_polite, numbers_in, or_empty, particle, rescued_json,
)
from ..settings import AUXILIARY_METRIC, BANNED_PHRASES, HARD_WORDS, Settings
from .dedup import distinct_sentences, unlike
from .ordered import latest_per_key, top_n
from .series import allowed_visuals

GENERATED = (
    "title string, one_liner string, why_now string, impact_line string, details array<string>, "
    "visual_type string, effects array<string>, glossary array<struct<term:string,easy:string,example:string>>"
)


def ordered_list(df: DataFrame, key: str, rank: str, value: Column, name: str) -> DataFrame:
    """Values of already limited groups as a list in rank order."""
    packed = F.array_sort(F.collect_list(F.struct(F.col(rank).alias("r"), value.alias("v"))))
    return df.groupBy(key).agg(packed.alias("_l")).select(key, F.transform("_l", lambda x: x["v"]).alias(name))


def payloads(issues: DataFrame, anchors: DataFrame, headlines: DataFrame, articles: DataFrame, s: Settings) -> DataFrame:
    """Facts per issue: the 8 newest anchors, representative headlines (else the title), 2 newest official leads.

    `headlines` is (issue_id, rank, title), at most max_headlines per issue.
    """
    newest = top_n(anchors, ["issue_id"], [F.col("observed_at").desc(), F.col("seq").desc()], 8)
    fact = F.struct("entity", "metric", "value", "unit", "prev", "period", "source")
    a = ordered_list(newest, "issue_id", "rn", fact, "anchors")
    h = ordered_list(headlines, "issue_id", "rank", F.col("title"), "headlines")
    quoted = articles.filter((F.col("tier") == "official") & (or_empty("lead") != "") & F.col("issue_id").isNotNull())
    lead = top_n(quoted, ["issue_id"], [F.col("published_at").desc(), F.col("aid")], 2)
    o = ordered_list(lead, "issue_id", "rn", F.col("lead"), "official_lines")
    base = issues.select(F.col("id").alias("issue_id"), "category", "canonical_title")
    return (
        base.join(a, "issue_id", "left").join(h, "issue_id", "left").join(o, "issue_id", "left")
        .select(
            "issue_id", "category",
            F.coalesce("anchors", F.filter(F.array(F.struct(
                F.lit("").alias("entity"), F.lit("").alias("metric"), F.lit(0.0).alias("value"), F.lit("").alias("unit"),
                F.lit(0.0).alias("prev"), F.lit("").alias("period"), F.lit("").alias("source"))), lambda x: F.lit(False))
            ).alias("anchors"),
            F.coalesce("headlines", F.array("canonical_title")).alias("headlines"),
            F.coalesce("official_lines", F.array().cast("array<string>")).alias("official_lines"),
        )
    )


def fingerprint() -> Column:
    """Hash of the facts; category and official leads do not count."""
    return F.sha1(F.to_json(F.struct(F.lit(3).alias("v"), F.col("anchors").alias("a"), F.col("headlines").alias("h"))).cast("binary"))


def number_text(v: Column) -> Column:
    """A number as Python prints a float: 3.0, 111.24."""
    whole = (v == F.floor(v)) & (F.abs(v) < 1e15)
    return F.when(whole, F.concat(v.cast("long").cast("string"), F.lit(".0"))).otherwise(v.cast("string"))


def template_summary(payload: DataFrame) -> DataFrame:
    """Summary assembled from the facts alone."""
    usable = F.filter("anchors", lambda a: a["value"].isNotNull() & (a["metric"] != AUXILIARY_METRIC))
    lines = F.transform(
        F.filter(F.slice("anchors", 1, 4), lambda a: a["value"].isNotNull()),
        lambda a: F.trim(F.concat(
            a["entity"], F.lit(" "), a["metric"], F.lit(": "), number_text(a["value"]), a["unit"],
            F.when(a["prev"].isNotNull(), F.concat(F.lit(" (직전 "), number_text(a["prev"]), a["unit"], F.lit(")")))
            .otherwise(F.lit("")),
        )),
    )
    a = F.element_at("_usable", 1)
    name = F.concat(a["entity"], F.lit(" "), a["metric"])
    value = F.concat(number_text(a["value"]), a["unit"])
    towards = particle(a["unit"], "으로", "로")
    moved = F.concat(
        name, particle(a["metric"], "이", "가"), F.lit(" "), number_text(a["prev"]), a["unit"], F.lit("에서 "), value,
        towards, F.lit(" 바뀌었어요"),
    )
    told = F.concat(name, F.lit(" "), value, towards, F.lit(" 발표됐어요"))
    head = F.coalesce(F.get("headlines", F.lit(0)), F.lit("새 소식"))
    has = F.size("_usable") > 0
    return (
        payload.withColumn("_usable", usable).withColumn("_lines", lines)
        .select(
            "issue_id",
            F.when(has, clip(F.concat(name, F.lit(" "), value), 22)).otherwise(clip(head, 22)).alias("title"),
            F.when(has, clip(F.when(a["prev"].isNotNull(), moved).otherwise(told), 50)).otherwise(clip(head, 50)).alias("one_liner"),
            F.lit(None).cast("string").alias("why_now"),
            F.lit(None).cast("string").alias("impact_line"),
            F.when(F.size("_lines") > 0, F.slice("_lines", 1, 5)).otherwise(F.slice("headlines", 1, 3)).alias("details"),
            F.coalesce(F.get(allowed_visuals("category"), F.lit(0)), F.lit("none")).alias("visual_type"),
            F.array().cast("array<string>").alias("effects"),
            F.lit("template").alias("model"),
        )
    )


def parse_generated(rows: DataFrame, text: str) -> DataFrame:
    """Generated text to columns, after one rescue of the outermost braces; `parsed` tells whether it worked."""
    fixed = rescued_json(text)
    return rows.withColumn("_j", fixed).withColumn("parsed", F.col("_j").isNotNull()).withColumn(
        "out", F.from_json("_j", GENERATED)
    ).drop("_j")


def allowed_numbers(facts_json, anchors) -> Column:
    """Numbers of the facts and what may be derived from them: absolute, rounded, differences, basis points."""
    base = numbers_in(facts_json)
    near = lambda n: F.array(n, F.abs(n), F.bround(n, 0), F.bround(n, 1))
    derived = F.flatten(F.transform(base, near))

    def of_anchor(a: Column) -> Column:
        v, p = a["value"], a["prev"]
        d = F.round(F.abs(v - p), 6)
        return F.array(d, F.round(d * 100, 6), F.bround(d, 0), F.round(v, 6), F.round(v * 100, 6), F.bround(v, 0), F.bround(v, 1))

    return F.array_distinct(F.array_compact(F.concat(derived, F.flatten(F.transform(anchors, of_anchor)))))


def ungrounded(output_text, allowed: Column) -> Column:
    """Numbers of the output that neither the facts nor common sense explain, sorted."""
    extra = F.filter(F.array_except(numbers_in(output_text), allowed), lambda n: ~is_free_number(n))
    return F.array_sort(extra)


def clean_glossary(entries: Column, body: Column, hard_words: list[str] | None = None, keep: int = 4) -> Column:
    """Generated glossary entries that occur in the body, explain politely and briefly; first of each term."""
    hard = hard_words if hard_words is not None else HARD_WORDS
    low = F.lower(body)
    tidy = F.transform(entries, lambda g: F.struct(
        F.trim(or_empty(g["term"])).alias("term"), F.trim(or_empty(g["easy"])).alias("easy"),
        F.trim(or_empty(g["example"])).alias("example"),
    ))

    def good(g: Column) -> Column:
        ok = (g["term"] != "") & (g["easy"] != "") & (F.length(g["easy"]) <= 50) & is_polite(g["easy"])
        ok = ok & low.contains(F.lower(g["term"]))
        for w in hard:
            ok = ok & ~g["easy"].contains(w)
        return ok

    kept = F.filter(tidy, good)
    names = F.transform(kept, lambda g: F.lower(g["term"]))
    first = F.filter(kept, lambda g, i: F.array_position(names, F.lower(g["term"])) == i + 1)
    short = F.transform(first, lambda g: F.struct(
        g["term"].alias("term"), g["easy"].alias("easy"),
        F.when(F.length(g["example"]) > 50, F.lit("")).otherwise(g["example"]).alias("example"),
    ))
    return F.slice(short, 1, keep)


def validate(rows: DataFrame) -> DataFrame:
    """Check `out` (struct, see GENERATED) against `facts_json`, `anchors` and `allowed_visuals` of the same row.

    Adds the repaired columns and `errors`, the list of reasons for rejection (empty when accepted).
    """
    text = lambda c: F.trim(or_empty(c))
    t = rows.withColumns({
        "v_title": text("out.title"), "v_one": text("out.one_liner"), "v_why": text("out.why_now"),
        "v_given": F.coalesce("out.details", F.array().cast("array<string>")),
    })
    usable = F.filter(F.slice("v_given", 1, 6), lambda d: F.trim(or_empty(d)) != "")
    t = t.withColumn("v_details", distinct_sentences(F.transform(usable, lambda d: clip_sentence(d, 55))))
    effects = F.coalesce("out.effects", F.array().cast("array<string>"))
    t = t.withColumn("v_effects", effects).withColumn("v_fresh", unlike(F.col("v_effects"), F.col("v_details")))
    impact = text("out.impact_line")
    t = t.withColumn("v_impact", F.when((impact != "") & (F.length(impact) <= 45) & is_polite(impact), impact))

    few = (F.size("v_given") < 3) | (F.size("v_details") < 3)
    n_effects = F.size("v_effects")
    counted = n_effects.between(1, 2)
    stale = counted & (F.size("v_fresh") == 0)
    t = t.withColumn("v_kept", F.when(counted & ~stale, F.col("v_fresh")).otherwise(F.col("v_effects")))
    pieces = F.concat(
        F.array("v_title", "v_one", "v_why", or_empty("v_impact")), "v_details", "v_kept"
    )
    t = t.withColumn("v_text", F.array_join(pieces, " "))
    t = t.withColumn("v_extra", ungrounded("v_text", allowed_numbers(F.col("facts_json"), F.col("anchors"))))

    def rule(cond: Column, message) -> Column:
        return F.when(cond, message if isinstance(message, Column) else F.lit(message))

    title, one, why = F.col("v_title"), F.col("v_one"), F.col("v_why")
    visual = F.coalesce("out.visual_type", F.lit("none"))
    single = [
        rule(F.col("out").isNull(), "output is no JSON object"),
        rule(title == "", "title missing"),
        rule(F.length(title) > 22, F.concat(F.lit("title over 22: "), F.length(title).cast("string"))),
        rule(has_han_or_kana(title), "title has Han or kana"),
        rule(one == "", "one_liner missing"),
        rule(F.length(one) > 50, F.concat(F.lit("one_liner over 50: "), F.length(one).cast("string"))),
        rule((one != "") & ~is_polite(one), "one_liner not polite"),
        rule(has_han_or_kana(one), "one_liner has Han or kana"),
        rule(why == "", "why_now missing"),
        rule(F.length(why) > 55, F.concat(F.lit("why_now over 55: "), F.length(why).cast("string"))),
        rule((why != "") & ~is_polite(why), "why_now not polite"),
        rule(few, "fewer than 3 details"),
        rule((visual != "none") & ~F.array_contains("allowed_visuals", visual), F.concat(F.lit("visual not allowed: "), visual)),
        rule(~counted, "effects not 1 or 2"),
        rule(stale, "effects repeat details"),
        rule(F.size("v_extra") > 0, F.concat(F.lit("numbers without source: "), F.array_join(
            F.transform(F.slice("v_extra", 1, 5), number_text), ", "))),
    ]
    single += [rule(F.col("v_text").contains(p), f"banned: {p}") for p in BANNED_PHRASES]
    rude = F.when(~few, F.array_compact(F.transform(
        "v_details", lambda d, i: F.when(~is_polite(d), F.concat(F.lit("details not polite: "), i.cast("string")))
    ))).otherwise(F.array().cast("array<string>"))
    calm = F.when(counted, F.array_compact(F.transform(
        "v_effects", lambda e, i: F.when(~F.trim(or_empty(e)).rlike(EXCLAIMED), F.concat(F.lit("effects not exclaimed: "), i.cast("string")))
    ))).otherwise(F.array().cast("array<string>"))
    body = F.array_join(F.concat(F.array("v_title", "v_one", "v_why"), "v_details"), " ")
    glossary = clean_glossary(
        F.coalesce("out.glossary", F.array().cast("array<struct<term:string,easy:string,example:string>>")), body
    )
    t = t.withColumn("errors", F.concat(F.array_compact(F.array(*single)), rude, calm)).withColumn("glossary", glossary)
    return t.withColumns({
        "title": F.col("v_title"), "one_liner": F.col("v_one"), "why_now": F.col("v_why"),
        "impact_line": F.col("v_impact"), "details": F.col("v_details"), "effects": F.col("v_kept"), "visual_type": visual,
    }).drop(*[f"v_{n}" for n in ("title", "one", "why", "given", "details", "effects", "fresh", "impact", "kept", "text", "extra")])


def accepted(checked: DataFrame) -> DataFrame:
    return checked.filter(F.size("errors") == 0)


def rejected(checked: DataFrame) -> DataFrame:
    return checked.filter(F.size("errors") > 0)


def upsert_summaries(stored: DataFrame, fresh: DataFrame) -> DataFrame:
    both = stored.withColumn("_new", F.lit(0)).unionByName(fresh.withColumn("_new", F.lit(1)), allowMissingColumns=True)
    return latest_per_key(both, ["issue_id"], [F.col("_new").desc(), F.col("created_at").desc()]).drop("_new")


def review_rows(checked: DataFrame, at: Column) -> DataFrame:
    """Review queue: why a text was refused, with all attempts where they are known."""
    told = [c for c in ("errors", "attempts") if c in checked.columns]
    return rejected(checked).select(
        "issue_id", F.to_json(F.struct(F.lit("template fallback").alias("summary"), *told)).alias("reason"), at.alias("at")
    )


def review_listing(reviews: DataFrame) -> DataFrame:
    """(issue_id, at, reason) of the queue, newest first, the reason's own words where it is a document."""
    said = F.from_json("reason", "summary string")["summary"]
    return reviews.select("issue_id", "at", F.coalesce(said, F.col("reason")).alias("reason")).orderBy(F.col("at").desc(), "issue_id")
