"""Queries on published read models and the curated package."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ...operators import curated as N, readmodel as R
from ...operators.dedup import distinct_sources
from ...session import cut
from . import query, table
from .views import ANCHORS, ARTICLES, ISSUES, SUMMARIES, TIMELINE, anchors, articles, issues, now, summaries, timeline

NEWEST = f"""
{ANCHORS},
newest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY issue_id ORDER BY observed_at DESC, seq DESC) AS rn FROM anchors
           WHERE value IS NOT NULL AND metric <> '변동폭') WHERE rn = 1)
"""
STAT = NEWEST + r""",
stat AS (SELECT issue_id, trim(entity || ' ' || metric) AS label, regexp_replace(printf('%.2f', value), '\.?0+$', '') AS value, unit,
  CASE WHEN value > prev THEN 'up' WHEN value < prev THEN 'down' ELSE 'flat' END AS direction,
  CASE WHEN value - prev > 0 THEN '+' WHEN value - prev < 0 THEN '-' WHEN prev IS NOT NULL THEN '±' END ||
    regexp_replace(printf('%.2f', abs(value - prev)), '\.?0+$', '') || CASE WHEN unit = '%' THEN '%p' ELSE unit END AS delta_text,
  '직전 ' || regexp_replace(printf('%.2f', prev), '\.?0+$', '') || unit AS prev_text FROM newest)
"""


@query("headline_stat", f"WITH {STAT} SELECT * FROM stat")
def headline_stat(spark: SparkSession, sf: str) -> DataFrame:
    return R.headline_stat(anchors(spark, sf))


CHARTS = """
pts AS (SELECT o_orderpriority AS series_id, date_trunc('month', o_orderdate) AS m, arg_max(o_totalprice, (o_orderdate, o_orderkey)) AS v FROM orders GROUP BY ALL)
"""


def _series(spark, sf):
    """Month-end series per order priority as lists of (t, v)."""
    from ...operators.series import month_end

    o = table(spark, sf, "orders").select(
        F.col("o_orderpriority").alias("series_id"), F.col("o_orderdate").cast("timestamp").alias("ts"),
        F.col("o_totalprice").alias("value"), F.col("o_orderkey").alias("tie"))
    return month_end(o).groupBy("series_id").agg(F.array_sort(F.collect_list(
        F.struct(F.date_format("month", "yyyy-MM").alias("t"), F.round(F.col("value") / 10000, 2).alias("v")))).alias("series"))


@query("sparkline", f"""
WITH {CHARTS}, r AS (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY m DESC) AS rn FROM pts)
SELECT series_id, string_agg(CAST(CAST(round(v / 10000, 2) AS DECIMAL(9, 2)) AS VARCHAR), ',' ORDER BY m) AS spark FROM r WHERE rn <= 8 GROUP BY series_id""")
def sparkline(spark: SparkSession, sf: str) -> DataFrame:
    shown = F.transform(R.spark_values(F.col("series")), lambda v: v.cast("decimal(9,2)").cast("string"))
    return _series(spark, sf).select("series_id", F.array_join(shown, ",").alias("spark"))


@query("icon", f"""
WITH {ISSUES} SELECT id, CASE WHEN list_contains(keys, 'N1') THEN '🇺🇸' WHEN list_contains(keys, 'SM') THEN '📱'
  ELSE CASE category WHEN 'RATE' THEN '🏦' WHEN 'MARKET' THEN '📈' WHEN 'EARNINGS' THEN '🧾' WHEN 'FX' THEN '💱' ELSE '📰' END END AS icon FROM issues""")
def icon(spark: SparkSession, sf: str) -> DataFrame:
    return issues(spark, sf).select("id", R.icon({"N1": "🇺🇸", "SM": "📱"}).alias("icon"))


RELATED = f"""
{ISSUES},
top AS (SELECT *, row_number() OVER (ORDER BY importance DESC, last_update DESC, id) AS g FROM issues WHERE status IN ('active', 'stale') QUALIFY g <= 61),
c AS (SELECT i.id, t.id AS rid, t.category = i.category OR list_has_any(t.keys, i.keys) AS alike, list_sort(list_intersect(t.keys, i.keys)) AS shared,
        row_number() OVER (PARTITION BY i.id ORDER BY t.g) AS r FROM issues i JOIN top t ON t.id <> i.id),
f AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY r) AS k FROM c WHERE r <= 60 AND alike),
related AS (SELECT id, string_agg(rid || '(' || array_to_string(shared, '+') || ')', ',' ORDER BY k) AS related FROM f WHERE k <= 5 GROUP BY id)
"""


def _related(spark, sf):
    shown = F.transform("related", lambda r: F.concat(r["id"], F.lit("("), F.array_join(r["shared"], "+"), F.lit(")")))
    return R.related(issues(spark, sf)).select("id", F.array_join(shown, ",").alias("related")).filter("related <> ''")


@query("related", f"WITH {RELATED} SELECT * FROM related")
def related(spark: SparkSession, sf: str) -> DataFrame:
    return _related(spark, sf)


def _charts(spark, sf):
    """One chart per issue with a rule on the anchor's measure; the series depends on the category."""
    of = F.create_map(*[F.lit(x) for kv in {"RATE": "1-URGENT", "MARKET": "2-HIGH", "EARNINGS": "3-MEDIUM", "FX": "5-LOW"}.items() for x in kv])
    asked = issues(spark, sf).select(F.col("id").alias("issue_id"), F.element_at(of, F.col("category")).alias("series_id"))
    words = F.array(F.lit("금리"), F.lit("상승률"))
    return asked.join(_series(spark, sf), "series_id").select("issue_id", "series", words.alias("words"), F.lit(0.6).alias("tol"))


GATE = f"""
{CHARTS}, {ISSUES}, {NEWEST},
lastp AS (SELECT series_id, strftime(max(m), '%Y-%m') AS t, round(arg_max(v, m) / 10000, 2) AS v FROM pts GROUP BY 1),
asked AS (SELECT id, CASE category WHEN 'RATE' THEN '1-URGENT' WHEN 'MARKET' THEN '2-HIGH' WHEN 'EARNINGS' THEN '3-MEDIUM' WHEN 'FX' THEN '5-LOW' END AS series_id FROM issues),
gate AS (SELECT a.id, CASE WHEN n.issue_id IS NULL OR trust <> 'official' OR NOT (contains(metric, '금리') OR contains(metric, '상승률')) THEN true
    WHEN NOT (starts_with(t, period) OR starts_with(period, substr(t, 1, length(period)))) THEN true
    ELSE abs(value - l.v) <= 0.6 * greatest(abs(l.v), 1e-9) END AS shown
  FROM asked a JOIN lastp l USING (series_id) LEFT JOIN newest n ON n.issue_id = a.id)
"""


LAST_YEAR = "(SELECT strftime(max(l_shipdate), '%Y') FROM lineitem)"
YEARLY_GATE = GATE.replace("year(l_shipdate) || '-' || quarter(l_shipdate) || 'Q' AS period", f"{LAST_YEAR} AS period").replace(
    "strftime(max(m), '%Y-%m') AS t", f"{LAST_YEAR} AS t")


@query("consistency_gate", f"WITH {YEARLY_GATE} SELECT id, shown FROM gate")
def consistency_gate(spark: SparkSession, sf: str) -> DataFrame:
    """Charts compared with the newest anchor of the issue, both moved to the last year of the data."""
    year = table(spark, sf, "lineitem").agg(F.date_format(F.max("l_shipdate"), "yyyy")).scalar()
    a = R.newest_anchor(anchors(spark, sf).withColumn("period", year))
    last = F.element_at("series", -1)
    rows = _charts(spark, sf).join(a, "issue_id", "left")
    shown = R.consistent(F.col("a"), F.col("words"), F.col("tol"), F.col("_year"), last["v"])
    return rows.withColumn("_year", year).select(F.col("issue_id").alias("id"), shown.alias("shown"))


@query("event_time", f"""
WITH {ISSUES}, {TIMELINE}
SELECT id, strftime(coalesce(max(seen), any_value(created_at)), '%Y-%m-%d %H:%M:%S') AS event_at FROM issues LEFT JOIN timeline ON issue_id = id GROUP BY id""")
def event_time(spark: SparkSession, sf: str) -> DataFrame:
    rows = R.event_times(issues(spark, sf), timeline(spark, sf))
    return rows.select("id", F.date_format("event_at", "yyyy-MM-dd HH:mm:ss").alias("event_at"))


CARD = f"""
{GATE}, {TIMELINE}, {SUMMARIES},
tl AS (SELECT issue_id, max(seen) AS seen FROM timeline GROUP BY 1),
shown AS (SELECT id, replace(canonical_title, '中', '중국') AS fb FROM (SELECT id, replace(canonical_title, '中國', '중국') AS canonical_title FROM issues)),
spk AS (SELECT series_id, string_agg(CAST(CAST(round(v / 10000, 2) AS DECIMAL(9, 2)) AS VARCHAR), ',' ORDER BY m) AS spark
  FROM (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY m DESC) AS rn FROM pts) WHERE rn <= 8 GROUP BY 1),
card AS (SELECT i.id, CASE WHEN coalesce(s.title, '') <> '' THEN s.title ELSE fb END AS title, CASE WHEN coalesce(s.one_liner, '') <> '' THEN s.one_liner ELSE fb END AS one_liner,
  s.why_now, fb AS raw_title, i.category, i.status, i.origin, seen_sources AS sources, importance, strftime(coalesce(tl.seen, i.created_at), '%Y-%m-%d') AS event_at,
  coalesce(g.shown, false) AS has_visual, CASE WHEN g.shown THEN spark END AS spark
 FROM issues i JOIN shown USING (id) LEFT JOIN summaries s ON s.issue_id = i.id LEFT JOIN tl ON tl.issue_id = i.id LEFT JOIN gate g ON g.id = i.id
 LEFT JOIN asked k ON k.id = i.id LEFT JOIN spk USING (series_id))
"""


def _cards(spark, sf):
    s = summaries(spark, sf).withColumn("impact_line", F.lit(None).cast("string"))
    return R.cards(issues(spark, sf), s, timeline(spark, sf), anchors(spark, sf), _charts(spark, sf))


def _plain_cards(rows):
    shown = F.array_join(F.transform("spark", lambda v: v.cast("decimal(9,2)").cast("string")), ",")
    return rows.select(
        "id", "title", "one_liner", "why_now", "raw_title", "category", "status", "origin", "sources", "importance",
        F.date_format("event_at", "yyyy-MM-dd").alias("event_at"), "has_visual", shown.alias("spark"))


@query("card", f"WITH {CARD} SELECT * FROM card")
def card(spark: SparkSession, sf: str) -> DataFrame:
    return _plain_cards(_cards(spark, sf))


DETAIL = f"""
{ISSUES}, {ANCHORS}, {ARTICLES}, {TIMELINE},
t40 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY issue_id ORDER BY seen DESC, seq DESC) AS rn FROM timeline) WHERE rn <= 40),
t AS (SELECT issue_id, string_agg(seq, ',' ORDER BY rn) AS timeline FROM (SELECT *, row_number() OVER (PARTITION BY issue_id ORDER BY rn) AS k FROM t40 WHERE source <> '2-HIGH') WHERE k <= 30 GROUP BY 1),
h20 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY issue_id ORDER BY published_at DESC, aid) AS rn FROM articles WHERE issue_id IS NOT NULL AND NOT is_dup) WHERE rn <= 20),
h AS (SELECT issue_id, string_agg(aid, ',' ORDER BY rn) AS headlines FROM (SELECT *, row_number() OVER (PARTITION BY issue_id ORDER BY rn) AS k FROM h20 WHERE title NOT LIKE 'これ%') WHERE k <= 10 GROUP BY 1),
a1 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY issue_id, entity, metric, period ORDER BY seq DESC) AS rn FROM anchors) WHERE rn = 1),
a AS (SELECT issue_id, string_agg(entity || metric || period, ',' ORDER BY k) AS anchors FROM
  (SELECT *, row_number() OVER (PARTITION BY issue_id ORDER BY observed_at DESC, seq DESC) AS k FROM a1) WHERE k <= 12 GROUP BY 1)
"""


@query("detail", f"""
WITH {DETAIL} SELECT id, timeline, headlines, anchors FROM issues LEFT JOIN t ON t.issue_id = id LEFT JOIN h ON h.issue_id = id LEFT JOIN a ON a.issue_id = id""")
def detail(spark: SparkSession, sf: str) -> DataFrame:
    lists = R.detail_lists(timeline(spark, sf), articles(spark, sf), anchors(spark, sf))
    s = summaries(spark, sf).select("issue_id", F.array("title").alias("details"), F.array("why_now").alias("effects"), "model")
    rows = R.details(issues(spark, sf).select("id"), lists, s, R.related(issues(spark, sf)))
    tail = lambda u: F.regexp_extract(u, r"(\d+)$", 1)
    return rows.select(
        "id", F.array_join(F.transform("timeline", lambda x: tail(x["url"])), ",").alias("timeline"),
        F.array_join(F.transform("headlines", lambda x: tail(x["url"])), ",").alias("headlines"),
        F.array_join(F.transform("anchors", lambda x: F.concat(x["entity"], x["metric"], x["period"])), ",").alias("anchors"))


@query("detail_glossary", f"""
WITH {SUMMARIES}, n AS (SELECT issue_id, title, CAST(substr(issue_id, 2) AS BIGINT) AS c FROM summaries)
SELECT issue_id AS id, CASE WHEN title <> '' THEN '요약=short|' ELSE '' END || '한 줄=line|why=reason' || CASE WHEN c % 2 = 0 THEN '' ELSE '|extra' || (c % 5) || '=made' END AS terms FROM n""")
def detail_glossary(spark: SparkSession, sf: str) -> DataFrame:
    """Terms of each detail document: reviewed ones in the order of the text, then generated ones under new names."""
    c = F.substring("issue_id", 2, 20).cast("long")
    made = F.when(c % 2 == 0, " Why").otherwise(F.concat(F.lit("extra"), (c % 5).cast("string")))
    told = summaries(spark, sf).withColumn("glossary", F.array(F.struct(made.alias("term"), F.lit("made").alias("easy"), F.lit("").alias("example"))))
    rows = told.select(F.col("issue_id").alias("id"), "title", "one_liner", "why_now", F.array(F.lit("and the why of it")).alias("details"))
    surfaces = {"요약": "요약", "한 줄": "한 줄", "why": "why", "nowhere": "gone"}
    found = R.with_glossary(rows, told, surfaces, {"요약": ("short", ""), "한 줄": ("line", "x"), "why": ("reason", "")})
    return found.select("id", F.array_join(F.transform("glossary", lambda g: F.concat(g["term"], F.lit("="), g["easy"])), "|").alias("terms"))


PUBLISH = f"""
{ISSUES}, {SUMMARIES}, {ANCHORS}, {ARTICLES},
ca AS (SELECT issue_id, count(*) AS n FROM anchors GROUP BY 1),
cs AS (SELECT issue_id, count(DISTINCT source) AS n FROM articles WHERE NOT is_dup AND issue_id IS NOT NULL GROUP BY 1),
g AS (SELECT i.*, s.model, CASE WHEN coalesce(s.title, '') <> '' THEN s.title ELSE canonical_title END AS shown, coalesce(ca.n, 0) AS na, coalesce(cs.n, 0) AS ns
  FROM issues i LEFT JOIN summaries s ON s.issue_id = i.id LEFT JOIN ca ON ca.issue_id = i.id LEFT JOIN cs ON cs.issue_id = i.id),
pub AS (SELECT *, CASE WHEN coalesce(model, '') NOT IN ('', 'template') THEN true
   WHEN len(regexp_extract_all(shown, '[가-힣]')) / len(regexp_replace(shown, '\\s', '', 'g')) < 0.3 THEN false
   WHEN na = 0 AND len(keys) = 0 AND category = 'ETC' THEN false WHEN na > 0 THEN true ELSE ns >= 2 END AS publish FROM g)
"""


def _publishable(spark, sf):
    return R.publishable(issues(spark, sf), summaries(spark, sf), anchors(spark, sf), distinct_sources(articles(spark, sf)))


@query("publish_gate", f"WITH {PUBLISH} SELECT id, publish FROM pub")
def publish_gate(spark: SparkSession, sf: str) -> DataFrame:
    return _publishable(spark, sf).select("id", "publish")


RULES = [
    {"rule_id": "fx", "categories": ["FX"], "keywords": ["customer#00000001", "요약"]},
    {"rule_id": "keys", "entities": ["N3", "N9"]},
    {"rule_id": "both", "categories": ["RATE", "MARKET"], "entities": ["N2"]},
    {"rule_id": "pinned", "issue_id": "i7"}, {"rule_id": "anchor", "anchor_key": "A11"}, {"rule_id": "none", "categories": ["GEO"]},
]


@query("rule_latest", f"""
WITH {ISSUES}, {SUMMARIES}, {TIMELINE},
tl AS (SELECT issue_id, max(seen) AS seen FROM timeline GROUP BY 1),
l AS (SELECT i.*, lower(canonical_title || ' ' || coalesce(s.title, '')) AS hay, coalesce(tl.seen, i.created_at) AS event_at FROM issues i
  LEFT JOIN summaries s ON s.issue_id = i.id LEFT JOIN tl ON tl.issue_id = i.id WHERE status IN ('active', 'stale')),
m AS (SELECT 'fx' AS rule_id, * FROM l WHERE category = 'FX' AND (contains(hay, 'customer#00000001') OR contains(hay, '요약'))
  UNION ALL SELECT 'keys', * FROM l WHERE list_has_any(keys, ['N3', 'N9'])
  UNION ALL SELECT 'both', * FROM l WHERE category IN ('RATE', 'MARKET') AND list_has_any(keys, ['N2'])
  UNION ALL SELECT 'pinned', * FROM l WHERE id = 'i7' UNION ALL SELECT 'anchor', * FROM l WHERE anchor_key = 'A11')
SELECT rule_id, id, canonical_title FROM (SELECT *, row_number() OVER (PARTITION BY rule_id ORDER BY event_at DESC, last_update DESC, id DESC) AS rn FROM m) WHERE rn = 1""")
def rule_latest(spark: SparkSession, sf: str) -> DataFrame:
    titles = summaries(spark, sf).select(F.col("issue_id").alias("id"), F.col("title").alias("summary_title"))
    rows = R.event_times(issues(spark, sf), timeline(spark, sf)).join(titles, "id", "left")
    return R.latest_match(RULES, rows).select("rule_id", "id", "canonical_title")


@query("phrase_refs", f"""
WITH {ISSUES}, live AS (SELECT * FROM issues WHERE status IN ('active', 'stale')),
p AS (SELECT doc_id, text, lang FROM documents),
r AS (SELECT doc_id, text, n, CASE n WHEN 0 THEN 'the' WHEN 1 THEN 'eaux' ELSE 'zzz' END AS phrase,
   CASE n WHEN 0 THEN 'i' || doc_id ELSE (SELECT min(id) FROM live WHERE anchor_key = 'A' || doc_id) END AS issue_id FROM p, (SELECT unnest([0, 1, 2]) AS n)),
g AS (SELECT doc_id, string_agg(phrase || '>' || issue_id, ',' ORDER BY n) AS refs FROM r WHERE contains(text, phrase) AND issue_id IN (SELECT id FROM live) GROUP BY doc_id)
SELECT doc_id, refs FROM p LEFT JOIN g USING (doc_id)""")
def phrase_refs(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as paragraphs of a topic; each names three phrases and an issue or an anchor key."""
    key = F.col("doc_id").cast("string")
    none = F.lit(None).cast("string")
    ref = lambda phrase, i, a: F.struct(F.lit(phrase).alias("phrase"), i.alias("issue_id"), a.alias("anchor_key"))
    paragraphs = table(spark, sf, "documents").select(
        F.col("lang").alias("topic"), F.col("doc_id").alias("pos"), "text",
        F.array(ref("the", F.concat(F.lit("i"), key), none), ref("eaux", none, F.concat(F.lit("A"), key)),
                ref("zzz", none, F.concat(F.lit("A"), key))).alias("refs"))
    rows = R.live_refs(paragraphs, issues(spark, sf))
    shown = F.array_join(F.transform("refs", lambda r: F.concat(r["phrase"], F.lit(">"), r["issue_id"])), ",")
    return rows.select(F.col("pos").alias("doc_id"), shown.alias("refs"))


@query("table_shape", """
WITH t AS (SELECT conv_id, turn, string_split(text, chr(10)) AS rows FROM conversations)
SELECT conv_id, turn, CASE WHEN len(list_filter(rows, lambda r: len(string_split(r, ', ')) = 2)) > 0
  THEN array_to_string(list_filter(rows, lambda r: len(string_split(r, ', ')) = 2), '|') END AS kept FROM t""")
def table_shape(spark: SparkSession, sf: str) -> DataFrame:
    """Lines as table rows, split at commas; only lines with two cells fit the two columns."""
    rows = F.transform(F.split("text", "\n"), lambda r: F.split(r, ", "))
    t = table(spark, sf, "conversations").withColumn("cells", rows).withColumn("columns", F.array(F.lit("a"), F.lit("b")))
    kept = R.table_rows("columns", "cells")
    return t.select("conv_id", "turn", F.when(kept.isNotNull(), F.array_join(F.transform(kept, lambda r: F.array_join(r, ", ")), "|")).alias("kept"))


@query("index_doc", f"""
WITH {PUBLISH},
feed AS (SELECT * FROM pub WHERE status IN ('active', 'stale') ORDER BY CASE status WHEN 'active' THEN 0 ELSE 1 END, importance DESC, last_update DESC, id LIMIT 200)
SELECT CAST(3 AS INTEGER) AS schema_version, CAST(count(*) FILTER (publish) AS BIGINT) AS issues, CAST(count(*) FILTER (NOT publish) AS BIGINT) AS thin_skipped,
  string_agg(id, ',' ORDER BY CASE status WHEN 'active' THEN 0 ELSE 1 END, importance DESC, last_update DESC, id) FILTER (publish) AS ids FROM feed""")
def index_doc(spark: SparkSession, sf: str) -> DataFrame:
    """The index document: the first 200 of the ranked feed that may be published, in order."""
    from ...operators.lifecycle import ranked_feed

    feed = cut(ranked_feed(_publishable(spark, sf)).select("id", "status", "importance", "last_update", "publish"))
    shown = R.index_document(feed.filter("publish").drop("publish"), now(), "sources of the tables")
    thin = feed.agg(F.count_if(~F.col("publish"))).scalar()
    return shown.select(
        "schema_version", F.size("issues").cast("long").alias("issues"), thin.alias("thin_skipped"),
        F.array_join(F.transform("issues", lambda c: F.get_json_object(c, "$.id")), ",").alias("ids"))


@query("orphan_details", f"""
WITH {ISSUES} SELECT DISTINCT 'i' || o_custkey AS id FROM orders WHERE 'i' || o_custkey NOT IN (SELECT id FROM issues WHERE status IN ('active', 'stale'))""")
def orphan_details(spark: SparkSession, sf: str) -> DataFrame:
    written = table(spark, sf, "orders").select(F.concat(F.lit("i"), F.col("o_custkey").cast("string")).alias("id")).distinct()
    return R.orphaned(written, issues(spark, sf).filter(F.col("status").isin("active", "stale")))


# --- curated package: parts as curated issues, suppliers as topics, brands as visuals ---

CURATED = """
ci AS (SELECT 'p' || p_partkey AS id, p_name AS title, p_type, CASE p_type WHEN 'ECONOMY' THEN 'weekly' WHEN 'SMALL' THEN 'monthly' WHEN 'PROMO' THEN 'daily' ELSE 'yearly' END AS tier,
  CASE WHEN p_size <= 10 THEN 'RATE' WHEN p_size <= 40 THEN 'FX' ELSE 'ODD' END AS category, TIMESTAMP '2024-01-01' + to_hours(CAST(p_retailprice AS INTEGER)) AS event_at, p_size,
  p_partkey, p_brand FROM part),
topics AS (SELECT 's' || s_suppkey AS id, s_nationkey, s_suppkey FROM supplier)
"""


def _curated(spark, sf):
    key = F.col("p_partkey").cast("string")
    size = F.col("p_size")
    stat = lambda d: F.struct(F.lit("1").alias("value"), F.lit("l").alias("label"), d.alias("direction"))
    effect = lambda d, t: F.struct(F.lit("l").alias("label"), d.alias("direction"), t.alias("text"), F.lit("b").alias("basis"))
    stats = F.when(size == 50, F.array(stat(F.lit("up")))).otherwise(
        F.array(stat(F.lit("up")), stat(F.when(size == 49, "sideways").otherwise("flat"))))
    tiers = {"ECONOMY": "weekly", "SMALL": "monthly", "PROMO": "daily", "MEDIUM": "yearly", "STANDARD": "yearly", "LARGE": "yearly"}
    from .views import mapped

    return table(spark, sf, "part").select(
        F.concat(F.lit("p"), key).alias("id"), F.col("p_name").alias("title"), mapped("p_type", tiers).alias("tier"),
        F.when(size <= 10, "RATE").when(size <= 40, "FX").otherwise("ODD").alias("category"),
        (F.lit("2024-01-01").cast("timestamp") + F.make_dt_interval(hours=F.rint("p_retailprice").cast("int"))).alias("event_at"),
        stats.alias("key_stats"), F.array(effect(F.when(size == 48, "sideways").otherwise("info"), F.concat(F.lit("text "), "p_brand"))).alias("effect_rows"),
        F.array(F.col("p_brand"), F.concat(F.lit("V"), (size + 5).cast("string"))).alias("visual_ids"),
        F.array(F.concat(F.lit("s"), F.col("p_partkey").cast("string"))).alias("topic_ids"),
        F.array(F.concat(F.lit("more about "), "p_name")).alias("details"), F.lit(None).cast("string").alias("impact_line"))


def _visuals(spark, sf):
    """Brands are charts, sizes are tables; a chart's series are the prices of the brand."""
    p = table(spark, sf, "part")
    point = F.struct(F.col("p_partkey").cast("string").alias("t"), F.col("p_retailprice").alias("v"))
    none = F.array().cast("array<struct<t:string,v:double>>")
    packed = F.array_sort(F.collect_list(F.struct("p_partkey", point.alias("x"))))
    points = F.transform("_p", lambda x: x["x"])
    odd = F.substring("p_brand", -1, 1).isin("1", "3", "5", "7", "9")
    brands = p.groupBy("p_brand").agg(packed.alias("_p")).select(
        F.col("p_brand").alias("visual_id"), F.when(odd, "chart").alias("kind"),
        F.when(odd, points).otherwise(none).alias("series"), F.when(odd, F.array().cast("array<array<struct<t:string,v:double>>>")).otherwise(F.array(points)).alias("series_multi"))
    sizes = p.select(F.concat(F.lit("V"), F.col("p_size").cast("string")).alias("visual_id")).distinct().select(
        "visual_id", F.lit("table").alias("kind"), none.alias("series"), F.array().cast("array<array<struct<t:string,v:double>>>").alias("series_multi"))
    return brands.unionByName(sizes)


def _topics(spark, sf):
    s = table(spark, sf, "supplier")
    nation = F.col("s_nationkey").cast("string")
    return s.select(
        F.concat(F.lit("s"), F.col("s_suppkey").cast("string")).alias("id"),
        F.array(F.concat(F.lit("Brand#"), nation)).alias("visual_ids"),
        F.array(F.struct(F.lit("d").alias("date_label"), F.array(F.concat(F.lit("p"), F.floor(F.col("s_acctbal")).cast("string"))).alias("issue_ids"))).alias("timeline"))


@query("integrity_report", f"""
WITH {CURATED},
vis AS (SELECT DISTINCT p_brand AS v FROM part UNION SELECT DISTINCT 'V' || p_size FROM part)
SELECT 'unknown category' AS rule, id AS item, category AS value FROM ci WHERE category = 'ODD'
UNION ALL SELECT 'unknown tier', id, tier FROM ci WHERE tier = 'daily'
UNION ALL SELECT 'not two key stats', id, '1' FROM ci WHERE p_size = 50
UNION ALL SELECT 'unknown stat direction', id, 'sideways' FROM ci WHERE p_size = 49
UNION ALL SELECT 'unknown effect direction', id, 'sideways' FROM ci WHERE p_size = 48
UNION ALL SELECT 'unknown visual', id, 'V' || (p_size + 5) FROM ci WHERE 'V' || (p_size + 5) NOT IN (SELECT v FROM vis)
UNION ALL SELECT 'unknown topic', id, 's' || p_partkey FROM ci WHERE 's' || p_partkey NOT IN (SELECT id FROM topics)
UNION ALL SELECT 'unknown visual of topic', 's' || s_suppkey, 'Brand#' || s_nationkey FROM supplier WHERE 'Brand#' || s_nationkey NOT IN (SELECT v FROM vis)
UNION ALL SELECT 'unresolved timeline link', 's' || s_suppkey, 'p' || CAST(floor(s_acctbal) AS BIGINT) FROM supplier WHERE 'p' || CAST(floor(s_acctbal) AS BIGINT) NOT IN (SELECT id FROM ci)
UNION ALL SELECT 'incomplete glossary entry', CAST(doc_id AS VARCHAR), '' FROM documents WHERE text NOT LIKE '%' || chr(10) || '%'""")
def integrity_report(spark: SparkSession, sf: str) -> DataFrame:
    categories = table(spark, sf, "region").select(F.when(F.col("r_regionkey") < 2, "RATE").otherwise("FX").alias("category")).distinct()
    glossary = table(spark, sf, "documents").select(
        F.col("doc_id").cast("string").alias("term"), F.when(F.col("text").contains("\n"), "x").otherwise("").alias("easy"))
    return N.integrity_report(_curated(spark, sf), _topics(spark, sf), _visuals(spark, sf), categories, glossary)


RANKED = f"""
{CURATED},
ranked AS (SELECT *, CAST(CASE tier WHEN 'weekly' THEN 3000 WHEN 'monthly' THEN 2000 WHEN 'yearly' THEN 1000 END + count(*) OVER (PARTITION BY tier)
   - row_number() OVER (PARTITION BY tier ORDER BY event_at DESC, id) + 1 AS BIGINT) AS importance FROM ci)
"""


@query("tier_rank", f"WITH {RANKED} SELECT id, tier, importance FROM ranked")
def tier_rank(spark: SparkSession, sf: str) -> DataFrame:
    return N.tier_scores(_curated(spark, sf)).select("id", "tier", "importance")


VIS = """
vis AS (SELECT DISTINCT p_brand AS v, true AS chart FROM part UNION ALL SELECT DISTINCT 'V' || p_size, false FROM part),
want AS (SELECT 'p' || p_partkey AS id, 0 AS pos, p_brand AS v FROM part UNION ALL SELECT 'p' || p_partkey, 1, 'V' || (p_size + 5) FROM part),
res AS (SELECT id, string_agg(v, ',' ORDER BY pos) AS visuals, min(CASE WHEN chart THEN v END) AS "primary" FROM want JOIN vis USING (v) GROUP BY id)
"""


@query("visual_resolve", f"WITH {VIS} SELECT * FROM res")
def visual_resolve(spark: SparkSession, sf: str) -> DataFrame:
    rows = N.resolved_visuals(_curated(spark, sf), _visuals(spark, sf))
    return rows.select("id", F.array_join(F.transform("visuals", lambda v: v["visual_id"]), ",").alias("visuals"), F.col("primary.visual_id").alias("primary"))


@query("curated_docs", f"""
WITH {RANKED}, {VIS},
bp AS (SELECT p_brand AS v, p_retailprice AS price, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) AS rn FROM part),
cnt AS (SELECT v, max(rn) AS n FROM bp GROUP BY v),
sp AS (SELECT v, string_agg(CAST(CAST(price AS DECIMAL(9, 1)) AS VARCHAR), ',' ORDER BY rn) AS spark FROM bp JOIN cnt USING (v) WHERE n >= 2 AND rn > n - 8 GROUP BY v)
SELECT r.id, title, importance, visuals, spark, CASE category WHEN 'RATE' THEN '🏦' WHEN 'FX' THEN '💱' ELSE '📰' END AS icon, 'text ' || p_brand AS effects,
  CASE WHEN contains(title, 'red') THEN 'color' || CASE WHEN contains(title, 'widget') THEN '|thing' ELSE '' END
       WHEN contains(title, 'widget') THEN 'thing' ELSE '' END AS terms
FROM ranked r LEFT JOIN res USING (id) LEFT JOIN sp ON sp.v = r.p_brand""")
def curated_docs(spark: SparkSession, sf: str) -> DataFrame:
    cards = N.curated_cards(_curated(spark, sf), _visuals(spark, sf))
    rows = N.curated_details(cards, {"red": "color", "widget": "thing"})
    return rows.select(
        "id", "title", "importance", F.array_join(F.transform("visuals", lambda v: v["visual_id"]), ",").alias("visuals"),
        F.array_join(F.transform("spark", lambda v: v.cast("decimal(9,1)").cast("string")), ",").alias("spark"), "icon",
        F.array_join("effects", ",").alias("effects"), F.array_join("terms", "|").alias("terms"))


@query("curated_topics", """
WITH vis AS (SELECT DISTINCT p_brand AS v FROM part)
SELECT 's' || s_suppkey AS id, v AS "primary" FROM supplier LEFT JOIN vis ON v = 'Brand#' || s_nationkey""")
def curated_topics(spark: SparkSession, sf: str) -> DataFrame:
    return N.curated_topics(_topics(spark, sf), _visuals(spark, sf)).select("id", F.col("primary.visual_id").alias("primary"))
