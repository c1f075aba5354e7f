"""Queries on payloads, template summaries and the validation of generated text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ...operators import summary as Y
from ...operators.cluster import representative_rows
from ...settings import Settings
from . import query, table
from .views import ANCHORS, ARTICLES, ISSUES, SUMMARIES, anchors, articles, issues, summaries


def _payloads(spark, sf):
    a = articles(spark, sf)
    members = a.filter(F.col("issue_id").isNotNull() & ~F.col("is_dup")).select(
        F.col("issue_id").alias("iid"), "aid", "published_at", F.lit(None).cast("double").alias("sim"), F.lit(False).alias("has_centroid"), "title")
    heads = representative_rows(members, 5).select(F.col("iid").alias("issue_id"), "rank", "title")
    return Y.payloads(issues(spark, sf), anchors(spark, sf), heads, a, Settings())


PAYLOAD = f"""
{ISSUES}, {ANCHORS}, {ARTICLES},
a8 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY issue_id ORDER BY observed_at DESC, seq DESC) AS rn FROM anchors) WHERE rn <= 8),
h5 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY issue_id ORDER BY published_at DESC, aid) AS rn FROM articles
       WHERE issue_id IS NOT NULL AND NOT is_dup) WHERE rn <= 5),
o2 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY issue_id ORDER BY published_at DESC, aid) AS rn FROM articles
       WHERE tier = 'official' AND lead <> '' AND issue_id IS NOT NULL) WHERE rn <= 2),
ga AS (SELECT issue_id, string_agg(entity || ' ' || metric || ' ' || coalesce(CAST(CAST(value AS DECIMAL(9, 1)) AS VARCHAR), '-') || unit || ' ' || period, ';' ORDER BY rn) AS anchors FROM a8 GROUP BY 1),
gh AS (SELECT issue_id, string_agg(title, ';' ORDER BY rn) AS headlines FROM h5 GROUP BY 1),
gl AS (SELECT issue_id, string_agg(lead, ';' ORDER BY rn) AS leads FROM o2 GROUP BY 1),
payload AS (SELECT id AS issue_id, category, coalesce(anchors, '') AS anchors, coalesce(headlines, canonical_title) AS headlines, coalesce(leads, '') AS official_lines
  FROM issues i LEFT JOIN ga ON ga.issue_id = id LEFT JOIN gh ON gh.issue_id = id LEFT JOIN gl ON gl.issue_id = id)
"""


def _flat(rows):
    fact = lambda a: F.concat(
        a["entity"], F.lit(" "), a["metric"], F.lit(" "), F.coalesce(a["value"].cast("decimal(9,1)").cast("string"), F.lit("-")), a["unit"], F.lit(" "), a["period"])
    return rows.withColumn("anchors", F.array_join(F.transform("anchors", fact), ";")).withColumn(
        "headlines", F.array_join("headlines", ";")).withColumn("official_lines", F.array_join("official_lines", ";"))


@query("payload", f"WITH {PAYLOAD} SELECT * FROM payload")
def payload(spark: SparkSession, sf: str) -> DataFrame:
    return _flat(_payloads(spark, sf))


@query("fingerprint_changes", f"""
WITH {PAYLOAD},
old AS (SELECT issue_id, anchors, headlines FROM payload),
gone AS (SELECT 'i' || c_custkey AS issue_id FROM customer WHERE c_acctbal > 3000)
SELECT p.issue_id, p.issue_id IN (SELECT issue_id FROM gone) AND p.anchors <> '' AS changed FROM payload p""")
def fingerprint_changes(spark: SparkSession, sf: str) -> DataFrame:
    """Issues whose facts differ from the stored ones; stored facts of rich customers lack their anchors."""
    rows = _payloads(spark, sf)
    rich = table(spark, sf, "customer").filter("c_acctbal > 3000").select(
        F.concat(F.lit("i"), F.col("c_custkey").cast("string")).alias("issue_id"), F.lit(True).alias("rich"))
    now_ = rows.join(rich, "issue_id", "left").withColumn("fact_hash", Y.fingerprint())
    none = F.filter("anchors", lambda a: F.lit(False))
    stored = now_.withColumn("anchors", F.when(F.col("rich"), none).otherwise(F.col("anchors"))).select("issue_id", Y.fingerprint().alias("old_hash"))
    return now_.join(stored, "issue_id").select("issue_id", (F.col("fact_hash") != F.col("old_hash")).alias("changed"))


@query("template_summary", f"""
WITH {PAYLOAD},
n AS (SELECT *, CASE WHEN value IS NOT NULL THEN CAST(CAST(value AS DECIMAL(9, 1)) AS VARCHAR) END AS vt, CASE WHEN prev IS NOT NULL THEN CAST(CAST(prev AS DECIMAL(9, 1)) AS VARCHAR) END AS pt FROM a8),
u AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY issue_id ORDER BY rn) AS k FROM n WHERE value IS NOT NULL AND metric <> '변동폭') WHERE k = 1),
lines AS (SELECT issue_id, string_agg(entity || ' ' || metric || ': ' || vt || unit || CASE WHEN pt IS NOT NULL THEN ' (직전 ' || pt || unit || ')' ELSE '' END, ';' ORDER BY rn) AS d
  FROM n WHERE rn <= 4 AND value IS NOT NULL GROUP BY 1),
h1 AS (SELECT issue_id, title FROM h5 WHERE rn = 1),
h3 AS (SELECT issue_id, string_agg(title, ';' ORDER BY rn) AS hs FROM h5 WHERE rn <= 3 GROUP BY 1),
t AS (SELECT i.id AS issue_id, i.category, coalesce(d, hs, canonical_title) AS details, coalesce(h1.title, canonical_title) AS head, u.issue_id IS NOT NULL AS has,
  entity || ' ' || metric || ' ' || vt || unit AS t1,
  CASE WHEN pt IS NOT NULL THEN entity || ' ' || metric || CASE WHEN metric = '기준금리' THEN '가' ELSE '이' END || ' ' || pt || unit || '에서 ' || vt || unit || CASE WHEN unit = '원' THEN '으로' ELSE '로' END || ' 바뀌었어요'
       ELSE entity || ' ' || metric || ' ' || vt || unit || CASE WHEN unit = '원' THEN '으로' ELSE '로' END || ' 발표됐어요' END AS o1
  FROM issues i LEFT JOIN u ON u.issue_id = i.id LEFT JOIN lines ON lines.issue_id = i.id LEFT JOIN h1 ON h1.issue_id = i.id LEFT JOIN h3 ON h3.issue_id = i.id),
p AS (SELECT *, CASE WHEN has THEN t1 ELSE head END AS ti, CASE WHEN has THEN o1 ELSE head END AS ol FROM t),
c AS (SELECT *, substr(ti, 1, 21) AS th, rtrim(regexp_extract(substr(ti, 1, 21), '^(.*) ', 1)) AS tw, substr(ol, 1, 49) AS oh, rtrim(regexp_extract(substr(ol, 1, 49), '^(.*) ', 1)) AS ow FROM p)
SELECT issue_id, details,
  CASE WHEN length(ti) <= 22 THEN ti ELSE rtrim(CASE WHEN contains(th, ' ') AND length(tw) >= 11 THEN tw ELSE th END) || '…' END AS title,
  CASE WHEN length(ol) <= 50 THEN ol ELSE rtrim(CASE WHEN contains(oh, ' ') AND length(ow) >= 25 THEN ow ELSE oh END) || '…' END AS one_liner,
  CASE category WHEN 'RATE' THEN 'kr_base_rate' WHEN 'MARKET' THEN 'us_10y' WHEN 'FX' THEN 'usdkrw' WHEN 'EARNINGS' THEN 'earnings_quarterly' ELSE 'none' END AS visual_type
FROM c""")
def template_summary(spark: SparkSession, sf: str) -> DataFrame:
    rows = Y.template_summary(_payloads(spark, sf))
    return rows.select("issue_id", F.array_join("details", ";").alias("details"), "title", "one_liner", "visual_type")


def _generated(spark, sf):
    """Turns as generated summaries: their words fill the fields, their number of words decides which rules break."""
    c = table(spark, sf, "conversations")
    w = F.split("text", r"\s+")
    word = lambda n: F.coalesce(F.get(w, F.lit(n)), F.lit(""))
    polite = F.when(F.col("role") == "assistant", "해요").otherwise("함")
    n = F.size(w)
    out = F.struct(
        F.when(F.col("turn") == 5, F.concat(word(0), F.lit("中"))).otherwise(F.concat_ws(" ", word(0), word(1), word(2))).alias("title"),
        F.concat(word(3), F.lit(" "), n.cast("string"), F.lit("개 "), polite).alias("one_liner"),
        F.when(F.col("turn") == 4, "").otherwise(F.concat(word(4), F.lit(" "), polite)).alias("why_now"),
        F.concat(word(5), polite).alias("impact_line"),
        F.array(*[F.concat(F.lit(f"항목{i} "), word(6 + i), F.lit(" "), word(12 + i), polite) for i in range(4)]).alias("details"),
        F.when(F.col("turn") == 2, "wti").otherwise("none").alias("visual_type"),
        F.when(F.col("turn") == 3, F.array(F.lit("무조건!"))).otherwise(F.array(F.concat(word(7), F.lit(" 효과!")), F.concat(word(8), polite))).alias("effects"),
        F.array(
            F.struct(word(0).alias("term"), F.lit("쉬운 말이에요").alias("easy"), F.col("text").alias("example")),
            F.struct(F.lower(word(0)).alias("term"), F.lit("다시 쓴 말이에요").alias("easy"), F.lit("").alias("example")),
            F.struct(word(1).alias("term"), F.lit("유동성 말이에요").alias("easy"), F.lit("").alias("example")),
            F.struct(word(2).alias("term"), F.lit("둘째 말이에요").alias("easy"), F.lit("짧은 예").alias("example")),
            F.struct(F.lit("없는말").alias("term"), F.lit("말이에요").alias("easy"), F.lit("").alias("example"))).alias("glossary"),
    )
    facts = F.struct(F.size(F.split("text", r"\.")).alias("sentences"), F.length("text").alias("chars"))
    anchor = F.struct(n.cast("double").alias("value"), F.lit(None).cast("double").alias("prev"))
    return c.select(
        F.concat_ws("-", "conv_id", "turn").alias("issue_id"), "conv_id", "turn", "role", "text", out.alias("out"),
        F.to_json(facts).alias("facts_json"),
        F.when(F.col("turn") != 1, F.array(anchor)).otherwise(F.array().cast("array<struct<value:double,prev:double>>")).alias("anchors"),
        F.array(F.lit("kospi_close")).alias("allowed_visuals"))


@query("text_validation")
def text_validation(spark: SparkSession, sf: str) -> DataFrame:
    checked = Y.validate(_generated(spark, sf))
    return checked.select("issue_id", F.array_join("errors", "; ").alias("errors"), "impact_line", F.size("details").alias("n_details"))


@query("review_split", r"""
WITH w AS (SELECT conv_id, turn, role, string_split_regex(text, '\s+') AS w FROM conversations)
SELECT conv_id || '-' || turn AS issue_id, turn = 5 AS foreign_title, turn = 4 AS why_missing, role <> 'assistant' AS rude, turn = 2 AS visual, turn = 3 AS banned FROM w""")
def review_split(spark: SparkSession, sf: str) -> DataFrame:
    """Which reasons of rejection a row shows; accepted rows show none."""
    checked = Y.validate(_generated(spark, sf))
    has = lambda m: F.exists("errors", lambda e: e.startswith(m))
    return checked.select(
        "issue_id", has("title has Han").alias("foreign_title"), has("why_now missing").alias("why_missing"),
        has("one_liner not polite").alias("rude"), has("visual not allowed").alias("visual"), has("banned").alias("banned"))


@query("numeric_grounding", r"""
WITH c AS (SELECT a.conv_id, a.turn, a.text, b.text AS facts FROM conversations a LEFT JOIN conversations b ON b.conv_id = a.conv_id AND b.turn = a.turn - 1),
n AS (SELECT conv_id, turn, list_distinct(list_transform(regexp_extract_all(text, '-?\d[\d,]*\.?\d*'), lambda m: round(CAST(replace(m, ',', '') AS DOUBLE), 6))) AS o,
   list_distinct(list_transform(regexp_extract_all(coalesce(facts, ''), '-?\d[\d,]*\.?\d*'), lambda m: round(CAST(replace(m, ',', '') AS DOUBLE), 6))) AS f FROM c),
x AS (SELECT conv_id, turn, list_filter(o, lambda v: NOT list_contains(f, v) AND NOT list_contains(list_transform(f, lambda y: abs(y)), v)
     AND NOT list_contains(list_transform(f, lambda y: round_even(y, 0)), v) AND NOT list_contains(list_transform(f, lambda y: round_even(y, 1)), v)
     AND NOT ((v BETWEEN 1900 AND 2100 OR v BETWEEN 0 AND 12) AND v = floor(v))) AS extra FROM n)
SELECT conv_id, turn, CAST(len(extra) AS INTEGER) AS n_extra, len(extra) = 0 AS grounded FROM x""")
def numeric_grounding(spark: SparkSession, sf: str) -> DataFrame:
    """Numbers of a turn that the turn before it does not explain."""
    c = table(spark, sf, "conversations")
    before = c.select("conv_id", (F.col("turn") + 1).alias("turn"), F.col("text").alias("facts"))
    none = F.array().cast("array<struct<value:double,prev:double>>")
    rows = c.join(before, ["conv_id", "turn"], "left").withColumn("facts", F.coalesce("facts", F.lit(""))).withColumn("none", none)
    extra = Y.ungrounded("text", Y.allowed_numbers(F.col("facts"), F.col("none")))
    return rows.withColumn("extra", extra).select(
        "conv_id", "turn", F.size("extra").alias("n_extra"), (F.size("extra") == 0).alias("grounded"))


@query("anchor_grounding", f"""
WITH {ANCHORS},
d AS (SELECT issue_id, seq, value, prev, round(abs(value - prev), 6) AS d FROM anchors WHERE value IS NOT NULL),
o AS (SELECT *, [value * 100, value + 1000.5, d, round(d * 100, 6), 2024.0, 13.0] AS said FROM d)
SELECT issue_id, seq, CAST(len(list_filter(list_distinct(list_filter(list_transform(said, lambda v: round(v, 6)), lambda v: v IS NOT NULL)), lambda v:
   NOT coalesce(list_contains(list_filter([d, round(d * 100, 6), round_even(d, 0), round(value, 6), round(value * 100, 6), round_even(value, 0), round_even(value, 1)], lambda y: y IS NOT NULL), v), false)
   AND NOT ((v BETWEEN 1900 AND 2100 OR v BETWEEN 0 AND 12) AND v = floor(v)))) AS INTEGER) AS n_extra FROM o""")
def anchor_grounding(spark: SparkSession, sf: str) -> DataFrame:
    """Statements about every anchor, right and wrong ones, checked against what may be derived from it."""
    a = anchors(spark, sf).filter(F.col("value").isNotNull())
    d = F.round(F.abs(F.col("value") - F.col("prev")), 6)
    num = lambda x: F.coalesce(x.cast("decimal(18,6)").cast("string"), F.lit(""))
    said = F.concat_ws(" ; ", num(F.col("value") * 100), num(F.col("value") + 1000.5), num(d), num(F.round(d * 100, 6)), F.lit("2024"), F.lit("13"))
    rows = a.withColumn("said", said).withColumn("one", F.array(F.struct("value", "prev")))
    extra = Y.ungrounded("said", Y.allowed_numbers(F.lit(""), F.col("one")))
    return rows.select("issue_id", "seq", F.size(extra).alias("n_extra"))


@query("glossary_clean", r"""
WITH w AS (SELECT conv_id, turn, text, string_split_regex(text, '\s+') AS w FROM conversations),
g AS (SELECT conv_id, turn, text, coalesce(w[1], '') AS w1, coalesce(w[3], '') AS w3, lower(coalesce(w[1], '')) AS l1 FROM w)
SELECT conv_id, turn, CASE WHEN trim(w1) = '' THEN '' ELSE trim(w1) || CASE WHEN length(trim(text)) > 50 THEN '' ELSE trim(text) END END ||
   CASE WHEN trim(w3) <> '' AND lower(trim(w3)) <> trim(l1) THEN '|' || trim(w3) || '짧은 예' ELSE '' END AS kept FROM g""")
def glossary_clean(spark: SparkSession, sf: str) -> DataFrame:
    rows = _generated(spark, sf)
    kept = Y.clean_glossary(F.col("out.glossary"), F.col("text"))
    shown = F.transform(kept, lambda g: F.concat(g["term"], g["example"]))
    return rows.select("conv_id", "turn", F.array_join(shown, "|").alias("kept"))


@query("summary_upsert", f"""
WITH {SUMMARIES}
SELECT issue_id, CASE WHEN substr(issue_id, 2) IN (SELECT CAST(conv_id AS VARCHAR) FROM conversations) THEN 'model-b' ELSE model END AS model FROM summaries
UNION SELECT 'i' || conv_id, 'model-b' FROM conversations""")
def summary_upsert(spark: SparkSession, sf: str) -> DataFrame:
    fresh = table(spark, sf, "conversations").select(
        F.concat(F.lit("i"), F.col("conv_id").cast("string")).alias("issue_id"), F.lit("model-b").alias("model"),
        F.timestamp_seconds("turn").alias("created_at"))
    return Y.upsert_summaries(summaries(spark, sf), fresh).select("issue_id", "model")
