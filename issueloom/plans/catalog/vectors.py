"""Queries on vectors: assignment, seeding, merging, classification, evaluation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ...functions.vectors import dot
from ...operators import classify as K, cluster as C, diagnostics, embed, evaluation as E, similarity as S
from ...session import cut
from ...settings import Settings
from . import query, table

# The vectors of the test tables carry little signal, so the thresholds are lower than in production.
LOW = Settings(tau_join=0.35, tau_hold=0.28, merge_sim=0.40, proto_min=0.12, dim=64)

SIDES_SQL = """
e AS (SELECT vec_id, embedding AS vec, CASE WHEN label = 0 THEN '' ELSE CAST(label AS VARCHAR) END AS k, label,
             l.doc_id IS NOT NULL AND l.quality = 1 AS is_issue, coalesce(l.toxic, 0) = 1 AS official
      FROM embeddings LEFT JOIN labels l ON l.doc_id = vec_id),
issues AS (SELECT * FROM e WHERE is_issue),
articles AS (SELECT *, CASE WHEN label >= 5 THEN 1 ELSE 0 END AS hold_count FROM e WHERE NOT is_issue),
sims AS (SELECT a.vec_id AS aid, i.vec_id AS iid, round(list_dot_product(a.vec::DOUBLE[], i.vec::DOUBLE[]), 9) AS sim,
                CASE WHEN a.k <> '' THEN a.k = i.k ELSE i.k = '' AND NOT i.official END AS gate
         FROM articles a, issues i)
"""


def sides(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Vectors with a good label are issues, all others are articles; the label is the entity key, 0 means none."""
    l = table(spark, sf, "labels").select(F.col("doc_id").alias("vec_id"), "quality", "toxic")
    e = table(spark, sf, "embeddings").join(l, "vec_id", "left").select(
        "vec_id", F.col("embedding").alias("vec"), "label",
        F.when(F.col("label") == 0, F.array().cast("array<string>")).otherwise(F.array(F.col("label").cast("string"))).alias("keys"),
        F.coalesce(F.col("quality") == 1, F.lit(False)).alias("is_issue"), (F.coalesce("toxic", F.lit(0)) == 1).alias("official"),
    )
    issues = e.filter("is_issue").select(F.col("vec_id").alias("iid"), "vec", "keys", "official", "label")
    articles = e.filter("NOT is_issue").select(
        F.col("vec_id").alias("aid"), "vec", "keys", F.when(F.col("label") >= 5, 1).otherwise(0).alias("hold_count"),
        F.col("official").alias("is_dup"), "label",
    )
    return articles, issues


@query("assign_bands", f"""
WITH {SIDES_SQL},
gated AS (SELECT aid, iid, sim FROM (SELECT *, row_number() OVER (PARTITION BY aid ORDER BY sim DESC, iid) AS rn
          FROM sims WHERE gate AND sim >= 0.28) WHERE rn = 1)
SELECT a.vec_id AS aid, iid AS best_issue, round(sim, 6) AS best_sim,
  CASE WHEN sim >= 0.35 THEN 'joined' WHEN sim IS NOT NULL AND hold_count + 1 >= 2 THEN 'pooled' WHEN sim IS NOT NULL THEN 'held' ELSE 'pooled' END AS decision,
  CAST(CASE WHEN sim >= 0.35 THEN 0 WHEN sim IS NOT NULL AND hold_count + 1 >= 2 THEN 2 WHEN sim IS NOT NULL THEN hold_count + 1
       ELSE hold_count END AS INTEGER) AS hold_count
FROM articles a LEFT JOIN gated ON aid = a.vec_id""")
def assign_bands(spark: SparkSession, sf: str) -> DataFrame:
    articles, issues = sides(spark, sf)
    return C.assign(articles, issues, LOW, diagnose=False).select(
        "aid", "best_issue", F.round("best_sim", 6).alias("best_sim"), "decision", "hold_count"
    )


@query("assign_best_ungated", f"""
WITH {SIDES_SQL}
SELECT aid, last_sim_issue, round(sim, 4) AS last_sim FROM (
  SELECT aid, iid AS last_sim_issue, sim, row_number() OVER (PARTITION BY aid ORDER BY sim DESC, iid) AS rn FROM sims) WHERE rn = 1""")
def assign_best_ungated(spark: SparkSession, sf: str) -> DataFrame:
    articles, issues = sides(spark, sf)
    return C.assign(articles, issues, LOW).select("aid", "last_sim_issue", "last_sim")


@query("entity_gate", f"""
WITH {SIDES_SQL} SELECT aid, iid AS nearest, gate AS passes FROM (
  SELECT *, row_number() OVER (PARTITION BY aid ORDER BY sim DESC, iid) AS rn FROM sims) WHERE rn = 1""")
def entity_gate(spark: SparkSession, sf: str) -> DataFrame:
    """Whether the nearest issue of an article would pass its entity gate."""
    articles, issues = sides(spark, sf)
    near = C.assign(articles, issues, LOW).select("aid", F.col("last_sim_issue").alias("iid"))
    rows = near.join(articles.select("aid", F.col("keys").alias("a_keys")), "aid").join(
        issues.select("iid", F.col("keys").alias("i_keys"), "official"), "iid")
    gate = C.entity_gate(F.col("a_keys"), F.col("i_keys"), F.col("official"))
    return rows.select("aid", F.col("iid").alias("nearest"), gate.alias("passes"))


def _pool(spark, sf):
    e = table(spark, sf, "embeddings")
    keys = F.when(F.col("label") == 0, F.array().cast("array<string>")).otherwise(F.array(F.col("label").cast("string")))
    return e.select(F.col("vec_id").alias("aid"), F.col("embedding").alias("vec"), keys.alias("keys"))


@query("seed_neighbours", """
SELECT a.vec_id AS aid, CAST(count(*) AS BIGINT) AS n FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id
WHERE round(list_dot_product(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 9) >= 0.3 GROUP BY a.vec_id""")
def seed_neighbours(spark: SparkSession, sf: str) -> DataFrame:
    """How many neighbours each article would scan while seeding."""
    pool = _pool(spark, sf).withColumn("grp", F.array(F.lit(S.ANY_GROUP)))
    p = pool.select(F.col("aid").alias("pid"), "vec", "grp")
    t = pool.select(F.col("aid").alias("tid"), "vec", "grp", F.col("aid").alias("tord"))
    return S.match_counts(p, t, 0.3).select(F.col("pid").alias("aid"), "n")


@query("seed_partner", """
WITH s AS (SELECT a.vec_id AS a, b.vec_id AS b, round(list_dot_product(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 9) AS sim
           FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id AND a.label = b.label)
SELECT a, b, round(sim, 6) AS sim FROM (SELECT *, row_number() OVER (PARTITION BY a ORDER BY sim DESC, b) AS rn FROM s WHERE sim >= 0.25)
WHERE rn = 1""")
def seed_partner(spark: SparkSession, sf: str) -> DataFrame:
    """The only article each one may be paired with: its nearest with a shared key."""
    pool = _pool(spark, sf).withColumn("grp", S.gate_groups("keys"))
    p = pool.select(F.col("aid").alias("pid"), "vec", "grp")
    t = pool.select(F.col("aid").alias("tid"), "vec", "grp", F.col("aid").alias("tord"))
    return S.best_match(p, t, 0.25, exclude_self=True).select(
        F.col("pid").alias("a"), F.col("tid").alias("b"), F.round("sim", 6).alias("sim")
    )


# The sequential pass in SQL: one recursion step per turn, with the list of used articles as its state.
SEED_SQL = """
s AS (SELECT a.vec_id AS a, b.vec_id AS b, a.label = b.label AS gate, round(list_dot_product(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 9) AS sim
      FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id),
near AS (SELECT * FROM s WHERE sim >= 0.25),
partner AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY a ORDER BY sim DESC, b) AS rn FROM near WHERE gate) WHERE rn = 1),
closer AS (SELECT n.a, list(n.b) AS bs FROM near n JOIN partner p USING (a) WHERE n.sim > p.sim OR (n.sim = p.sim AND n.b < p.b) GROUP BY n.a),
turns AS (SELECT row_number() OVER (ORDER BY p.a) AS n, p.a, p.b, p.sim, list_concat([p.a, p.b], coalesce(bs, [])) AS looks FROM partner p LEFT JOIN closer USING (a)),
walk(n, used, ok) AS (
  SELECT 0::BIGINT, []::BIGINT[], false
  UNION ALL
  SELECT t.n, CASE WHEN list_has_any(w.used, t.looks) THEN w.used ELSE list_concat(w.used, [t.a, t.b]) END, NOT list_has_any(w.used, t.looks)
  FROM walk w JOIN turns t ON t.n = w.n + 1),
seeded AS (SELECT t.a, t.b, t.sim FROM walk w JOIN turns t USING (n) WHERE w.ok)
"""


@query("seed_pairs", f"WITH RECURSIVE {SEED_SQL} SELECT a, b, round(sim, 6) AS sim FROM seeded")
def seed_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return C.seed_pairs(_pool(spark, sf), Settings(tau_join=0.25)).select("a", "b", F.round("sim", 6).alias("sim"))


@query("seed_issues", f"""
WITH RECURSIVE {SEED_SQL}, t AS (SELECT doc_id, split_part(text, chr(10), 1) AS title FROM documents)
SELECT 'c' || substr(sha1(sha1(CAST(a AS VARCHAR)) || '|' || sha1(CAST(b AS VARCHAR))), 1, 16) AS id,
  CASE WHEN a < b THEN x.title ELSE y.title END AS canonical_title,
  CASE WHEN e.label = 0 THEN '' ELSE CAST(e.label AS VARCHAR) END AS keys, round(sim, 6) AS sim
FROM seeded LEFT JOIN t x ON x.doc_id = a LEFT JOIN t y ON y.doc_id = b JOIN embeddings e ON e.vec_id = a""")
def seed_issues(spark: SparkSession, sf: str) -> DataFrame:
    """New candidate issues from the pairs: id, title of the earlier document, union of keys."""
    docs = table(spark, sf, "documents").select(F.col("doc_id").alias("aid"), F.split_part("text", F.lit("\n"), F.lit(1)).alias("title"))
    at = F.lit("2024-01-01").cast("timestamp") + F.make_dt_interval(hours=F.col("aid").cast("int"))
    pool = _pool(spark, sf).join(docs, "aid", "left").withColumn("published_at", at).withColumn("article_key", F.sha1(F.col("aid").cast("string").cast("binary")))
    pairs = cut(C.seed_pairs(pool, Settings(tau_join=0.25)))
    made = C.issues_from_pairs(pairs, pool)
    return made.select("id", "canonical_title", F.array_join("keys", "|").alias("keys"), F.round("sim", 6).alias("sim"))


@query("merge_candidates", """
WITH m AS (SELECT vec_id, label, embedding::DOUBLE[] AS v, least(30, 1 + n_chars // 400) AS members FROM embeddings JOIN documents ON doc_id = vec_id),
c AS (SELECT a.vec_id AS iid, b.vec_id AS other FROM m a JOIN m b ON a.vec_id <> b.vec_id AND a.label = b.label AND a.label <> 0
      AND a.members + b.members <= 40 WHERE round(list_dot_product(a.v, b.v), 9) >= 0.25)
SELECT iid, min(other) AS first_partner FROM c GROUP BY iid""")
def merge_candidates(spark: SparkSession, sf: str) -> DataFrame:
    """The first issue each one could merge with: similar, sharing an entity, small enough together."""
    issues = _merge_input(spark, sf)
    room = (F.lit(40) - F.col("members")).alias("room")
    near = S.first_match(
        issues.select(F.col("iid").alias("pid"), "vec", F.col("keys").alias("grp"), room),
        issues.select(F.col("iid").alias("tid"), "vec", F.col("keys").alias("grp"), F.col("iid").alias("tord"), F.col("members").alias("weight")),
        0.25)
    return near.select(F.col("pid").alias("iid"), F.col("tid").alias("first_partner"))


def _merge_input(spark, sf):
    articles, issues = sides(spark, sf)
    docs = table(spark, sf, "documents").select(F.col("doc_id").alias("iid"), "n_chars")
    rows = articles.select(F.col("aid").alias("iid"), "vec", "keys", F.col("is_dup").alias("official")).unionByName(
        issues.select("iid", "vec", "keys", "official")
    )
    return rows.join(docs, "iid").select(
        "iid", "vec", "keys", "official", F.lit("active").alias("status"),
        F.timestamp_seconds(F.col("n_chars")).alias("created_at"), F.least(F.lit(30), 1 + F.floor(F.col("n_chars") / 400)).cast("long").alias("members"),
    )


# The scan over all pairs in SQL: one step per candidate pair, with the gone issues and the live sizes as its state.
MERGE_SQL = """
m AS (SELECT vec_id AS id, embedding::DOUBLE[] AS v, label, least(30, 1 + n_chars // 400)::BIGINT AS members, n_chars AS age,
        coalesce(l.toxic, 0) = 1 AS official
      FROM embeddings JOIN documents d ON d.doc_id = vec_id LEFT JOIN labels l ON l.doc_id = vec_id),
c AS (SELECT row_number() OVER (ORDER BY a.id, b.id) AS n, a.id AS i, b.id AS j,
        CASE WHEN a.official <> b.official THEN a.official ELSE a.age <= b.age END AS first_wins
      FROM m a JOIN m b ON a.id < b.id AND a.label = b.label AND a.label <> 0 WHERE round(list_dot_product(a.v, b.v), 9) >= 0.25),
scan(n, gone, size, ok) AS (
  SELECT 0::BIGINT, []::BIGINT[], (SELECT map_from_entries(list({'k': id, 'v': members})) FROM m), false
  UNION ALL
  SELECT n, CASE WHEN ok THEN list_append(gone, loser) ELSE gone END, CASE WHEN ok THEN map_concat(size, MAP {winner: total}) ELSE size END, ok FROM (
    SELECT c.n, s.gone, s.size, s.size[c.i] + s.size[c.j] AS total, CASE WHEN first_wins THEN c.i ELSE c.j END AS winner,
      CASE WHEN first_wins THEN c.j ELSE c.i END AS loser,
      NOT list_contains(s.gone, c.i) AND NOT list_contains(s.gone, c.j) AND s.size[c.i] + s.size[c.j] <= 40 AS ok
    FROM scan s JOIN c ON c.n = s.n + 1)),
steps AS (SELECT CASE WHEN first_wins THEN c.j ELSE c.i END AS loser, CASE WHEN first_wins THEN c.i ELSE c.j END AS winner FROM scan JOIN c USING (n) WHERE ok),
chain(loser, winner) AS (SELECT loser, winner FROM steps UNION ALL SELECT a.loser, b.winner FROM chain a JOIN steps b ON b.loser = a.winner),
final AS (SELECT loser, winner FROM chain WHERE winner NOT IN (SELECT loser FROM steps))
"""


@query("merge_groups", f"WITH RECURSIVE {MERGE_SQL} SELECT loser, winner FROM final")
def merge_groups(spark: SparkSession, sf: str) -> DataFrame:
    """Merged issues with the issue they end up in."""
    steps = C.merge_steps(_merge_input(spark, sf), Settings(merge_sim=0.25))
    return C.final_winner(steps)


@query("merge_repoint", f"""
WITH RECURSIVE {MERGE_SQL} SELECT coalesce(winner, user_id) AS issue_id, CAST(count(*) AS BIGINT) AS children
FROM events LEFT JOIN final ON loser = user_id GROUP BY ALL""")
def merge_repoint(spark: SparkSession, sf: str) -> DataFrame:
    """Children of merged issues counted at their new issue."""
    mapping = C.final_winner(C.merge_steps(_merge_input(spark, sf), Settings(merge_sim=0.25)))
    children = table(spark, sf, "events").select((F.col("user_id")).alias("issue_id"), "event_id")
    return C.repoint(children, mapping).groupBy("issue_id").agg(F.count(F.lit(1)).alias("children"))


def half_sql(x: str) -> str:
    """A number rounded to half precision: eleven significant bits, steps of 2^-24 below 2^-14, ties to even."""
    step = f"pow(2, greatest(floor(log2(abs({x}))), -14) - 10)"
    return f"CASE WHEN {x} = 0 THEN 0 ELSE round_even({x} / {step}, 0) * {step} END"


FOLD_SQL = f"""
WITH RECURSIVE m AS (
  SELECT label, vec_id, list_transform(embedding::DOUBLE[], lambda x: {half_sql('x')}) AS v, coalesce(toxic, 0) = 1 AS is_dup,
         row_number() OVER (PARTITION BY label ORDER BY vec_id) AS rn FROM embeddings LEFT JOIN labels ON doc_id = vec_id),
j AS (SELECT *, coalesce(sum(CASE WHEN is_dup THEN 0 ELSE 1 END) OVER
        (PARTITION BY label ORDER BY rn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS filled FROM m WHERE rn > 1),
moving AS (SELECT label, v, row_number() OVER (PARTITION BY label ORDER BY rn) AS n FROM j WHERE 1 + filled < 20),
f(label, n, c) AS (
  SELECT label, 0::BIGINT, v FROM m WHERE rn = 1
  UNION ALL
  SELECT f.label, f.n + 1, list_transform(list_transform(u, lambda x: x / sqrt(list_dot_product(u, u))), lambda x: {half_sql('x')})
  FROM f JOIN (SELECT label, n, v FROM moving) k ON k.label = f.label AND k.n = f.n + 1,
  LATERAL (SELECT list_transform(list_zip(f.c, k.v), lambda p: 0.9 * p[1] + 0.1 * p[2]) AS u) t),
last AS (SELECT label, max(n) AS n FROM f GROUP BY label)
SELECT CAST(label AS BIGINT) AS iid, round(list_sum(list_transform(c, lambda x, i: x * i)), 4) AS checksum, round(c[1], 4) AS c1
FROM f JOIN last USING (label, n)
"""


@query("centroid_fold", FOLD_SQL)
def centroid_fold(spark: SparkSession, sf: str) -> DataFrame:
    """Per label the centroid after adding its vectors in order to the first one."""
    toxic = table(spark, sf, "labels").select(F.col("doc_id").alias("vec_id"), "toxic")
    rows = table(spark, sf, "embeddings").join(toxic, "vec_id", "left").select(
        F.col("label").cast("long").alias("iid"), F.col("vec_id").alias("aid"), F.col("embedding").alias("vec"),
        (F.coalesce("toxic", F.lit(0)) == 1).alias("is_dup"),
    )
    first = rows.groupBy("iid").agg(F.min_by("vec", "aid").alias("vec"), F.min("aid").alias("_first"))
    issues = first.select("iid", "vec", F.lit(1).cast("long").alias("members"))
    joined = rows.join(first.select("iid", "_first"), "iid").filter(F.col("aid") > F.col("_first")).drop("_first")
    moved = C.moving_centroids(issues, joined, Settings())
    total = F.aggregate(
        F.transform("vec", lambda x, i: x.cast("double") * (i + 1)), F.lit(0.0), lambda s, x: s + x
    )
    return moved.select("iid", F.round(total, 4).alias("checksum"), F.round(F.col("vec")[0].cast("double"), 4).alias("c1"))


@query("merged_keys", """
SELECT user_id AS iid, array_to_string(list_sort(list(DISTINCT event_type)), '|') AS keys FROM events GROUP BY ALL""")
def merged_keys(spark: SparkSession, sf: str) -> DataFrame:
    """Union of an issue's own keys and those of new members."""
    e = table(spark, sf, "events").select(F.col("user_id").alias("iid"), F.array("event_type").alias("keys"), "event_type")
    issues = e.filter("event_type = 'signup'").groupBy("iid").agg(F.any_value("keys").alias("keys"))
    return C.merged_keys(issues, e).select("iid", F.array_join("keys", "|").alias("keys"))


@query("promote", """
WITH s AS (SELECT user_id AS iid, count(DISTINCT event_type) AS n FROM events WHERE NOT value < 100 GROUP BY user_id)
SELECT c_custkey AS iid, CASE WHEN c_acctbal >= 5000 THEN 'active' WHEN coalesce(n, 0) >= 2 THEN 'active' ELSE 'candidate' END AS status,
       c_acctbal >= 5000 OR coalesce(n, 0) >= 2 AS frozen, CAST(coalesce(n, 0) AS BIGINT) AS seen_sources
FROM customer LEFT JOIN s ON iid = c_custkey""")
def promote(spark: SparkSession, sf: str) -> DataFrame:
    """Events as articles, small ones as near duplicates; users with two kinds of others are promoted."""
    from ...operators.dedup import distinct_sources

    articles = table(spark, sf, "events").select(
        F.col("user_id").alias("issue_id"), F.col("event_type").alias("source"), F.coalesce(F.col("value") < 100, F.lit(True)).alias("is_dup")
    )
    sources = distinct_sources(articles).withColumnRenamed("issue_id", "iid")
    rich = F.col("c_acctbal") >= 5000
    issues = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("iid"), F.when(rich, "active").otherwise("candidate").alias("status"), rich.alias("frozen")
    )
    return C.promote(issues, sources, Settings())


@query("representative_topk", f"""
WITH {SIDES_SQL},
c AS (SELECT label, vec FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY vec_id) AS rn FROM issues) WHERE rn = 1),
s AS (SELECT a.label, a.vec_id AS aid, round(list_dot_product(a.vec::DOUBLE[], c.vec::DOUBLE[]), 6) AS sim FROM articles a JOIN c USING (label))
SELECT CAST(label AS BIGINT) AS iid, aid, sim, CAST(rn AS INTEGER) AS rank FROM
 (SELECT *, row_number() OVER (PARTITION BY label ORDER BY sim DESC, aid) AS rn FROM s) WHERE rn <= 5""")
def representative_topk(spark: SparkSession, sf: str) -> DataFrame:
    articles, issues = sides(spark, sf)
    centroid = issues.groupBy("label").agg(F.min_by("vec", "iid").alias("c"))
    rows = articles.join(centroid, "label").select(
        F.col("label").cast("long").alias("iid"), "aid", F.round(dot("vec", "c"), 6).alias("sim"),
        F.timestamp_seconds("aid").alias("published_at"), F.lit(True).alias("has_centroid"),
    )
    return C.representative_rows(rows, 5).select("iid", "aid", "sim", "rank")


@query("member_similarity", f"""
WITH {SIDES_SQL},
c AS (SELECT label, vec FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY vec_id) AS rn FROM issues) WHERE rn = 1),
r AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY vec_id DESC) AS rn FROM articles)
SELECT r.label AS issue_id, r.vec_id AS aid, round(list_dot_product(r.vec::DOUBLE[], c.vec::DOUBLE[]), 4) AS sim_to_centroid
FROM r LEFT JOIN c USING (label) WHERE rn <= 20""")
def member_similarity(spark: SparkSession, sf: str) -> DataFrame:
    articles, issues = sides(spark, sf)
    first = issues.groupBy("label").agg(F.min_by("vec", "iid").alias("vec")).select(F.col("label").alias("iid"), "vec")
    rows = articles.select(F.col("label").alias("issue_id"), "aid", "vec", F.timestamp_seconds("aid").alias("published_at"))
    return diagnostics.issue_members(rows, first, 20).select("issue_id", "aid", "sim_to_centroid")


@query("text_vectors")
def text_vectors(spark: SparkSession, sf: str) -> DataFrame:
    """Vectors of whole documents; reported by length and non-zero columns."""
    docs = table(spark, sf, "documents").select(
        F.col("doc_id").alias("id"), F.split_part("text", F.lit("\n"), F.lit(1)).alias("title"),
        F.expr("substring(text, length(split_part(text, '\n', 1)) + 2)").alias("lead"),
    )
    rows = embed.text_vectors(docs, LOW)
    return rows.select(
        "id", F.round(F.sqrt(dot("vec", "vec")), 4).alias("length"), F.size(F.filter("vec", lambda x: x != 0)).alias("used")
    )


WORDS = [("RATE", ["thereat", "ndorea"]), ("EARNINGS", ["schein", "heitpf"]), ("MACRO", ["eauvi", "quequ"]),
         ("MARKET", ["token", "ción"]), ("ETC", ["the"])]

KEYWORD_SQL = """
kw(cat, ord, word) AS (VALUES ('RATE', 0, 'thereat'), ('RATE', 0, 'ndorea'), ('EARNINGS', 1, 'schein'), ('EARNINGS', 1, 'heitpf'),
  ('MACRO', 2, 'eauvi'), ('MACRO', 2, 'quequ'), ('MARKET', 3, 'token'), ('MARKET', 3, 'ción'))
"""


@query("keyword_category", f"""
WITH {KEYWORD_SQL},
t AS (SELECT conv_id AS iid, turn, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS rn FROM conversations),
h AS (SELECT iid, rn = 1 AS is_title, cat, ord, count(*) AS n FROM t, kw
      WHERE (rn = 1 OR rn <= 11) AND contains(lower(text), word) GROUP BY ALL),
best AS (SELECT *, row_number() OVER (PARTITION BY iid, is_title ORDER BY n DESC, ord) AS r FROM h)
SELECT i.iid, coalesce(a.cat, b.cat) AS keyword_category FROM (SELECT DISTINCT conv_id AS iid FROM conversations) i
LEFT JOIN best a ON a.iid = i.iid AND a.is_title AND a.r = 1 LEFT JOIN best b ON b.iid = i.iid AND NOT b.is_title AND b.r = 1""")
def keyword_category(spark: SparkSession, sf: str) -> DataFrame:
    """A conversation as an issue: its first turn is the title, the turns after it are the members."""
    c = table(spark, sf, "conversations")
    first = c.groupBy(F.col("conv_id").alias("iid")).agg(F.min("turn").alias("t0"), F.min_by("text", "turn").alias("canonical_title"))
    members = c.select(F.col("conv_id").alias("iid"), F.col("turn").alias("aid"), F.col("text").alias("title")).join(
        first.select("iid", "t0"), "iid").filter(F.col("aid") > F.col("t0"))
    return K.keyword_category(first, members, WORDS)


PROTO_SQL = f"""
{SIDES_SQL},
dims AS (SELECT label, i, avg(vec[i]::DOUBLE) AS x FROM issues, (SELECT unnest(range(1, 65)) AS i) GROUP BY label, i),
means AS (SELECT label, list(x ORDER BY i) AS m FROM dims GROUP BY label),
protos AS (SELECT label, list_transform(m, lambda x: CAST(x / sqrt(list_dot_product(m, m)) AS FLOAT)) AS p FROM means),
psims AS (SELECT a.vec_id AS iid, p.label, round(list_dot_product(a.vec::DOUBLE[], p.p::DOUBLE[]), 9) AS sim FROM articles a, protos p),
pbest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY iid ORDER BY sim DESC, label) AS rn FROM psims) WHERE rn = 1)
"""


def _prototypes(spark, sf):
    articles, issues = sides(spark, sf)
    sentences = issues.select(
        F.col("label").cast("long").alias("tord"), F.concat(F.lit("C"), F.col("label").cast("string")).alias("category"), "vec"
    )
    rows = articles.select(F.col("aid").alias("iid"), "vec")
    return K.prototype_category(rows, K.prototypes(sentences, 64), LOW.proto_min), rows


@query("prototype_category", f"""
WITH {PROTO_SQL}
SELECT iid, CASE WHEN sim >= 0.12 THEN 'C' || label ELSE 'ETC' END AS prototype_category, round(sim, 5) AS sim FROM pbest""")
def prototype_category(spark: SparkSession, sf: str) -> DataFrame:
    found, _ = _prototypes(spark, sf)
    return found.withColumn("sim", F.round("sim", 5))


@query("category_fallback", f"""
WITH {PROTO_SQL}, {KEYWORD_SQL},
h AS (SELECT doc_id AS iid, cat, ord, count(*) AS n FROM documents, kw WHERE contains(lower(text), word) GROUP BY ALL),
best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY iid ORDER BY n DESC, ord) AS r FROM h) WHERE r = 1),
mh AS (SELECT conv_id AS iid, cat, ord, count(*) AS n FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS k FROM conversations), kw
  WHERE k <= 10 AND contains(lower(text), word) GROUP BY ALL),
mbest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY iid ORDER BY n DESC, ord) AS r FROM mh) WHERE r = 1)
SELECT p.iid, CASE WHEN d.lang = 'fr' THEN 'GEO'
  ELSE coalesce(b.cat, m.cat, CASE WHEN sim >= 0.12 THEN 'C' || label ELSE 'ETC' END) END AS category
FROM pbest p JOIN documents d ON d.doc_id = p.iid LEFT JOIN best b ON b.iid = p.iid LEFT JOIN mbest m ON m.iid = p.iid""")
def category_fallback(spark: SparkSession, sf: str) -> DataFrame:
    """Rule, keywords of the title, of the members, prototype, ETC: French documents are official events with a category of their
    own; turns of the conversation of the same number are a document's members."""
    proto, rows = _prototypes(spark, sf)
    docs = table(spark, sf, "documents").select(F.col("doc_id").alias("iid"), F.col("text").alias("canonical_title"), "lang")
    official = F.col("lang") == "fr"
    issues = rows.select("iid").join(docs, "iid").select(
        "iid", "canonical_title", F.when(official, "GEO").otherwise("ETC").alias("category"),
        F.when(official, "official_event").otherwise("cluster").alias("origin"), F.lit("active").alias("status"),
    )
    members = table(spark, sf, "conversations").select(F.col("conv_id").alias("iid"), F.col("turn").alias("aid"), F.col("text").alias("title"))
    keyword = K.keyword_category(issues, members, WORDS)
    return K.classify(issues, keyword, proto).select("iid", "category")


PAIR_SQL = """
pairs AS (SELECT a.vec_id AS a, list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) AS sim, a.label = b.label AS same
          FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1)
"""
SWEEP_SQL = f"""
{PAIR_SQL},
taus AS (SELECT unnest(range(0, 11)) * 0.02 AS tau),
c AS (SELECT tau, count(*) FILTER (sim >= tau AND same) AS tp, count(*) FILTER (sim >= tau AND NOT same) AS fp,
             count(*) FILTER (sim < tau AND same) AS fn FROM taus, pairs GROUP BY tau),
p AS (SELECT *, CASE WHEN tp + fp = 0 THEN 0 ELSE tp / (tp + fp) END AS p, CASE WHEN tp + fn = 0 THEN 0 ELSE tp / (tp + fn) END AS r FROM c),
sweep AS (SELECT round(CAST(tau AS DOUBLE), 3) AS tau, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp, CAST(fn AS BIGINT) AS fn,
  round(CAST(p AS DOUBLE), 3) AS precision, round(CAST(r AS DOUBLE), 3) AS recall,
  round(CAST(CASE WHEN p + r = 0 THEN 0 ELSE 2 * p * r / (p + r) END AS DOUBLE), 3) AS f1 FROM p)
"""


def _pairs(spark, sf):
    e = table(spark, sf, "embeddings")
    a = e.select(F.col("vec_id").alias("a"), F.col("embedding").alias("vec_a"), F.col("label").alias("la"))
    b = e.select((F.col("vec_id") - 1).alias("a"), F.col("embedding").alias("vec_b"), F.col("label").alias("lb"))
    return E.pair_similarities(a.join(b, "a")).select("a", "sim", (F.col("la") == F.col("lb")).alias("same"))


@query("pair_similarity", f"WITH {PAIR_SQL} SELECT a, round(sim, 6) AS sim, same FROM pairs")
def pair_similarity(spark: SparkSession, sf: str) -> DataFrame:
    return _pairs(spark, sf).withColumn("sim", F.round("sim", 6))


@query("tau_sweep", f"WITH {SWEEP_SQL} SELECT * FROM sweep")
def tau_sweep(spark: SparkSession, sf: str) -> DataFrame:
    return E.sweep(_pairs(spark, sf), 0.0, 0.2, 0.02)


@query("tau_best", f"WITH {SWEEP_SQL} SELECT * FROM sweep ORDER BY f1 DESC, tau DESC LIMIT 1")
def tau_best(spark: SparkSession, sf: str) -> DataFrame:
    return E.best_tau(E.sweep(_pairs(spark, sf), 0.0, 0.2, 0.02))


@query("evaluate_texts")
def evaluate_texts(spark: SparkSession, sf: str) -> DataFrame:
    """The sweep over text pairs: each document and the next, the same when their language is."""
    d = table(spark, sf, "documents").select("doc_id", "text", "lang")
    after = d.select((F.col("doc_id") - 1).alias("doc_id"), F.col("text").alias("b"), F.col("lang").alias("other"))
    pairs = d.join(after, "doc_id").select(F.col("doc_id").alias("pair"), F.col("text").alias("a"), "b", (F.col("lang") == F.col("other")).alias("same"))
    return E.evaluate(pairs, LOW, None, 0.5, 0.9, 0.1)
