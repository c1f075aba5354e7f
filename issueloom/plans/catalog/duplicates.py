"""Queries on exact and near duplicates over whole texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ...functions.simhash import hamming, simhash64
from ...operators import dedup as D
from ...session import cut
from . import query, table

# The similarity hash in SQL: hash every distinct feature once, then let the features of a document vote per bit.
SIMHASH_SQL = r"""
words AS (SELECT doc_id, regexp_extract_all(lower(text), '[0-9a-z가-힣]+') AS w,
                 trim(regexp_replace(lower(text), '\s+', ' ', 'g')) AS whole FROM documents),
feats AS (
  SELECT doc_id, unnest(w) AS f FROM words
  UNION ALL
  SELECT doc_id, unnest(list_transform(range(1, length(c) - 1), lambda i: substr(c, i, 3))) AS f
  FROM (SELECT doc_id, array_to_string(w, '') AS c FROM words) WHERE length(c) >= 3
  UNION ALL
  SELECT doc_id, whole FROM words WHERE len(w) = 0),
counted AS (SELECT doc_id, f, count(*) AS n FROM feats GROUP BY doc_id, f),
codes AS (
  SELECT f, list_reduce(list_prepend(14695981039346656037::HUGEINT,
      list_transform(range(0, octet_length(encode(f))), lambda i:
        CAST(('0x' || substr(hex(encode(f)), 2 * i + 1, 2)) AS HUGEINT))),
      lambda h, b: (xor(h, b) * 1099511628211::HUGEINT) % 18446744073709551616::HUGEINT) AS h
  FROM (SELECT DISTINCT f FROM counted)),
votes AS (
  SELECT doc_id, bit, sum(CASE WHEN (h // (1::HUGEINT << bit)) % 2 = 1 THEN n ELSE -n END) AS v
  FROM counted JOIN codes USING (f), (SELECT unnest(range(0, 64)) AS bit) GROUP BY doc_id, bit),
hashes AS (
  SELECT doc_id, CAST(CASE WHEN u >= 9223372036854775808::HUGEINT THEN u - 18446744073709551616::HUGEINT ELSE u END AS BIGINT) AS simhash
  FROM (SELECT doc_id, sum(CASE WHEN v > 0 THEN (1::HUGEINT << bit) ELSE 0 END)::HUGEINT AS u FROM votes GROUP BY doc_id))
"""


def hashed(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    return cut(docs.select("doc_id", "source", "lang", simhash64("text").alias("simhash")))


@query("simhash64", f"WITH {SIMHASH_SQL} SELECT doc_id, simhash FROM hashes")
def simhash(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", simhash64("text").alias("simhash"))


@query("hamming_neighbours", f"""
WITH {SIMHASH_SQL}
SELECT a.doc_id, CAST(bit_count(xor(a.simhash, b.simhash)) AS INTEGER) AS distance FROM hashes a JOIN hashes b ON b.doc_id = a.doc_id + 1""")
def hamming_neighbours(spark: SparkSession, sf: str) -> DataFrame:
    """Distance between each document and the next."""
    h = hashed(spark, sf).select("doc_id", "simhash")
    after = h.select((F.col("doc_id") - 1).alias("doc_id"), F.col("simhash").alias("other"))
    return h.join(after, "doc_id").select("doc_id", hamming("simhash", "other").alias("distance"))


@query("near_dup_marked", f"""
WITH {SIMHASH_SQL}
SELECT doc_id, simhash, EXISTS (SELECT 1 FROM hashes b WHERE b.doc_id < a.doc_id
       AND bit_count(xor(a.simhash, b.simhash)) <= 3) AS is_dup FROM hashes a""")
def near_dup_marked(spark: SparkSession, sf: str) -> DataFrame:
    return D.mark_near_duplicates(hashed(spark, sf), "simhash", "doc_id").select("doc_id", "simhash", "is_dup")


TIMED = "TIMESTAMP '2024-01-01' + to_hours(CAST((doc_id * 37) % 240 AS INTEGER))"


@query("near_dup_windowed", f"""
WITH {SIMHASH_SQL},
t AS (SELECT h.*, CASE WHEN d.lang = 'es' THEN NULL ELSE {TIMED} END AS at FROM hashes h JOIN documents d USING (doc_id))
SELECT doc_id, EXISTS (SELECT 1 FROM t b WHERE b.doc_id < a.doc_id AND bit_count(xor(a.simhash, b.simhash)) <= 3
  AND (a.at IS NULL OR b.at IS NULL OR abs(epoch(a.at) - epoch(b.at)) <= 48 * 3600)) AS is_dup FROM t a""")
def near_dup_windowed(spark: SparkSession, sf: str) -> DataFrame:
    """Near duplicates within 48 hours; documents get a time from their number, Spanish ones have none."""
    at = F.lit("2024-01-01").cast("timestamp") + F.make_dt_interval(hours=((F.col("doc_id") * 37) % 240).cast("int"))
    rows = hashed(spark, sf).withColumn("at", F.when(F.col("lang") != "es", at))
    return D.mark_near_duplicates(rows, "simhash", "doc_id", "at").select("doc_id", "is_dup")


def _members(spark, sf):
    """Documents as articles: the issue of a document is its language, labelled toxic ones count as duplicates."""
    labels = table(spark, sf, "labels").select("doc_id", "toxic")
    return table(spark, sf, "documents").select("doc_id", "source", "lang").join(labels, "doc_id", "left").select(
        F.col("doc_id").alias("aid"), "source", F.col("lang").alias("issue_id"), (F.coalesce("toxic", F.lit(0)) == 1).alias("is_dup")
    )


MEMBERS_SQL = """
members AS (SELECT d.doc_id AS aid, source, lang AS issue_id, coalesce(toxic, 0) = 1 AS is_dup
            FROM documents d LEFT JOIN labels USING (doc_id))
"""


@query("distinct_sources", f"""
WITH {MEMBERS_SQL} SELECT issue_id, CAST(count(DISTINCT source) AS BIGINT) AS seen_sources FROM members
WHERE NOT is_dup GROUP BY issue_id""")
def distinct_sources(spark: SparkSession, sf: str) -> DataFrame:
    return D.distinct_sources(_members(spark, sf))


@query("member_counts", f"""
WITH {MEMBERS_SQL} SELECT issue_id, CAST(count(*) FILTER (NOT is_dup) AS BIGINT) AS members, CAST(count(*) AS BIGINT) AS rows
FROM members GROUP BY issue_id""")
def member_counts(spark: SparkSession, sf: str) -> DataFrame:
    return D.member_counts(_members(spark, sf))


@query("ranked_groups", f"""
WITH {SIMHASH_SQL},
m AS (SELECT h.*, d.source, d.lang, EXISTS (SELECT 1 FROM hashes b WHERE b.doc_id < h.doc_id
        AND bit_count(xor(h.simhash, b.simhash)) <= 3) AS is_dup FROM hashes h JOIN documents d USING (doc_id)),
g AS (SELECT lang, CAST(count(DISTINCT source) FILTER (NOT is_dup) AS BIGINT) AS sources,
             CAST(count(*) FILTER (NOT is_dup) AS BIGINT) AS members, CAST(count(*) AS BIGINT) AS rows FROM m GROUP BY lang)
SELECT lang, sources, members, rows, CAST(row_number() OVER (ORDER BY members DESC, lang) AS INTEGER) AS rank FROM g""")
def ranked_groups(spark: SparkSession, sf: str) -> DataFrame:
    """The first slice end to end: hash whole texts, mark near duplicates, count sources per group, rank."""
    from pyspark.sql import Window as W

    marked = D.mark_near_duplicates(hashed(spark, sf), "simhash", "doc_id").withColumn("issue_id", F.col("lang"))
    counts = D.distinct_sources(marked).join(D.member_counts(marked), "issue_id")
    # one row per group is left, so the ranking window is as small as the report
    order = W.partitionBy(F.lit(0)).orderBy(F.col("members").desc(), "issue_id")
    return counts.select(
        F.col("issue_id").alias("lang"), F.col("seen_sources").alias("sources"), "members", "rows",
        F.row_number().over(order).alias("rank"),
    )


@query("sentence_dedup")
def sentence_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Near-equal lines removed from every turn: its lines, followed by the same lines in lower case."""
    c = table(spark, sf, "conversations")
    lines = F.filter(F.split("text", "\n"), lambda s: F.trim(s) != "")
    rows = c.select("conv_id", "turn", F.concat(lines, F.transform(lines, lambda s: F.lower(s))).alias("given"))
    kept = rows.withColumn("kept", D.distinct_sentences("given"))
    return kept.select("conv_id", "turn", F.size("given").alias("given"), F.array_join("kept", "|").alias("kept"))


@query("latest_per_key", """
SELECT user_id, event_type, event_id, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS top FROM events)
WHERE top = 1""")
def latest_per_key(spark: SparkSession, sf: str) -> DataFrame:
    from ...operators.ordered import latest_per_key as latest

    e = table(spark, sf, "events")
    order = [F.col("ts").desc(), F.col("event_id").desc()]
    return latest(e, ["user_id", "event_type"], order).select("user_id", "event_type", "event_id", "value")
