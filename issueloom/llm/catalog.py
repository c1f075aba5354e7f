"""Queries of the operators over their whole tables; SQL where SQL can say the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import decontam, hardneg, langid, mixing, mtree, pieces, pii, shards, simhash, tokenfile, toxicity, warc, whitening
from .common import text_crc32, whole

QUERIES = {}
SQL = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


@query("op1_language")
def op1_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held = F.coalesce(text_crc32("doc_id") % 3 == 1, F.lit(False))
    model = langid.fit(docs.where(~held))
    said = langid.predict(docs.select("doc_id", "text", held.alias("held_out")), model)
    return said.select("doc_id", "held_out", "lang_pred", "score", "lang_rejected")


@query("op2_shards")
def op2_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", (F.octet_length(whole("text")) + 1).cast("long").alias("size"),
        F.crc32(whole("text").cast("binary")).alias("text_crc32"))
    return shards.assign(docs, ["doc_id", "size", "text_crc32"], 16).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


@query("op3_simhash")
def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.classes(table(spark, sf_dir, "documents"), words=3)
    return found.select(F.col("key").alias("doc_id"), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
                        F.col("component").alias("component_id"))


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@query("op4_tokens")
def op4_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = tokenfile.round_trip(table(spark, sf_dir, "documents"), tokenizer_path())
    return found.select(F.col("key").alias("doc_id"), "start", F.col("n").alias("n_tokens"), "ids_crc32")


MIXING_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         length(coalesce(text, '')) AS chars,
         (CAST('0x' || substr(md5('7|' || coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 13) AS BIGINT) + 0.5::DOUBLE) / 4503599627370496::DOUBLE AS u
  FROM documents),
keyed AS (
  SELECT *, -ln(u) / greatest(0.1::DOUBLE, 1 - abs(chars::DOUBLE / greatest(size, 1) - 6) / 6) AS k FROM sized),
sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         [5.0::DOUBLE, 2.0, 1.0][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS w
  FROM keyed GROUP BY source),
levels AS (
  SELECT *, 2.0::DOUBLE * source_size / w AS ratio,
         (1.5::DOUBLE * sum(source_size) OVER () - 2.0::DOUBLE * coalesce(sum(source_size) OVER (
            ORDER BY 2.0::DOUBLE * source_size / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / sum(w) OVER (ORDER BY 2.0::DOUBLE * source_size / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM sources),
goals AS (
  SELECT source, source_size, least((SELECT level FROM levels WHERE level <= ratio ORDER BY ratio, source NULLS LAST LIMIT 1) * w,
                                    2.0::DOUBLE * source_size) AS target FROM levels),
placed AS (
  SELECT doc_id, size, source_size, target,
         CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS epochs,
         coalesce(sum(size) OVER (PARTITION BY keyed.source ORDER BY k, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM keyed JOIN goals ON keyed.source IS NOT DISTINCT FROM goals.source)
SELECT doc_id, size, source_size, target,
       CAST(epochs * size + least(size, greatest(0, floor(target - epochs * source_size) - before)) AS BIGINT) AS taken
FROM placed"""


@query("op5_mixing", MIXING_SQL)
def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = mixing.plan(table(spark, sf_dir, "documents"), [5, 2, 1])
    return rows.select(F.col("key").alias("doc_id"), "size", "source_size", "target", "taken")


@query("op6_decontamination")
def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.annotate(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", F.explode("hits").alias("hit")).select(
        "doc_id", F.col("hit.item").alias("item_id"), F.col("hit.edits").alias("edits"), F.col("hit.end").alias("end_word"))


TOPK_SQL = """
WITH ints AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM ints q JOIN ints c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM scored QUALIFY rank <= 5"""


@query("op7_topk", TOPK_SQL)
def op7_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mtree.search(table(spark, sf_dir, "embeddings"), F.col("key") % 50 == 0)
    return found.select(F.col("query").alias("query_id"), "rank", F.col("key").alias("vec_id"), "score")


def toxic_model(spark: SparkSession, sf_dir: str, docs: DataFrame):
    """The classifier, fitted on labelled rows whose remainder is not 2."""
    return toxicity.fit(docs, table(spark, sf_dir, "labels").where(text_crc32("doc_id") % 4 != 2))


@query("op9_toxicity")
def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held = F.coalesce(text_crc32("doc_id") % 4 == 2, F.lit(False)).alias("held_out")
    said = toxicity.score(docs.select("doc_id", "text", held), toxic_model(spark, sf_dir, docs))
    return said.select("doc_id", "held_out", "score", "predicted", F.to_json("toxic_spans").alias("spans"))


WARC_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
d AS (SELECT page_id, CAST(strlen(body) AS BIGINT) AS payload_bytes, sha1(body) AS payload_digest FROM p),
m AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS first FROM d)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id IS DISTINCT FROM first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM m"""


@query("op10_warc", WARC_SQL)
def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages")).withColumnRenamed("key", "page_id")


@query("op8_pii")
def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(table(spark, sf_dir, "documents"))
    return found.select(F.col("key").alias("doc_id"), *[f"n_{k}" for k in pii.KINDS],
                        F.sha2(pii.joined(F.col("base")), 256).alias("base_sha256"), pii.joined(F.col("spans")).alias("spans"))


HARDNEG_SQL = """
WITH ints AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, CAST(list_inner_product(a.v, c.v) AS BIGINT) AS score
  FROM ints a JOIN ints c ON a.vec_id <> c.vec_id WHERE a.vec_id % 100 = 0),
positives AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score
QUALIFY rank <= 5"""


@query("op11_hard_negatives", HARDNEG_SQL)
def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    found = hardneg.mine(table(spark, sf_dir, "embeddings"), F.col("key") % 100 == 0, label=label)
    return found.select(F.col("anchor").alias("anchor_id"), F.col("positive").alias("positive_id"), "rank",
                        F.col("negative").alias("negative_id"), "positive_score", "negative_score")


@query("op12_whitening")
def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings")).withColumnRenamed("key", "vec_id")


def pieces_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


@query("op13_sentencepiece")
def op13_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = pieces.round_trip(table(spark, sf_dir, "documents").select("doc_id", "text"), pieces.load(pieces_path()))
    return rows.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
                       F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
