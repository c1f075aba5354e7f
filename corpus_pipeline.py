"""A training corpus from raw documents: each stage takes what the one before kept and is written before the next reads it.

Null and empty texts pass the filters and end as documents of one id; repeated rows are copies for the second stage. Extra
columns go through all stages but the last. Null keys come first in the token file.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from issueloom.llm import decontam, mixing, simhash, tokenfile, toxicity
from issueloom.llm.catalog import table, tokenizer_path, toxic_model
from issueloom.llm.common import small_batches
from issueloom.session import Scratch

WEIGHTS = [5, 2, 1]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject; it learns from labelled rows of these documents."""
    small_batches(spark)
    return toxicity.clean(docs, toxic_model(spark, sf_dir, docs))


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: candidates by SimHash with Golay keys, then by bands for those further apart, each
    verified over five-word shingles at a similarity of 0.8 or more."""
    small_batches(spark)
    return simhash.dedup(docs, words=5, similarity=0.8)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    small_batches(spark)
    return decontam.clean(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources in the target proportions; documents of complete epochs repeat."""
    small_batches(spark)
    return mixing.mix(docs, WEIGHTS)


def token_file(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token file in the order of doc_id: where each document's ids start, their number and checksum."""
    small_batches(spark)
    return tokenfile.round_trip(docs, tokenizer_path()).selectExpr("key AS doc_id", "start", "n AS n_tokens", "ids_crc32")


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", one_of_near_copies),
    ("decontamination", without_benchmark),
    ("mixing", mixed),
    ("tokens", token_file),
]

ORACLE_SQL = None  # learned scores, hashes and a tokenizer: tested stage by stage against plain versions


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = Scratch(spark)
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        kept = own.cut(stage(spark, docs, sf_dir))
        own.drop(docs)  # the stage before has been read for the last time
        docs = kept
    return STAGES[-1][1](spark, docs, sf_dir)
