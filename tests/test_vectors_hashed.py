"""Hashed text vectors: as Spark's own HashingTF and Normalizer over the prefixes of every word, and computed once a text."""

import numpy as np
from pyspark.ml.feature import HashingTF, Normalizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from issueloom.functions.text import or_empty
from issueloom.operators import embed as E
from issueloom.operators.evaluation import text_pairs
from issueloom.settings import Settings

TEXTS = [
    "", None, "a", "Ab ab abc ABCD abcde abcdefgh", "한국은행 기준금리 3.25% 인하했다", "금리 a1b2 가나다라마바사아자차카타파하 x", "—!?", "Ünïcode naïve façade İstanbul ΣΑΣ K",
    "日本語だけ", "日本", " ", "a" * 300 + " " + "가" * 101, "1 22 333 4444 55555 666666 7777777 88888888 999999999", "🙂 x🙂y zz", "word " * 500,
]


def plain_vectors(rows, text, dim):
    words = F.regexp_extract_all(F.lower(or_empty(text)), F.lit("([0-9a-z가-힣.%]+)"), F.lit(1))
    grown = F.flatten(F.transform(words, lambda w: F.when(F.length(w) < 2, F.array(w)).otherwise(
        F.transform(F.sequence(F.lit(2), F.greatest(F.lit(2), F.length(w))), lambda n: F.left(w, n)))))
    counted = rows.withColumn("_f", F.when(F.size(grown) > 0, grown).otherwise(F.array(F.lower(or_empty(text)))))
    counted = HashingTF(numFeatures=dim, inputCol="_f", outputCol="_tf").transform(counted)
    return Normalizer(p=2.0, inputCol="_tf", outputCol="_n").transform(counted).withColumn("want", vector_to_array("_n", "float32"))


def test_vectors_are_those_of_hashing_tf(spark):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "i int, t string")
    for dim in (64, 384, 1000):
        got = E.hashed_vectors(plain_vectors(rows, "t", dim), "t", dim).select("i", "vec", "want").collect()
        for r in got:
            assert np.array_equal(np.array(r.vec, np.float32), np.array(r.want, np.float32)), (r.i, dim)


def test_pairs_stay_rows_and_texts_do_not_travel(spark):
    pairs = spark.createDataFrame([(1, "금리 인하", "금리 인상", True), (2, "x", None, False), (2, "x", "y", True)], "pair int, a string, b string, same boolean")
    out = text_pairs(pairs, Settings())
    assert out.count() == 3 and {"pair", "a", "b", "same", "vec_a", "vec_b"} <= set(out.columns)
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
