"""Language identification by nearest centroids.

A text becomes a vector of hashed character n-grams (2 to 4 bytes of the lower-cased text, everything that is not a
letter taken as one space), weighted by TF-IDF and normalised. Each language is described by several centroids, found by
spherical k-means; a text gets the language of the closest centroid by cosine. A text further away than nearly all
training texts of that centroid is rejected.

Only the classifier is fitted on a sample: `per_language` rows are expected of each language, chosen by a hash of their
key, so the bound does not depend on the size of the corpus. Every text is classified as a whole.

Null texts and texts without a letter: language `und`, score 0, rejected. No training row: the same for every text. Rows
without a language are not trained on. Repeated rows get equal answers; other columns pass through unread.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..session import cut
from .common import free, runs, utf8

BUCKETS = 4096
GRAMS = (2, 3, 4)
UNKNOWN = "und"
SLACK = 1.1  # how much further than the 99th percentile of the training distances a text may be


@dataclass(frozen=True)
class Model:
    idf: np.ndarray  # by bucket
    centroids: np.ndarray  # one row each, unit length
    languages: list[str]  # of each centroid
    radii: np.ndarray  # largest accepted distance of each centroid


def _letters() -> np.ndarray:
    """Bytes of lower-cased UTF-8; ASCII characters that are not letters become spaces."""
    table = np.full(256, 32, np.uint8)
    table[97:123] = np.arange(97, 123)
    table[128:] = np.arange(128, 256)
    return table


def counts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Counts of hashed n-grams: a row for each text. No n-gram spans two texts or holds two spaces in a row."""
    n = len(offsets) - 1
    own = np.repeat(np.arange(n, dtype=np.int32), np.diff(offsets))
    b = _letters()[data[offsets[0]:offsets[-1]]]
    if not len(b):
        return np.zeros((n, BUCKETS), np.float32)
    keep = np.ones(len(b), bool)
    keep[1:] = (b[1:] != 32) | (b[:-1] != 32) | (own[1:] != own[:-1])
    b, own = b[keep].astype(np.uint32), own[keep]
    out = np.zeros(n * BUCKETS, np.int64)
    h = b.copy()
    for g in range(1, max(GRAMS)):
        if len(b) <= g:
            break
        h = h[:-1] * np.uint32(0x01000193) + b[g:] + np.uint32(g)
        if g + 1 in GRAMS:
            same = own[:-g] == own[g:]
            where = ((h * np.uint32(0x9E3779B1)) >> np.uint32(20))[same].astype(np.int64)
            out += np.bincount(own[:-g][same].astype(np.int64) * BUCKETS + where, minlength=n * BUCKETS)
    return out.reshape(n, BUCKETS).astype(np.float32)


def weigh(raw: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """TF-IDF rows of length one; empty rows stay zero."""
    v = np.log1p(raw) * idf
    return v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-9)


def spherical_means(v: np.ndarray, k: int, rounds: int = 8) -> tuple[np.ndarray, np.ndarray]:
    """Centroids of unit rows and the centroid of each row; starts are rows far from each other."""
    k = min(k, len(v))
    c = [v.mean(0)]
    c[0] /= max(np.linalg.norm(c[0]), 1e-9)
    starts = [int(np.argmax(v @ c[0]))]
    near = v @ v[starts[0]]
    for _ in range(1, k):
        starts.append(int(np.argmin(near)))
        near = np.maximum(near, v @ v[starts[-1]])
    c = v[starts]
    for _ in range(rounds):
        at = np.argmax(v @ c.T, axis=1)
        c = np.stack([v[at == i].mean(0) if (at == i).any() else c[i] for i in range(len(c))])
        c /= np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-9)
    return c.astype(np.float32), np.argmax(v @ c.T, axis=1)


def _padded(text: str):
    return F.concat(F.lit(" "), F.lower(F.col(text)), F.lit(" "))


def fit(rows: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id", per_language: int = 1000,
        clusters: int = 4) -> Model:
    """Learn centroids from rows with a language and a letter. Only figures by language reach the driver."""
    good = rows.select(F.col(lang).alias("lang"), F.col(text).alias("text"), F.xxhash64(F.col(key).cast("string"), F.lit(17)).alias("h"))
    good = good.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    sizes = {r["lang"]: r["n"] for r in good.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return Model(np.ones(BUCKETS, np.float32), np.zeros((0, BUCKETS), np.float32), [], np.zeros(0, np.float32))
    share = F.create_map(*[F.lit(x) for k, n in sizes.items() for x in (k, min(1.0, per_language / n))])
    uniform = (F.col("h") / F.lit(2.0**64)) + 0.5

    @F.arrow_udf("binary")
    def vector(texts: pa.Array) -> pa.Array:
        data, offsets = utf8(texts)
        out = []
        for i, j in runs(offsets, 1 << 20, 64):
            out += [x.tobytes() for x in counts(data, offsets[i:j + 1])]
        return pa.array(out, pa.binary())

    sample = cut(good.where(uniform <= share[F.col("lang")]).select("lang", vector(_padded("text")).alias("v")))

    def frequencies(group: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(BUCKETS)
        for x in group["v"]:
            total += np.frombuffer(x, np.float32) > 0
        return pd.DataFrame({"n": [len(group)], "df": [total.tobytes()]})

    found = sample.groupBy("lang").applyInPandas(frequencies, "n long, df binary").collect()
    df, n = sum(np.frombuffer(r["df"]) for r in found), sum(r["n"] for r in found)
    idf = (np.log((1 + n) / (1 + df)) + 1).astype(np.float32)

    def centroids(group: pd.DataFrame) -> pd.DataFrame:
        v = weigh(np.stack([np.frombuffer(x, np.float32) for x in sorted(group["v"])]), idf)
        c, at = spherical_means(v, clusters)
        far = 1 - np.einsum("ij,ij->i", v, c[at])
        radius = [float(np.quantile(far[at == i], 0.99)) if (at == i).any() else 0.0 for i in range(len(c))]
        return pd.DataFrame({"lang": group["lang"].iloc[0], "c": [x.tobytes() for x in c], "radius": radius})

    got = sorted(sample.groupBy("lang").applyInPandas(centroids, "lang string, c binary, radius double").collect())
    return Model(idf, np.stack([np.frombuffer(r["c"], np.float32) for r in got]), [r["lang"] for r in got],
                 np.array([r["radius"] for r in got], np.float32))


def predict(df: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Adds lang_pred, score (cosine, 0 to 1), lang_rejected, and lang_accepted (null where rejected)."""
    model_languages = np.array(model.languages, object)

    @F.arrow_udf("struct<lang:string,score:double,rejected:boolean>")
    def nearest(texts: pa.Array) -> pa.Array:
        data, offsets = utf8(texts)
        lang, score, away = [], [], []
        for i, j in runs(offsets, 1 << 20, 256):
            sim = weigh(counts(data, offsets[i:j + 1]), model.idf) @ model.centroids.T
            at = np.argmax(sim, axis=1)
            best = np.clip(sim[np.arange(len(at)), at], 0, 1)
            lang += list(model_languages[at])
            score += best.tolist()
            away += (1 - best > model.radii[at] * SLACK).tolist()
        return pa.StructArray.from_arrays([pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(away, pa.bool_())],
                                          ["lang", "score", "rejected"])

    (got,) = free(df, "nearest")
    if model.languages:
        readable = F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False))
        df = df.withColumn(got, F.when(readable, nearest(F.when(readable, _padded(text)).otherwise(F.lit("")))))
    else:
        df = df.withColumn(got, F.lit(None).cast("struct<lang:string,score:double,rejected:boolean>"))
    accepted = F.when(~F.col(got)["rejected"], F.col(got)["lang"])
    return df.withColumns({
        "lang_pred": F.coalesce(F.col(got)["lang"], F.lit(UNKNOWN)),
        "score": F.coalesce(F.col(got)["score"], F.lit(0.0)),
        "lang_rejected": F.coalesce(F.col(got)["rejected"], F.lit(True)),
        "lang_accepted": accepted,
    }).drop(got)
