"""Toxicity by a linear-chain conditional random field over words.

Labels say which documents are toxic. Words whose features (the word, its first four and five letters) occur almost only
in toxic training documents are labelled as toxic words there, all others as clean; a two-state CRF is fitted to windows of
labelled words by gradient descent on the log-likelihood. It tags whole texts: forward-backward marginals of every word
with a feature, the runs of other words between them enter as powers of one transfer matrix, which is exact. A document's
evidence is the probability that at least one word is toxic (one minus the product of the marginals' complements), and its score
the share of toxic training documents at that evidence. Words with a marginal of a half or more are reported with their
offsets in code points.

Only the classifier is fitted on a sample, of about `toxic_rows` and `clean_rows` documents chosen by a hash of the key,
whatever the size of the corpus. Features and weights are bounded by `features`. Every text is scored as a whole.

Null and empty texts have no word and get the score of documents without evidence. Without training labels every score is
0.5. Repeated rows get equal scores; equal scores need no order; other columns pass through unread.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..session import cut
from .common import free, whole

WIDTH = 9  # words of a training window
MEMO = 300_000
REJECT = 0.3
FIRM = 5.0  # standard deviations above chance


@dataclass(frozen=True)
class Model:
    weights: dict[bytes, float]  # emission of a toxic state by feature
    bias: float
    moves: np.ndarray  # log potential from state to state
    scores: tuple[float, float]  # of documents without and with evidence


def spaced() -> bytes:
    """For bytes.translate: letters in lower case, everything else of ASCII becomes a space."""
    table = bytearray(b" " * 128 + bytes(range(128, 256)))
    for i in range(26):
        table[65 + i] = table[97 + i] = 97 + i
    return bytes(table)


def features(word: bytes) -> list[bytes]:
    return [b"=" + word] + [bytes([48 + n]) + word[:n] for n in (4, 5) if len(word) > n]


class Emissions(dict):
    """Emission of each word, computed once; zero for words without features."""

    def __init__(self, weights: dict[bytes, float]) -> None:
        self.weights = weights

    def __missing__(self, word: bytes) -> float:
        if len(self) >= MEMO:
            self.clear()
        got = sum(self.weights.get(f, 0.0) for f in features(word))
        self[word] = got
        return got


def marginals(at: np.ndarray, emission: np.ndarray, n: int, bias: float, moves: np.ndarray) -> np.ndarray:
    """P(toxic) of the words at positions `at` of a text of n words; the others have emission zero."""
    step = np.exp(moves) * np.array([1.0, np.exp(bias)])  # to a word without features
    values, left = np.linalg.eig(step)
    back = np.linalg.inv(left)

    def run(k: int) -> np.ndarray:  # k plain steps, scaled
        v = (values / values.max()) ** k
        return (left * v) @ back

    gaps = np.diff(np.concatenate([[-1], at, [n]])) - 1
    own = [np.array([1.0, np.exp(min(bias + e, 500.0))]) for e in emission]
    ahead, a = [], np.array([1.0, 0.0])  # before the first word the state is clean
    for g, e in zip(gaps, own):
        a = (a @ run(int(g)) @ np.exp(moves)) * e
        a = np.maximum(a, 0) / a.sum()
        ahead.append(a)
    behind, b = [], run(int(gaps[-1])) @ np.ones(2)
    for i in range(len(own) - 1, -1, -1):
        behind.append(b / b.sum())
        b = run(int(gaps[i])) @ (np.exp(moves) @ (own[i] * b))
        b = b / b.sum()
    p = np.array(ahead) * np.array(behind[::-1])
    return p[:, 1] / p.sum(1)


def fit_chain(windows: np.ndarray, labels: np.ndarray, n_features: int, rounds: int = 150) -> tuple[np.ndarray, float, np.ndarray]:
    """Weights, bias and moves. windows: (windows, words, up to 3 feature numbers or -1); labels: 0 or 1 by word."""
    w, bias, moves = np.zeros(n_features + 1), -2.0, np.zeros((2, 2))
    m, t = labels.shape
    moments = [np.zeros(n_features + 5 + 1), np.zeros(n_features + 5 + 1)]
    pair = np.zeros((2, 2))
    for i in range(1, t):
        np.add.at(pair, (labels[:, i - 1], labels[:, i]), 1)
    for r in range(1, rounds + 1):
        w[-1] = 0.0
        score = bias + w[windows].sum(2)  # -1 is the last weight, always zero
        emit = np.stack([np.zeros_like(score), score], axis=2)
        fwd, bwd = np.zeros((m, t, 2)), np.zeros((m, t, 2))
        fwd[:, 0] = emit[:, 0]
        for i in range(1, t):
            fwd[:, i] = np.logaddexp(fwd[:, i - 1, :1] + moves[0], fwd[:, i - 1, 1:] + moves[1]) + emit[:, i]
        for i in range(t - 2, -1, -1):
            ahead = emit[:, i + 1] + bwd[:, i + 1]
            bwd[:, i] = np.logaddexp(moves[:, 0] + ahead[:, :1], moves[:, 1] + ahead[:, 1:])
        z = np.logaddexp(fwd[:, -1, 0], fwd[:, -1, 1])
        p = np.exp(fwd[:, :, 1] + bwd[:, :, 1] - z[:, None])
        expected = np.zeros((2, 2))
        for i in range(1, t):
            joint = fwd[:, i - 1, :, None] + moves + (emit[:, i] + bwd[:, i])[:, None, :] - z[:, None, None]
            expected += np.exp(joint).sum(0)
        off = p - labels
        grad_w = np.bincount(windows.ravel() % (n_features + 1), np.repeat(off.ravel(), windows.shape[2]), n_features + 1) / m + 1e-3 * w / m
        grad = np.concatenate([grad_w, [off.sum() / m], (expected - pair).ravel() / m + 1e-3 * moves.ravel()])
        moments[0] = 0.9 * moments[0] + 0.1 * grad
        moments[1] = 0.99 * moments[1] + 0.01 * grad**2
        move = 0.2 * (moments[0] / (1 - 0.9**r)) / (np.sqrt(moments[1] / (1 - 0.99**r)) + 1e-8)
        w, bias, moves = w - move[:n_features + 1], bias - float(move[n_features + 1]), moves - move[n_features + 2:].reshape(2, 2)
    return w[:-1], bias, moves


def sampled(docs: DataFrame, labels: DataFrame, toxic: str, key: str, toxic_rows: int, clean_rows: int) -> tuple[dict[int, int], DataFrame]:
    """Number of labelled documents of either label, and (id, y) of the sample; only keys and labels are read."""
    told = labels.where(F.col(toxic).isin(0, 1) & F.col(key).isNotNull()).select(F.col(key).alias("id"), F.col(toxic).cast("int").alias("y")).distinct()
    told = cut(told.join(docs.select(F.col(key).alias("id")).distinct(), "id", "left_semi"))
    sizes = {r["y"]: r["n"] for r in told.groupBy("y").agg(F.count("*").alias("n")).collect()}
    u = F.xxhash64(F.col("id").cast("string"), F.lit(23)) / F.lit(2.0**64) + 0.5
    share = F.when(F.col("y") == 1, min(1.0, toxic_rows / sizes.get(1, 1))).otherwise(min(1.0, clean_rows / sizes.get(0, 1)))
    return sizes, cut(told.where(u <= share))


def texts_of(docs: DataFrame, chosen: DataFrame, key: str, text: str, most: int) -> DataFrame:
    """(id, y, t) of the chosen ids, one row for each id, label and text. A sample within its bound travels to the
    texts, so they are read where they lie; the hash of a larger one would sort them."""
    few = chosen.count() <= 2 * most
    texts = docs.select(F.col(key).alias("id"), whole(text).alias("t")).join(F.broadcast(chosen) if few else chosen, "id")
    return texts.distinct()


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", toxic: str = "toxic", key: str = "doc_id", toxic_rows: int = 4000,
        clean_rows: int = 8000, n_features: int = 20_000, windows_of_text: int = 32) -> Model:
    """Learn from documents (key, text) and labels (key, toxic 0/1); other labels and null keys are left out, a document with
    both labels counts for both. The sample is drawn by a hash of the key on the labels alone, about `toxic_rows` and
    `clean_rows` documents; texts of these only are read. At most `windows_of_text` training windows of each are taken, by a
    hash over the whole text. Feature counts and windows of the sample reach the driver, no texts."""
    sizes, chosen = sampled(docs, labels, toxic, key, toxic_rows, clean_rows)
    if not sizes.get(0) or not sizes.get(1):
        return Model({}, -5.0, np.zeros((2, 2)), (0.5, 0.5))
    sample = cut(texts_of(docs, chosen, key, text, toxic_rows + clean_rows).select("y", "t"))
    table = spaced()

    @F.arrow_udf("array<binary>")
    def held(texts: pa.Array) -> pa.Array:
        out = [sorted({f for w in set(x.translate(table).split()) for f in features(w)}) for x in texts.cast(pa.large_binary()).to_pylist()]
        return pa.array(out, pa.list_(pa.binary()))

    counts = sample.select("y", F.explode(held("t")).alias("f")).groupBy("f").agg(F.sum("y").alias("bad"), F.count("*").alias("n"))
    # features that say something: much more often in toxic documents than their share of the sample, and not by chance
    bad, n, p = F.col("bad"), F.col("n"), min(sizes[1], toxic_rows) / (min(sizes[1], toxic_rows) + min(sizes[0], clean_rows))
    counts = counts.withColumn("rate", bad / n).withColumn("z", (bad - n * p) / F.sqrt(n * p * (1 - p)))
    telling = counts.where(f"bad >= 5 and rate >= {(1 + 3 * p) / 4} and z >= {FIRM}").orderBy(F.col("bad").desc(), "f").limit(n_features)
    found = {bytes(r["f"]): (i, r["rate"]) for i, r in enumerate(telling.collect())}
    marks = {f for f, (_, r) in found.items() if r >= 0.97}

    @F.arrow_udf("array<array<int>>")
    def windows(texts: pa.Array) -> pa.Array:
        """Feature numbers of the words around each word with features; the start of the text where there is none."""
        out = []
        for x in texts.cast(pa.large_binary()).to_pylist():
            words = x.translate(table).split()
            numbers = [[found[f][0] for f in features(w) if f in found] for w in words]
            spots = [i for i, v in enumerate(numbers) if v]
            taken, last = [], -WIDTH
            for i in spots or [WIDTH // 2]:
                if i - last < WIDTH // 2:
                    continue
                last = i
                flat: list[int] = []
                for j in range(i - WIDTH // 2, i + WIDTH // 2 + 1):
                    v = numbers[j] if 0 <= j < len(words) else []
                    flat += (v + [-1, -1, -1])[:3]
                taken.append(flat)
            if len(taken) > windows_of_text:
                seed = zlib.crc32(x)
                taken = sorted(taken, key=lambda flat: zlib.crc32(repr(flat).encode(), seed))[:windows_of_text]
            out.append(taken)
        return pa.array(out, pa.list_(pa.list_(pa.int32())))

    got = sample.select("y", F.explode(windows("t")).alias("w")).collect()
    x = np.array([r["w"] for r in got], np.int64).reshape(-1, WIDTH, 3)
    y = np.array([r["y"] for r in got])
    numbers = sorted(found, key=lambda f: found[f][0])
    is_mark = np.array([f in marks for f in numbers] + [False])
    labels = (is_mark[x].any(2) & (y[:, None] == 1)).astype(np.int64)
    w, bias, moves = fit_chain(x, labels, len(found))
    weights = {f: float(w[i]) for i, f in enumerate(numbers) if abs(w[i]) > 1e-6}
    model = Model(weights, bias, moves, (0.0, 1.0))
    seen = {(r["y"], r["hit"]): r["n"] for r in tag(sample, model, "t", "e").groupBy("y", (F.col("e.evidence") >= 0.5).alias("hit")).agg(
        F.count("*").alias("n")).collect()}
    # rates among all training documents, as the sample holds other shares of either label
    up = {k: sizes[k] / max(1, sum(v for (a, _), v in seen.items() if a == k)) for k in (0, 1)}
    rates = [(seen.get((1, hit), 0) * up[1] + 0.01) / (sum(seen.get((k, hit), 0) * up[k] for k in (0, 1)) + 0.02) for hit in (False, True)]
    return Model(weights, bias, moves, (rates[0], max(rates)))


def tag(df: DataFrame, model: Model, text: str = "text", name: str = "tags") -> DataFrame:
    """Adds struct(evidence, spans): spans are (start, end, marginal) of offending words, offsets in code points."""
    table = spaced()
    weights, bias, moves = model.weights, model.bias, model.moves

    @F.arrow_udf("struct<evidence:double,spans:array<struct<start:int,end:int,p:double>>>")
    def tags(texts: pa.Array) -> pa.Array:
        emissions = Emissions(weights)
        evidence, spans = [], []
        for raw in texts.cast(pa.large_binary()).to_pylist():
            plain = raw.translate(table)
            words = plain.split()
            e = np.fromiter(map(emissions.__getitem__, words), float, len(words))
            at = np.flatnonzero(e)
            if not len(at):
                evidence.append(0.0)
                spans.append([])
                continue
            p = marginals(at, e[at], len(words), bias, moves)
            evidence.append(float(1 - np.prod(1 - np.minimum(p, 1 - 1e-12))))
            found, from_byte, from_char, word = [], 0, 0, 0
            for i, q in zip(at.tolist(), p.tolist()):
                if q < 0.5:
                    continue
                while True:  # offsets: words are found again one by one, up to this one
                    start = plain.index(words[word], from_byte)
                    from_char += len(raw[from_byte:start].decode())
                    size = len(raw[start:start + len(words[word])].decode())
                    from_byte = start + len(words[word])
                    word += 1
                    if word > i:
                        break
                    from_char += size
                found.append({"start": from_char, "end": from_char + size, "p": q})
                from_char += size
            spans.append(found)
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("p", pa.float64())]))
        return pa.StructArray.from_arrays([pa.array(evidence, pa.float64()), pa.array(spans, kind)], ["evidence", "spans"])

    return df.withColumn(name, tags(whole(text)))


def score(df: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Adds score (0 to 1), predicted (1 from REJECT on) and toxic_spans."""
    (tags,) = free(df, "tags")
    low, high = model.scores
    value = F.lit(low) + F.lit(high - low) * F.col(tags)["evidence"]
    out = tag(df, model, text, tags).withColumns({"score": value, "toxic_spans": F.col(tags)["spans"]}).drop(tags)
    return out.withColumn("predicted", (F.col("score") >= REJECT).cast("int"))


def clean(df: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The rows that the classifier does not reject, with the columns they had."""
    (tags,) = free(df, "tags")
    low, high = model.scores
    return tag(df, model, text, tags).where(low + (high - low) * F.col(tags)["evidence"] < REJECT).drop(tags)
