"""The near-duplicate stage: fingerprints name candidates first, exact bounds leave few pairs to compare."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from issueloom.llm import simhash
from test_llm import jaccard, near_roots


def family(rng, n, base, edits):
    """Texts of one base with some words changed, each anew."""
    words = [f"b{i}" for i in rng.integers(0, 5000, base)]
    out = []
    for v in range(n):
        w = list(words)
        for at in rng.choice(base, int(rng.integers(0, edits)), replace=False) if v else ():
            w[at] = f"e{rng.integers(0, 300)}"
        out.append((v, " ".join(w)))
    return out


@pytest.fixture
def pairs(monkeypatch):
    """Numbers of pairs that are compared by their whole sets."""
    seen, real = [], simhash._linked

    def linked(some, *rest):
        seen.append(some.count())
        return real(some, *rest)

    monkeypatch.setattr(simhash, "_linked", linked)
    return seen


def test_texts_of_linked_fingerprints_need_no_band(spark, monkeypatch):
    rng = np.random.default_rng(1)
    rows = [(2 * i + v, " ".join(w[v:])) for i in range(20) for w in [[f"w{x}" for x in rng.integers(0, 9000, 400)]] for v in (0, 1)]
    real = simhash.sketch

    def without_bands(text, words):
        s = real(text, words)
        return F.struct(s["n"].alias("n"), s["fp"].alias("fp"), s["odd"].alias("odd"), F.array(F.xxhash64(text)).alias("keys"))

    monkeypatch.setattr(simhash, "sketch", without_bands)
    fp = {k: simhash.majority(iter([simhash.shingle_set(t.encode(), 5)])) for k, t in rows}
    near = {i for i in range(20) if (fp[2 * i] ^ fp[2 * i + 1]).bit_count() <= 2}
    assert len(near) >= 10
    df = spark.createDataFrame(rows, "doc_id long, text string")
    root = {r["key"]: r["root"] for r in simhash.near_groups(df).collect()}
    assert {i for i in range(20) if root[2 * i] == root[2 * i + 1]} == near
    assert simhash.dedup(df).count() == 40 - len(near)


def test_a_common_fingerprint_is_no_link_by_itself(spark, monkeypatch):
    real = simhash.sketch

    def one_fingerprint(text, words):
        s = real(text, words)
        return F.struct(s["n"].alias("n"), F.lit(5).cast("long").alias("fp"), s["odd"].alias("odd"), s["keys"].alias("keys"))

    monkeypatch.setattr(simhash, "sketch", one_fingerprint)
    rng = np.random.default_rng(2)
    rows = [(1000 * f + k, t) for f in range(3) for k, t in family(rng, 20, 150, 9)]
    got, want = near_roots(spark, rows)
    assert got == want


def test_few_pairs_of_a_large_family_are_compared(spark, pairs):
    rows = family(np.random.default_rng(3), 300, 150, 14)
    got, want = near_roots(spark, rows)
    assert got == want and 20 < len(want) < 280  # some are alike, many are not
    assert sum(pairs) <= 4 * len(rows)


def test_bounds_rule_out_no_similar_pair(spark):
    rng = np.random.default_rng(4)
    sets = [simhash.shingle_set(t.encode(), 5) for size in (6, 40, 400, 4000) for _, t in family(rng, 25, size, max(2, size // 25))]
    rows = [(i, j, len(a), len(b), simhash.parity(a).tolist(), simhash.parity(b).tolist()) for i, a in enumerate(sets) for j, b in enumerate(sets) if i < j]
    df = spark.createDataFrame(rows, "i int, j int, n int, hn int, odd array<long>, hodd array<long>").where(simhash._may_reach(0.8))
    kept = {(r["i"], r["j"]) for r in df.select("i", "j").collect()}
    alike = {(i, j) for i, j, *_ in rows if jaccard(set(sets[i].tolist()), set(sets[j].tolist())) >= 0.8}
    assert alike and alike <= kept and len(kept) < len(rows) / 2


def test_texts_without_words_are_one_group(spark):
    df = spark.createDataFrame([(1, ""), (2, None), (3, " \n"), (4, "a b"), (5, "\t")], "doc_id long, text string")
    root = {r["key"]: r["root"] for r in simhash.near_groups(df).collect()}
    assert len({root[k] for k in (1, 2, 3, 5)}) == 1 and root[4] != root[1]
