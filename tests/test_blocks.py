"""Order-dependent helpers and blocked similarity joins against plain definitions."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import Window as W, functions as F

from issueloom.operators import ordered as O, similarity as S

T0 = dt.datetime(2024, 1, 1)


def test_previous_row_equals_lag(spark):
    rng = np.random.default_rng(1)
    rows = [(str(rng.integers(2)), T0 + dt.timedelta(seconds=int(rng.integers(0, 900))), i, float(i)) for i in range(200)]
    df = spark.createDataFrame(rows, "k string, ts timestamp, tie long, value double")
    got = O.with_previous(df, "k", "ts", "tie", ["value"])
    want = df.withColumn("prev_value", F.lag("value").over(W.partitionBy("k").orderBy("ts", "tie")))
    cols = ["k", "tie", "prev_value"]
    assert got.select(cols).exceptAll(want.select(cols)).count() == 0 and got.count() == 200


def test_rank_equals_row_number(spark):
    rng = np.random.default_rng(2)
    rows = [(str(rng.integers(3)), None if i % 17 == 0 else T0 + dt.timedelta(hours=int(rng.integers(0, 200))), i) for i in range(150)]
    df = spark.createDataFrame(rows, "k string, ts timestamp, tie long")
    got = O.with_rank(df, "k", "ts", "tie")
    w = W.partitionBy("k").orderBy(F.col("ts").desc_nulls_last(), "tie")
    want = df.withColumn("rank", F.row_number().over(w).cast("long")).withColumn("size", F.count("*").over(W.partitionBy("k")))
    cols = ["tie", "rank", "size"]
    assert got.select(F.col("tie"), F.col("rank").cast("long"), "size").exceptAll(want.select(cols)).count() == 0


def test_large_top_n_uses_two_stages(spark, monkeypatch):
    monkeypatch.setattr(O, "MAP_SIDE_LIMIT", 3)
    df = spark.range(100).select((F.col("id") % 2).alias("k"), F.col("id"))
    got = O.top_n(df, ["k"], [F.col("id").desc()], 5)
    assert sorted(r.id for r in got.collect()) == list(range(90, 100))


def test_spread_join_keeps_every_row(spark):
    big = spark.range(1000).select(F.lit(1).alias("k"), "id")
    small = spark.createDataFrame([(1, "x")], "k int, v string")
    assert O.spread_join(big, small, ["k"], "inner", ["id"]).filter("v = 'x'").count() == 1000


@pytest.mark.parametrize("block", [5, 64])
def test_blocked_joins(spark, block):
    rng = np.random.default_rng(3)
    m = rng.normal(size=(60, 6))
    m = (m / np.linalg.norm(m, axis=1, keepdims=True)).astype(np.float32)
    groups = [sorted(set(rng.choice(list("abc"), size=rng.integers(1, 3)).tolist())) for _ in m]
    rows = [(i, v.tolist(), g, i, 0.2, int(rng.integers(60)), int(rng.integers(1, 9)), int(rng.integers(1, 9))) for i, (v, g) in enumerate(zip(m, groups))]
    df = spark.createDataFrame(rows, "id long, vec array<float>, grp array<string>, ord long, bar double, bar_ord long, room long, weight long")
    probes = df.withColumnRenamed("id", "pid").select("pid", "vec", "grp", "bar", "bar_ord", "room")
    targets = df.select(F.col("id").alias("tid"), "vec", "grp", F.col("ord").alias("tord"), "weight")
    sims = np.round(m.astype(float) @ m.astype(float).T, 9)
    shares = np.array([[bool(set(a) & set(b)) for b in groups] for a in groups])
    np.fill_diagonal(shares, False)
    best = {r.pid: r.tid for r in S.best_match(probes, targets, 0.3, True, block).collect()}
    want = {}
    for i in range(60):
        near = [(-sims[i, j], j) for j in range(60) if shares[i, j] and sims[i, j] >= 0.3]
        if near:
            want[i] = min(near)[1]
    assert best == want
    first = {r.pid: r.tid for r in S.first_match(probes, targets, 0.3, block).collect()}
    fits = lambda i, j: shares[i, j] and sims[i, j] >= 0.3 and rows[j][7] <= rows[i][6]
    assert first == {i: min(j for j in range(60) if fits(i, j)) for i in range(60) if any(fits(i, j) for j in range(60))}
    everyone = F.array(F.lit(S.ANY_GROUP))
    p, t = probes.withColumn("grp", everyone), targets.withColumn("grp", everyone)
    counts = {r.pid: r.n for r in S.match_counts(p, t, 0.3, True, block).collect()}
    alone = sims - 3 * np.eye(60)
    assert counts == {i: int((alone[i] >= 0.3).sum()) for i in range(60) if (alone[i] >= 0.3).any()}
    above = {(r.pid, r.tid) for r in S.matches_above(p, t, 0.2, True, block).collect()}
    assert above == {(i, j) for i in range(60) for j in range(60)
                     if i != j and sims[i, j] >= 0.2 and (sims[i, j] > 0.2 or j < rows[i][5])}


def test_single_precision_decides_nothing():
    """Pairs next to a bound, and equal best ones, are told as in double precision; a row that has its first target looks no further."""
    rng = np.random.default_rng(6)
    v = rng.normal(size=(3000, 16)).astype(np.float32)
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    t = np.concatenate([v, v[:40] * np.float32(1 + 2e-7), v[:40]])
    sims = np.round(v[:90].astype(float) @ t.astype(float).T, 9)
    tau = float(np.sort(sims.ravel())[-2000])
    sums, r, c, ids = S.Products(v[:90], t), np.arange(90), np.arange(len(t)), np.arange(len(t))
    assert sums.fast[0].dtype == np.float32
    assert (sums.above(sums.tile(r, c), r, c, tau) == (sims >= tau)).all()
    i, j, value = S._best(sums, r, c, ids, ids, ids, tau, False)
    assert (j == sims.argmax(1)[i]).all() and np.allclose(value, sims.max(1)[i], atol=2e-9)
    seen, tile = [], sums.tile
    sums.tile = lambda rows, cols: seen.append(len(rows)) or tile(rows, cols)
    room, weight = np.full(90, 5), np.full(len(t), 5)
    i, j, _ = S._first(sums, r, c, ids, ids, room, weight, -2.0, False)
    assert (j == 0).all() and len(i) == 90 and seen == [90]
