"""Near-duplicate marking against brute force, and the small duplicate rules."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from issueloom.operators import dedup as D

T0 = dt.datetime(2024, 3, 1)


def brute(rows, k, window_h):
    out = set()
    for i, (o, h, t) in enumerate(rows):
        for p, g, u in rows[:i]:
            if bin((h ^ g) & (2**64 - 1)).count("1") > k:
                continue
            if t is None or u is None or abs((t - u).total_seconds()) <= window_h * 3600:
                out.add(o)
                break
    return out


def make(rng, n, late_first):
    base = [int(x) for x in rng.integers(-(2**62), 2**62, size=5)]
    rows = []
    for i in range(n):
        h = base[rng.integers(len(base))] & (2**64 - 1)
        for b in rng.integers(0, 64, size=rng.integers(0, 5)):
            h = (h ^ (1 << int(b))) & (2**64 - 1)
        h = h - 2**64 if h >= 2**63 else h
        t = None if rng.random() < 0.1 else T0 + dt.timedelta(hours=float(rng.integers(0, 400)))
        rows.append((i, h, t))
    if late_first:  # the order of arrival runs against time
        times = sorted((r[2] for r in rows if r[2] is not None), reverse=True)
        it = iter(times)
        rows = [(o, h, next(it) if t is not None else None) for o, h, t in rows]
    return rows


@pytest.mark.parametrize("seed,hot_limit,late_first", [(1, 2000, False), (2, 3, False), (3, 2, True), (4, 2000, True)])
def test_marking_equals_brute_force(spark, seed, hot_limit, late_first):
    rows = make(np.random.default_rng(seed), 150, late_first)
    df = spark.createDataFrame(rows, "o long, h long, t timestamp")
    got = D.mark_near_duplicates(df, "h", "o", "t", 3, 48, hot_limit=hot_limit)
    assert {r.o for r in got.filter("is_dup").collect()} == brute(rows, 3, 48)


@pytest.mark.parametrize("late_first", [False, True])
def test_rows_that_need_no_answer_are_only_met(spark, late_first):
    rows = make(np.random.default_rng(6), 150, late_first)
    df = spark.createDataFrame(rows, "o long, h long, t timestamp")
    got = D.mark_near_duplicates(df, "h", "o", "t", 3, 48, hot_limit=3, asked=F.col("o") >= 90)
    marked = {r.o: r.is_dup for r in got.collect()}
    assert {o for o in marked if marked[o] and o >= 90} == {o for o in brute(rows, 3, 48) if o >= 90}
    assert all(marked[o] for o in range(90))


def test_neighbouring_slices_are_decided_row_by_row(spark):
    """One hash in many rows around the borders of the slices, in random order of arrival: every question is an open one."""
    rng = np.random.default_rng(8)
    for step in (1, 60 * 24):
        minutes = rng.integers(0, 4 * 48 * 60 // step, 400) * step
        rows = [(i, 7 if i % 3 else 5, T0 + dt.timedelta(minutes=int(m))) for i, m in enumerate(minutes)]
        df = spark.createDataFrame(rows, "o long, h long, t timestamp")
        got = D.mark_near_duplicates(df, "h", "o", "t", 3, 48)
        assert {r.o for r in got.filter("is_dup").collect()} == brute(rows, 3, 48)


def test_one_hot_hash_and_missing_hashes(spark):
    rows = [(i, 7, T0 + dt.timedelta(hours=i)) for i in range(300)] + [(1000, None, T0), (1001, None, T0)]
    df = spark.createDataFrame(rows, "o long, h long, t timestamp")
    got = D.mark_near_duplicates(df, "h", "o", "t")
    assert {r.o for r in got.filter("NOT is_dup").collect()} == {0, 1000, 1001}


def test_first_row_per_id_wins(spark):
    df = spark.createDataFrame([("a", 2, "late"), ("a", 1, "early"), ("b", 3, "only")], "id string, n int, v string")
    assert {r.id: r.v for r in D.first_by_id(df, "id", [F.col("n")]).collect()} == {"a": "early", "b": "only"}


def test_similar_sentences(spark):
    rows = [(["코스피가 크게 올랐어요", "코스피가 크게 올랐어요.", "금리는 그대로예요", "코스피가 크게 내렸어요"],), (None,)]
    df = spark.createDataFrame(rows, "s array<string>")
    assert [r.k for r in df.select(D.distinct_sentences("s").alias("k")).collect()] == [
        ["코스피가 크게 올랐어요", "금리는 그대로예요", "코스피가 크게 내렸어요"], []]


def test_counts_ignore_duplicates(spark):
    df = spark.createDataFrame(
        [("i", "s1", False), ("i", "s1", False), ("i", "s2", True), ("i", "s3", False), (None, "s4", False)],
        "issue_id string, source string, is_dup boolean")
    assert D.distinct_sources(df).collect()[0].seen_sources == 2
    assert D.member_counts(df).collect()[0].members == 3
