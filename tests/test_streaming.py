"""Streaming jobs over several small files against the batch jobs over all rows."""

import datetime as dt

import numpy as np
from pyspark.sql import functions as F

from issueloom.operators import series as G
from issueloom.operators.dedup import mark_near_duplicates
from issueloom.session import fresh_path
from issueloom.settings import Settings
from issueloom.streaming import jobs as J

T0 = dt.datetime(2024, 1, 1)


def landed(spark, tmp_path, rows, schema, parts):
    folder = str(tmp_path / "in")
    size = -(-len(rows) // parts)
    for i in range(parts):
        spark.createDataFrame(rows[i * size:(i + 1) * size], schema).coalesce(1).write.mode("append").parquet(folder)
    return folder, spark.read.schema(schema).parquet(folder)


def test_level_changes_across_batches(spark, tmp_path):
    rng = np.random.default_rng(4)
    rows = [(str(i % 2), T0 + dt.timedelta(minutes=5 * i), float(rng.integers(0, 3)), i) for i in range(60)]
    folder, batch = landed(spark, tmp_path, rows, J.OBSERVATION, 3)
    path = fresh_path(spark, "t")
    J.drain(J.source(spark, folder, batch.schema, files_per_batch=1), path, batch=J.level_change_batches(path, 0.05))
    got = {(r.series_id, r.tie, r.prev_value) for r in spark.read.parquet(f"{path}/rows").collect()}
    assert got == {(r.series_id, r.tie, r.prev_value) for r in G.level_changes(batch, 0.05).collect()}
    assert spark.read.parquet(f"{path}/state").select("batch").distinct().count() == 3


def test_ingest_across_batches(spark, tmp_path):
    rng = np.random.default_rng(5)
    rows = []
    for i in range(60):
        h = int(rng.integers(0, 4)) << 40
        for b in rng.integers(0, 20, size=2):
            h ^= 1 << int(b)
        rows.append((i, f"id{rng.integers(0, 50)}", h, T0 + dt.timedelta(hours=int(i * 3))))
    folder, batch = landed(spark, tmp_path, rows, J.ARTICLE, 3)
    path = fresh_path(spark, "t")
    J.drain(J.source(spark, folder, batch.schema, files_per_batch=1), path, batch=J.ingest_batches(path, Settings()))
    got = {(r.aid, r.is_dup) for r in spark.read.parquet(f"{path}/rows").collect()}
    seen, first = set(), []
    for r in rows:
        if r[1] not in seen:
            seen.add(r[1])
            first.append(r)
    once = spark.createDataFrame(first, J.ARTICLE)
    want = {(r.aid, r.is_dup) for r in mark_near_duplicates(once, "simhash", "aid", "published_at").collect()}
    assert got == want


def test_dedup_and_idle(spark, tmp_path):
    rows = [(f"k{i % 7}", T0 + dt.timedelta(minutes=i)) for i in range(50)] + [("k0", T0 + dt.timedelta(days=9))]
    folder, batch = landed(spark, tmp_path, rows, "key string, ts timestamp", 2)
    path = fresh_path(spark, "t")
    J.drain(J.dedup_stream(J.source(spark, folder, batch.schema, files_per_batch=1), "key", "ts"), path)
    assert spark.read.parquet(f"{path}/rows").select("key").distinct().count() == 7
    other = fresh_path(spark, "t")
    J.drain(J.idle_stream(J.source(spark, folder, batch.schema), "key", "ts"), other)
    idle = spark.read.parquet(f"{other}/rows").collect()
    assert len(idle) == 7 and sum(r.rows for r in idle) == 50
