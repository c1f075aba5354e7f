"""Structured Streaming forms of the periodic jobs.

The source of each job is a folder of files; `available_now` runs drain it and stop, a processing-time trigger keeps
going. Sinks and state live in the shared folder, one sub-folder per micro-batch, so a repeated batch overwrites its
own output and nothing is written twice.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators import series as G
from ..operators.readmodel import index_document
from ..operators.dedup import first_by_id, mark_near_duplicates
from ..plans.cycle import Dictionaries, diagnose, run_cycle
from ..plans.state import Snapshot, load_state, vacuum
from ..settings import Settings
from ..sources.landing import publish


def source(spark: SparkSession, folder: str, schema, pattern: str = "*.parquet", files_per_batch: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema).option("pathGlobFilter", pattern)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def drain(stream: DataFrame, path: str, mode: str = "append", batch: Callable | None = None) -> None:
    """Run over everything that has arrived, then stop."""
    writer = stream.writeStream.option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True)
    if batch is not None:
        writer.foreachBatch(batch).start().awaitTermination()
    else:
        writer.outputMode(mode).format("parquet").option("path", f"{path}/rows").start().awaitTermination()


def _first_of_batch(key: str) -> Callable:
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield frame.drop_duplicates(key)

    return run


def dedup_stream(rows: DataFrame, key: str, ts: str, delay: str = "26 hours") -> DataFrame:
    """Each key once within the lookback. Repeats inside an Arrow batch go before the shuffle, so a hot key sends few rows."""
    thinned = rows.mapInPandas(_first_of_batch(key), rows.schema)
    return thinned.withWatermark(ts, delay).dropDuplicatesWithinWatermark([key])


def idle_stream(rows: DataFrame, key: str, ts: str, gap: str = "72 hours", delay: str = "1 hour") -> DataFrame:
    """Spans of activity per key that ended with an idle gap: the moment after which the key is stale."""
    return (
        rows.withWatermark(ts, delay)
        .groupBy(F.session_window(F.col(ts), gap), F.col(key))
        .agg(F.count(F.lit(1)).alias("rows"), F.max(ts).alias("last_update"))
        .select(key, "rows", "last_update", F.col("session_window.end").alias("stale_at"))
    )


def _previous(spark: SparkSession, path: str, name: str, batch_id: int, schema) -> DataFrame:
    """State written by the batch before; empty at the start."""
    if batch_id == 0:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{path}/{name}/batch={batch_id - 1}")


OBSERVATION = "series_id string, ts timestamp, value double, tie long"


def level_change_batches(path: str, min_delta: float, unit: str = "minute") -> Callable:
    """foreachBatch function: level changes across batches; the last observation per series is the state."""

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        state = _previous(spark, path, "state", batch_id, OBSERVATION)
        rows = state.withColumn("_old", F.lit(True)).unionByName(batch.withColumn("_old", F.lit(False)))
        changes = G.level_changes(rows, min_delta, unit).filter(~F.col("_old")).drop("_old")
        changes.write.mode("overwrite").parquet(f"{path}/rows/batch={batch_id}")
        last = F.max_by(F.struct("ts", "value", "tie"), F.struct("ts", "tie")).alias("s")
        latest = rows.groupBy("series_id").agg(last).select("series_id", "s.ts", "s.value", "s.tie")
        latest.write.mode("overwrite").parquet(f"{path}/state/batch={batch_id}")

    return run


ARTICLE = "aid long, id string, simhash long, published_at timestamp"


def ingest_batches(path: str, s: Settings, time_col: str | None = "published_at") -> Callable:
    """foreachBatch function: exact and near duplicates against everything that earlier batches stored."""

    def stored_before(spark: SparkSession, batch_id: int) -> DataFrame:
        """Rows of the earlier batches only, so that a repeated batch meets the same table."""
        if batch_id == 0:
            return spark.createDataFrame([], ARTICLE)
        rows = spark.read.schema(ARTICLE + ", is_dup boolean, batch int").parquet(f"{path}/rows")
        return rows.filter(F.col("batch") < batch_id).select("aid", "id", "simhash", "published_at")

    def run(batch: DataFrame, batch_id: int) -> None:
        stored = stored_before(batch.sparkSession, batch_id)
        fresh = first_by_id(batch, "id", [F.col("aid")]).join(stored.select("id"), "id", "left_anti")
        fresh = fresh.select("aid", "id", "simhash", "published_at")
        order = F.struct(F.col("_new").alias("n"), F.col("aid").alias("a"))
        pool = stored.withColumn("_new", F.lit(0)).unionByName(fresh.withColumn("_new", F.lit(1))).withColumn("ord", order)
        if time_col is not None:
            low = batch.agg(F.min(time_col) - F.expr(f"INTERVAL {s.dup_window_h} HOURS")).scalar()
            pool = pool.filter(F.col(time_col).isNull() | low.isNull() | (F.col(time_col) >= low) | (F.col("_new") == 1))
        marked = mark_near_duplicates(pool, "simhash", "ord", time_col, s.simhash_k, s.dup_window_h, asked=F.col("o.n") == 1)
        out = marked.filter("_new = 1").select("aid", "id", "simhash", "published_at", "is_dup")
        out.write.mode("overwrite").parquet(f"{path}/rows/batch={batch_id}")

    return run


def cycle_batches(path: str, events: Callable, clock: Callable, d: Dictionaries, s: Settings, topics: Callable | None = None,
                  attribution: str = "", **options) -> Callable:
    """foreachBatch function: one whole cycle per micro-batch of raw articles.

    `events(batch_id)` gives the event documents to consider, `clock(batch_id)` the time of the cycle. Batch n commits version n of
    the state, starting from version n - 1, so a repeated batch starts again from the state before it. Versions older than the
    last two and what only they used are removed. `topics(state)` gives the steady topics of the index, `attribution` names
    its sources.
    """
    def run(batch: DataFrame, batch_id: int) -> None:
        spark, root = batch.sparkSession, f"{path}/state"
        state = load_state(spark, root, batch_id - 1) if batch_id else Snapshot(spark, root)
        written, stats, cards, details = run_cycle(
            spark, state, batch, events(batch_id), clock(batch_id), d, s, folder=root, version=batch_id, **options)
        index = index_document(cards, clock(batch_id), attribution, topics(written) if topics is not None else None)
        publish(index, details, f"{path}/published")
        metadata, listed, recent = diagnose(written, clock(batch_id), s)
        publish(metadata, listed, f"{path}/diagnostics/issues")
        publish(metadata, recent, f"{path}/diagnostics/articles")
        vacuum(spark, root)
        run.stats = stats

    return run
