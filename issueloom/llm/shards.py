"""Reproducible shuffle and sharding by a Feistel permutation of global row numbers.

Rows are numbered from 0 in the order of the given columns; a keyed Feistel network permutes the numbers, walking along
its cycle until the image is a row number again. Image p goes to shard p mod shards, slot p div shards. Both directions can
be computed from the row count and the seed alone (`place`, `row_at`), so a loader can find any slot without a table.

Law `rows`: the shards' row counts differ by one at most and the slots of each shard are 0, 1, 2 ... without a gap.

Null keys come first, ties are ordered by the remaining given columns; rows equal in all of them are interchangeable. Empty
tables give an empty result; a null text counts as no bytes. Other columns stay out of the numbering.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from ..session import cut
from .common import free, mix64

ROUNDS = 6


def _half_bits(rows: int) -> int:
    return max(1, (max(rows - 1, 1).bit_length() + 1) // 2)


def _keys(seed: int) -> np.ndarray:
    return mix64(np.arange(1, ROUNDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed))


def _feistel(x: np.ndarray, half: int, keys: np.ndarray, back: bool) -> np.ndarray:
    mask, shift = np.uint64((1 << half) - 1), np.uint64(half)
    left, right = x >> shift, x & mask
    for k in keys[::-1] if back else keys:
        if back:
            left, right = right ^ (mix64(left ^ k) & mask), left
        else:
            left, right = right, left ^ (mix64(right ^ k) & mask)
    return left << shift | right


def _walk(x: np.ndarray, rows: int, seed: int, back: bool) -> np.ndarray:
    half, keys = _half_bits(rows), _keys(seed)
    x = _feistel(np.asarray(x).astype(np.uint64), half, keys, back)
    out = np.flatnonzero(x >= rows)
    while len(out):  # fewer than three quarters stay outside each time
        x[out] = _feistel(x[out], half, keys, back)
        out = out[x[out] >= rows]
    return x.astype(np.int64)


def place(row: np.ndarray, rows: int, shards: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Shard and slot of row numbers."""
    p = _walk(row, rows, seed, False)
    return p % shards, p // shards


def row_at(shard: np.ndarray, slot: np.ndarray, rows: int, shards: int, seed: int = 0) -> np.ndarray:
    """The row number that lies in the slot of the shard."""
    return _walk(np.asarray(slot) * shards + np.asarray(shard), rows, seed, True)


def numbered(df: DataFrame, order: list[str], name: str = "row") -> DataFrame:
    """Adds global row numbers from 0 in the order of the columns, equal rows in any order.

    Ranges of the order are dealt out to tasks; a position in its range and the rows before the range make the number. A
    task's own position breaks ties, so that equal keys spread over several ranges.
    """
    spark = df.sparkSession
    tie, part, at, n, before = free(df, "tie", "part", "at", "n", "before")
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.withColumn(tie, F.monotonically_increasing_id())
    dealt = dealt.repartitionByRange(tasks, *order, tie).sortWithinPartitions(*order, tie)
    dealt = cut(dealt.withColumns({part: F.spark_partition_id(), at: F.monotonically_increasing_id()}))
    sizes = dealt.groupBy(part).agg(F.count("*").alias(n))
    rank = sizes.withColumn(before, F.sum(n).over(Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)))
    rank = rank.select(part, F.coalesce(before, F.lit(0)).alias(before))  # a row for each task: small by construction
    within = F.col(at).bitwiseAND(F.lit((1 << 33) - 1))
    return dealt.join(F.broadcast(rank), part).withColumn(name, F.col(before) + within).drop(tie, part, at, before)


def assign(df: DataFrame, order: list[str], shards: int = 16, seed: int = 0) -> DataFrame:
    """Adds row, shard (0 to shards - 1) and slot; the table should be narrow, it is sorted as a whole."""
    rows = df.count()

    @F.pandas_udf("struct<shard:int,slot:long>")
    def spot(row: pd.Series) -> pd.DataFrame:
        shard, slot = place(row.to_numpy(), rows, shards, seed)
        return pd.DataFrame({"shard": shard.astype(np.int32), "slot": slot})

    (got,) = free(df, "spot")
    out = numbered(df, order).withColumn(got, spot("row"))
    return out.withColumns({"shard": F.col(got)["shard"], "slot": F.col(got)["slot"]}).drop(got)
