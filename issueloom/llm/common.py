"""Small helpers of the operators: free column names, text columns, parts of a table that hold few rows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def free(df: DataFrame, *names: str) -> list[str]:
    """Column names like the given ones that the table does not have yet."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def small_batches(spark: SparkSession, rows: int = 2000) -> None:
    """Let at most `rows` rows travel to a Python worker at once from now on: whole texts and what is made of them then take
    little of its memory. A session that asks for smaller batches keeps them."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(name)) > rows or int(spark.conf.get(name)) <= 0:
        spark.conf.set(name, rows)


def whole(text: str) -> Column:
    """The text, empty where null."""
    return F.coalesce(F.col(text), F.lit(""))


def text_crc32(column) -> Column:
    """crc32 of the value as text; null for null."""
    return F.crc32(F.col(column).cast("string").cast("binary"))


def utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of an Arrow string array one after the other, and the offset of each text."""
    texts = texts.cast(pa.large_binary())
    bufs = texts.buffers()
    offsets = np.frombuffer(bufs[1], np.int64, len(texts) + 1, texts.offset * 8)
    data = np.frombuffer(bufs[2], np.uint8) if bufs[2] is not None else np.zeros(0, np.uint8)
    return data, offsets


def runs(offsets: np.ndarray, size: int, rows: int = 1 << 30) -> Iterator[tuple[int, int]]:
    """Consecutive texts of about `size` bytes together, one at least."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = min(max(i + 1, int(np.searchsorted(offsets, offsets[i] + size, "right")) - 1), i + rows, n)
        yield i, j
        i = j


def unsigned(values) -> np.ndarray:
    return np.asarray(values, np.int64).view(np.uint64)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit (splitmix64's finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))
