"""Vector expressions on ARRAY<FLOAT> columns."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, functions as F, types as T

from .text import col


def dot(a, b) -> Column:
    return F.aggregate(
        F.zip_with(col(a), col(b), lambda x, y: x.cast("double") * y.cast("double")),
        F.lit(0.0),
        lambda s, x: s + x,
    )


def norm(a) -> Column:
    return F.sqrt(dot(a, a))


def unit(a) -> Column:
    n = F.greatest(norm(a), F.lit(1e-12))
    return F.transform(col(a), lambda x: x.cast("double") / n)


def cosine(a, b) -> Column:
    """0 when one side has no length."""
    length = norm(a) * norm(b)
    return F.when(length == 0, F.lit(0.0)).otherwise(dot(a, b) / length)


def as_float(a) -> Column:
    return col(a).cast("array<float>")


def _halves(vectors: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All values as half-precision numbers, rounded to the nearest, ties to even; and where each vector starts."""
    values = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float16)
    return values, np.concatenate([[0], np.cumsum(np.diff(vectors.offsets.to_numpy()))])


@F.arrow_udf(T.BinaryType())
def to_half(vectors: pa.Array) -> pa.Array:
    """Two bytes a value, little-endian; null for null."""
    values, at = _halves(vectors)
    data = values.astype("<f2").tobytes()
    whole = pa.Array.from_buffers(pa.large_binary(), len(vectors), [None, pa.py_buffer((at * 2).astype(np.int64).tobytes()), pa.py_buffer(data)])
    return pc.if_else(vectors.is_valid(), whole, pa.scalar(None, pa.large_binary())).cast(pa.binary())


@F.arrow_udf(T.ArrayType(T.FloatType()))
def from_half(packed: pa.Array) -> pa.Array:
    """Vectors of two-byte values."""
    sizes = pc.fill_null(pc.binary_length(packed), 0).to_numpy(zero_copy_only=False) // 2
    data = b"".join(x.as_py() or b"" for x in packed)
    offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
    lists = pa.ListArray.from_arrays(offsets, pa.array(np.frombuffer(data, "<f2").astype(np.float32)))
    return pc.if_else(packed.is_valid(), lists, pa.scalar(None, lists.type))


@F.arrow_udf(T.ArrayType(T.FloatType()))
def half_precision(vectors: pa.Array) -> pa.Array:
    """Vectors as they come back from two-byte storage."""
    values, at = _halves(vectors)
    lists = pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(values.astype(np.float32)))
    return pc.if_else(vectors.is_valid(), lists, pa.scalar(None, lists.type))


def dense(column) -> np.ndarray:
    """Arrow list column to a dense matrix of its own type without a Python loop."""
    flat = pa.chunked_array(column).combine_chunks() if isinstance(column, list) else column.combine_chunks()
    if isinstance(flat, pa.ChunkedArray):
        flat = pa.concat_arrays(flat.chunks)
    values = flat.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(flat), -1)


def matrix(column) -> np.ndarray:
    """Arrow list column to a dense float64 matrix without a Python loop."""
    return dense(column).astype(np.float64)
