"""Whitening of vectors through Golub-Kahan-Lanczos bidiagonalisation of the centred rows.

Entries become integers, floor(scale * c) + shift, so sums and deviations are exact. Rows are packed into blocks of whole
numbers around the mean. A step takes the products of the centred rows X with a right vector, u = Xv, and with what came
out, X'u, block by block in one pass, and Spark adds the blocks' parts by dimension. What reaches the driver is two vectors
of one entry a dimension for each step, whatever the number of rows.

A left vector is kept as the combination w of columns that makes it, u = Xw, so a lost executor computes its part again and no
table of left vectors is written; its products with earlier left vectors follow from X'u, and both sides are orthogonalised
against all earlier vectors twice. When a left or right vector vanishes, the next one starts anew, orthogonal to all; as
many steps as dimensions are taken, so repeated deviations are found too. The singular value decomposition of the small
bidiagonal matrix gives components and deviations.

Vectors that are null or hold null or non-finite entries take no part; shorter vectors count as padded with zeros before the
scaling. Directions without spread, up to rounding, are no components, so constant rows give no rows and an empty table an empty
result. Repeated rows count each. The deviation is a long where all deviations provably fit one, else decimal(38,0). Keys
may be null or repeat; other columns are not returned.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..session import cut

BLOCK = 4096  # rows
RANK = 1e-12  # of the largest variance: less counts as none


def integers(vector: str, scale: int, shift: int, size: int) -> Column:
    """Whole numbers of a vector, padded to the size."""
    x = F.concat(F.col(vector), F.array_repeat(F.lit(0.0), F.lit(size) - F.size(vector)))
    return F.transform(x, lambda c: F.floor(scale * c.cast("double")) + shift)


def _rows(x: pa.Array, size: int) -> np.ndarray:
    return x.flatten().to_numpy(zero_copy_only=False).reshape(-1, size)


class Fit:
    """Centre, components (rows), variances, and the exact sums of a table."""

    def __init__(self, n: int, sums: list[int], components: np.ndarray, variances: np.ndarray, trace: float):
        self.n, self.sums, self.components, self.variances, self.trace = n, sums, components, variances, trace
        self.base = [s // n for s in sums]  # whole part of the mean
        self.rest = np.array([(s % n) / n for s in sums])

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - np.array(self.base)) - self.rest


def _added(blocks: DataFrame, part, size: int) -> np.ndarray:
    """Sum over blocks of the vectors that `part` makes of each centred block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for raw in batch["block"]:
                one = part(np.frombuffer(raw.as_buffer(), np.int32).astype(np.float64))
                total = one if total is None else total + one
        if total is not None:
            yield pa.RecordBatch.from_pydict({"i": pa.array(np.arange(len(total), dtype=np.int32)), "v": pa.array(total)})

    out = np.zeros(size)
    for r in blocks.mapInArrow(run, "i int, v double").groupBy("i").agg(F.sum("v").alias("v")).collect():  # a row a dimension
        out[r["i"]] = r["v"]
    return out


def _without(v: np.ndarray, basis: list[np.ndarray]) -> np.ndarray:
    for _ in range(2):
        for b in basis:
            v = v - (b @ v) * b
    return v


def bidiagonal(product, size: int, scale: float, steps: int, seed: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Right vectors (rows) and the upper bidiagonal matrix; product(w) is X'Xw, scale the size of X'X."""
    rng = np.random.default_rng(seed)
    small = (RANK * scale) ** 0.5
    right: list[np.ndarray] = []
    left: list[tuple[np.ndarray, np.ndarray]] = []  # (w, X'Xw) of each left vector Xw
    alphas, betas = [], []

    def fresh() -> np.ndarray:
        v = _without(rng.standard_normal(size), right)
        return v / np.linalg.norm(v)

    v, beta = fresh(), 0.0
    for j in range(steps):
        right.append(v)
        w = v - beta * left[-1][0] if left and beta else v.copy()
        g = product(w)
        for _ in range(2):
            for b, gb in left:
                c = b @ g
                w, g = w - c * b, g - c * gb
        alpha = float(max(w @ g, 0.0)) ** 0.5
        if alpha > small:
            w, g = w / alpha, g / alpha
        else:
            alpha, w, g = 0.0, np.zeros(size), np.zeros(size)
        left.append((w, g))
        alphas.append(alpha)
        if j + 1 == steps:
            break
        v = _without(g - alpha * right[-1], right)
        beta = float(np.linalg.norm(v))
        if beta > small:
            v = v / beta
        else:
            v, beta = fresh(), 0.0
        betas.append(beta)
    return np.array(right), np.diag(alphas) + np.diag(betas, 1)


def fit(rows: DataFrame, size: int, components: int) -> tuple[Fit, DataFrame] | None:
    """Fit of rows (x: array<long> of the size), and their blocks; None for no rows."""
    entry = rows.select(F.posexplode("x").alias("i", "c"))
    wide = F.col("c").cast("decimal(19,0)")
    stats = entry.groupBy("i").agg(F.count("*").alias("n"), F.sum(wide).alias("s"), F.sum((wide * wide).cast("decimal(38,0)")).alias("q"),
                                   F.min("c").alias("lo"), F.max("c").alias("hi")).orderBy("i").collect()  # a row a dimension
    if not stats:
        return None
    n, sums = stats[0]["n"], [int(r["s"]) for r in stats]
    trace = sum(int(r["q"]) * n - s * s for r, s in zip(stats, sums)) / n ** 2
    model = Fit(n, sums, np.zeros((0, size)), np.zeros(0), trace)
    far = [max(abs(n * r["lo"] - s), abs(n * r["hi"] - s)) for r, s in zip(stats, sums)]
    model.fits_long = sum(f * f for f in far) < 2 ** 62
    if max(max(abs(r["lo"] - b), abs(r["hi"] - b)) for r, b in zip(stats, model.base)) >= 2 ** 31:
        raise ValueError("entries spread over more than 32 bits")
    base, rest = np.array(model.base), model.rest

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = (_rows(batch["x"], size) - base).astype(np.int32)
            yield pa.RecordBatch.from_pydict({"block": pa.array([x[i:i + BLOCK].tobytes() for i in range(0, len(x), BLOCK)], pa.binary())})

    blocks = cut(rows.select("x").mapInArrow(pack, "block binary"))

    def product(w: np.ndarray) -> np.ndarray:
        def part(flat: np.ndarray) -> np.ndarray:
            x = flat.reshape(-1, size) - rest
            return x.T @ (x @ w)

        return _added(blocks, part, size)

    right, b = bidiagonal(product, size, trace * n, size)
    _, s, turned = np.linalg.svd(b)
    keep = [i for i in range(min(components, size)) if s[i] ** 2 > RANK * max(trace * n, 1e-300)]
    vectors = turned[keep] @ right
    model.components = vectors / np.linalg.norm(vectors, axis=1, keepdims=True) if len(keep) else vectors
    model.variances = s[keep] ** 2 / n
    return model, blocks


def whitener(model: Fit) -> np.ndarray:
    """Columns that turn centred rows into whitened ones."""
    return model.components.T / np.sqrt(model.variances)


def identity_error(model: Fit, blocks: DataFrame) -> float:
    """Largest entry of the whitened rows' covariance minus the identity."""
    size, k, turn = len(model.base), len(model.variances), whitener(model)
    rest = model.rest

    def part(flat: np.ndarray) -> np.ndarray:
        y = (flat.reshape(-1, size) - rest) @ turn
        return np.concatenate([y.sum(0), (y.T @ y).ravel()])

    total = _added(blocks, part, k + k * k) / model.n
    mean, square = total[:k], total[k:].reshape(k, k)
    return float(np.abs(square - np.outer(mean, mean) - np.eye(k)).max()) if k else 0.0


def whiten(df: DataFrame, vector: str = "embedding", key: str = "vec_id", components: int = 8, scale: int = 1024, shift: int = 100_000) -> DataFrame:
    """(key, component, n, deviation, whitened, explained, identity_error) for each row that takes part and each component.

    deviation is the row's sum over dimensions of (n x - S)^2, exact; explained the component's share of the total variance.
    """
    spark = df.sparkSession
    c = F.col(vector)
    sound = c.isNotNull() & ~F.exists(c, lambda e: e.isNull() | F.isnan(e) | (F.abs(e.cast("double")) == float("inf")))
    taken = df.where(F.coalesce(sound, F.lit(False)))
    size = taken.agg(F.max(F.size(c)).alias("d")).first()["d"]
    none = "key long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if not size:
        return spark.createDataFrame([], none)
    rows = cut(taken.select(F.col(key).alias("key"), integers(vector, scale, shift, size).alias("x")))
    model, blocks = fit(rows, size, components)
    error, turn, n = identity_error(model, blocks), whitener(model), model.n
    sums, base, rest, fits_long = model.sums, np.array(model.base), model.rest, model.fits_long
    kind, arrow = ("long", pa.int64()) if fits_long else ("decimal(38,0)", pa.decimal128(38, 0))

    @F.arrow_udf(f"struct<deviation: {kind}, whitened: array<double>>")
    def turned(x: pa.Array) -> pa.Array:
        x = _rows(x, size)
        y = ((x - base) - rest) @ turn
        if fits_long:
            away = n * x - np.array(sums)
            deviation = pa.array((away * away).sum(1))
        else:
            away = n * x.astype(object) - np.array(sums, object)
            deviation = pa.array([int(v) for v in (away * away).sum(1)], arrow)
        lists = pa.ListArray.from_arrays(np.arange(0, y.size + 1, max(y.shape[1], 1), dtype=np.int32)[:len(y) + 1] if y.shape[1] else np.zeros(len(y) + 1, np.int32), y.ravel())
        return pa.StructArray.from_arrays([deviation, lists], ["deviation", "whitened"])

    shares = F.array(*[F.lit(float(e / model.trace)) for e in model.variances]) if len(model.variances) else F.array().cast("array<double>")
    out = rows.select("key", turned("x").alias("t")).select("key", "t.deviation", F.posexplode("t.whitened").alias("i", "whitened"))
    return out.select("key", (F.col("i") + 1).alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened",
                      F.element_at(shares, F.col("i") + 1).alias("explained"), F.lit(error).alias("identity_error"))
