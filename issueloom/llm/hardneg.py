"""Hard negatives by Kronecker-packed integer products.

Components become floor(scale * x). A bias makes all components of candidates positive, another one those of anchors. The
biased components of several candidates then stand side by side in the fields of one wide integer, a field being wide enough
for the largest biased sum, so one product of an anchor's component with the word counts for all of them, no carry crosses
a field, and the fields of the summed words are the exact scores plus known sums. The field width comes from the table's
own lengths and sums (Cauchy-Schwarz); fields beyond 64 bits use integers of any width.

Candidates are dealt into blocks ordered by label, anchors into blocks as well. Blocks of both sides meet in groups of fixed size:
an anchor block is copied once for each candidate group and the other way round, which is a stated query set against all
rows, and no group holds more than its blocks however many rows share a label or a vector. A first pass finds the positives of
each anchor and skips blocks without its labels; the second pass, which knows each positive's score, takes the best rows of
other labels in its window and skips blocks of its label alone. Each group gives its best, merged by rank.

Rows whose label or vector is null, or whose vector holds null or non-finite components, take no part. Shorter vectors count as
padded with zeros. Keys may be null (last among equal scores) or repeat: a row is not its own positive, another row
with its key may be. An anchor without positives or a positive without negatives gives no rows; windows of negative
scores are empty as 80 s > 100 s. Empty tables give empty results. Scores must be below 2**62.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import cut

CANDIDATES = 2048  # in a block
ANCHORS = 256  # in a block
GROUP_CANDIDATES = 32  # blocks in a group
GROUP_ANCHORS = 16
TILE = 32  # anchors multiplied at once
LAST = np.iinfo(np.int64).max  # in place of a null key

BLOCK = "rows binary, keys binary, labels binary, words binary, sums binary, lo long, hi long, g int"
HIT = "arow long, anchor long, row long, key long, score long"


def taking_part(df: DataFrame, vector: str, key: Column, label: Column, scale: int) -> DataFrame:
    """(row, key, label, v) with whole components; row is unique."""
    x = F.col(vector)
    sound = x.isNotNull() & label.isNotNull() & ~F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c.cast("double")) == float("inf")))
    v = F.transform(x, lambda c: F.floor(scale * c.cast("double")).cast("long"))
    rows = df.where(F.coalesce(sound, F.lit(False))).select(key.cast("long").alias("key"), label.cast("long").alias("label"), v.alias("v"))
    return cut(rows.select(F.monotonically_increasing_id().alias("row"), "*"))


def matrix(column: pa.Array, size: int) -> np.ndarray:
    """Rows of a list column, padded with zeros."""
    out = np.zeros((len(column), size), np.int64)
    n = np.diff(column.offsets.to_numpy())
    at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    out[np.repeat(np.arange(len(n)), n), at] = column.flatten().to_numpy(zero_copy_only=False)
    return out


class Packing:
    """Biases, width of a field and number of fields for a table."""

    def __init__(self, size: int, lowest: int, longest: float, largest_sum: int):
        self.size, self.bias = size, max(0, -lowest)
        top = int(longest * (1 + 1e-9)) + 2 * self.bias * max(largest_sum, 0) + size * self.bias ** 2 + 1
        self.width = max(top.bit_length(), 1)
        self.fields = max(64 // self.width, 1) if self.width <= 64 else 4
        self.kind = np.uint64 if self.width <= 64 else object

    def pack(self, v: np.ndarray) -> np.ndarray:
        """Words (dimension, word): candidate f * words + w is field f of word w."""
        words = -(-len(v) // self.fields)
        biased = np.zeros((self.fields * words, self.size), np.uint64)
        biased[:len(v)] = (v + self.bias).astype(np.uint64)
        biased = biased.astype(self.kind)
        out = biased[:words].copy()
        for f in range(1, self.fields):
            out += biased[f * words:(f + 1) * words] << self.kind(f * self.width) if self.kind is np.uint64 else biased[f * words:(f + 1) * words] * (1 << f * self.width)
        return np.ascontiguousarray(out.T)

    def scores(self, anchors: np.ndarray, packed: np.ndarray, sums: np.ndarray) -> np.ndarray:
        """Inner products of anchors with the candidates in the words; sums are those of the candidates' components."""
        biased = (anchors + self.bias).astype(np.uint64).astype(self.kind)
        total = biased[:, :1] * packed[:1]
        for d in range(1, self.size):
            total += biased[:, d:d + 1] * packed[d:d + 1]
        if self.kind is np.uint64:
            mask = np.uint64((1 << self.width) - 1)
            parts = [(total >> np.uint64(f * self.width)) & mask for f in range(self.fields)]
            found = np.concatenate(parts, axis=1)[:, :len(sums)].astype(np.int64)
        else:
            mask = (1 << self.width) - 1
            parts = [(total // (1 << f * self.width)) % (mask + 1) for f in range(self.fields)]
            found = np.concatenate(parts, axis=1)[:, :len(sums)]
        known = self.bias * (anchors.sum(1)[:, None] + sums[None]) + self.size * self.bias ** 2
        return (found - known).astype(np.int64)

    def read(self, words: bytes, n: int) -> np.ndarray:
        """Packed words of a block of n candidates as they were written."""
        if self.kind is np.uint64:
            return np.frombuffer(words, np.uint64).reshape(self.size, -1)
        return self.pack(np.frombuffer(words, np.int64).reshape(n, self.size))

    def write(self, v: np.ndarray) -> bytes:
        return (self.pack(v) if self.kind is np.uint64 else np.ascontiguousarray(v)).tobytes()


def blocks(rows: DataFrame, packing: Packing | None, size: int, most: int) -> DataFrame:
    """Blocks of at most `most` rows in the order given; words are packed, or plain components without a packing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, most):
                part = batch.slice(a, most)
                v, label = matrix(part["v"], size), part["label"].to_numpy()
                yield pa.RecordBatch.from_pydict({
                    "rows": pa.array([part["row"].to_numpy().tobytes()]), "keys": pa.array([part["key"].fill_null(LAST).to_numpy().tobytes()]),
                    "labels": pa.array([label.tobytes()]), "words": pa.array([packing.write(v) if packing else v.tobytes()], pa.binary()),
                    "sums": pa.array([v.sum(1).tobytes()]), "lo": pa.array([int(label.min())]), "hi": pa.array([int(label.max())])})

    return rows.mapInArrow(run, BLOCK.rsplit(",", 1)[0])


def numbered(some: DataFrame, each: int) -> tuple[DataFrame, int]:
    """Written blocks with a group g of about `each` blocks, and the number of groups."""
    some = cut(some.withColumn("b", F.monotonically_increasing_id()))
    groups = max(1, -(-some.count() // each))
    return some.withColumn("g", F.pmod(F.xxhash64("b"), F.lit(groups)).cast("int")).drop("b"), groups


def best(out: list[tuple], score: np.ndarray, ok: np.ndarray, keys: np.ndarray, rows: np.ndarray, k: int) -> list[tuple[np.ndarray, ...]]:
    """For each row of scores (score, key, row) of the k best where ok, merged with what `out` has."""
    low = -(1 << 62)  # its negative is a long as well
    score = np.where(ok, score, low)
    if score.shape[1] > 4 * k:
        kth = -np.partition(-score, k - 1, axis=1)[:, k - 1:k]
    else:
        kth = np.full((len(score), 1), low)
    for i in range(len(score)):
        at = np.flatnonzero((score[i] >= kth[i]) & ok[i])
        if len(at):
            s, q, r = (np.concatenate(x) for x in zip(out[i], (score[i, at], keys[at], rows[at])))
            order = np.lexsort((r, q, -s))[:k]
            out[i] = (s[order], q[order], r[order])
    return out


EMPTY = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64))


def mine(df: DataFrame, anchors: Column, vector: str = "embedding", key: Column | str = "vec_id", label: Column | str = "label",
         positives: int = 5, negatives: int = 5, low: int = 80, scale: int = 256) -> DataFrame:
    """(anchor, positive, rank, negative, positive_score, negative_score) for each anchor and each of its positives.

    `anchors` is a condition on the column `key`. Positives are an anchor's best other rows of its label; negatives the best
    rows of other labels that satisfy low * positive_score <= 100 * negative_score <= 100 * positive_score.
    """
    spark = df.sparkSession
    none = spark.createDataFrame([], "anchor long, positive long, rank int, negative long, positive_score long, negative_score long")
    key, label = (F.col(c) if isinstance(c, str) else c for c in (key, label))
    rows = taking_part(df, vector, key, label, scale)
    total = F.aggregate("v", F.lit(0).cast("long"), lambda s, c: s + c)
    square = F.aggregate("v", F.lit(0.0), lambda s, c: s + c.cast("double") * c)
    about = rows.agg(F.min(F.array_min("v")).alias("lowest"), F.max(total).alias("sum"), F.max(square).alias("longest"),
                     F.max(F.size("v")).alias("size"), F.count("*").alias("n")).first()
    if not about["n"] or not about["size"]:
        return none
    size = int(about["size"])
    packing = Packing(size, min(int(about["lowest"] or 0), 0), float(about["longest"]), int(about["sum"]))
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartitionByRange(tasks, "label", "row").sortWithinPartitions("label", "row")
    all_blocks, left_groups = numbered(blocks(dealt, packing, size, CANDIDATES), GROUP_CANDIDATES)
    asked = rows.where(anchors).repartitionByRange(max(1, about["n"] // (64 * ANCHORS)), "label", "row").sortWithinPartitions("label", "row")
    right, right_groups = numbered(blocks(asked, None, size, ANCHORS), GROUP_ANCHORS)
    everywhere = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = all_blocks.withColumn("h", everywhere(right_groups))
    right = right.withColumnRenamed("g", "h").withColumn("g", everywhere(left_groups))

    def unpack(block, what=("rows", "keys", "labels", "sums")):
        return tuple(np.frombuffer(getattr(block, c), np.int64) for c in what)

    def tiles(some: pd.DataFrame, others: pd.DataFrame, skip):
        """(anchors' rows, keys, labels, scores, candidates' rows, keys, labels) tile by tile."""
        for c in some.itertuples():
            crow, ckey, clabel, csum = unpack(c)
            words = packing.read(c.words, len(crow))
            for a in others.itertuples():
                if skip(c, a):
                    continue
                arow, akey, alabel, _ = unpack(a)
                v = np.frombuffer(a.words, np.int64).reshape(-1, size)
                for i in range(0, len(v), TILE):
                    t = slice(i, i + TILE)
                    yield a, t, arow[t], akey[t], alabel[t], packing.scores(v[t], words, csum), crow, ckey, clabel

    def hits(found: dict) -> pd.DataFrame:
        cols = {c: [] for c in ("arow", "anchor", "row", "key", "score")}
        for (arow, akey), (s, q, r) in found.items():
            cols["arow"].append(np.full(len(s), arow))
            cols["anchor"].append(np.full(len(s), akey))
            cols["row"].append(r)
            cols["key"].append(q)
            cols["score"].append(s)
        return pd.DataFrame({c: np.concatenate(v).astype(np.int64) if v else np.zeros(0, np.int64) for c, v in cols.items()})

    def same_label(some: pd.DataFrame, others: pd.DataFrame) -> pd.DataFrame:
        found = {}
        for _, _, arow, akey, alabel, score, crow, ckey, clabel in tiles(some, others, lambda c, a: c.hi < a.lo or a.hi < c.lo):
            ok = (alabel[:, None] == clabel[None]) & (arow[:, None] != crow[None])
            names = list(zip(arow.tolist(), akey.tolist()))
            for name, top in zip(names, best([found.get(x, EMPTY) for x in names], score, ok, ckey, crow, positives)):
                found[name] = top
        return hits(found)

    def ranked(part: DataFrame, by: list[str], most: int) -> DataFrame:
        order = Window.partitionBy(*by).orderBy(F.col("score").desc(), "key", "row")
        return part.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)

    first = left.groupBy("g", "h").cogroup(right.groupBy("g", "h")).applyInPandas(same_label, HIT)
    near = cut(ranked(first, ["arow"], positives))
    goals = near.groupBy(F.col("arow").alias("row")).agg(F.sort_array(F.collect_list(F.struct("rank", "score"))).alias("p"))
    goal = F.transform("p", lambda x: x["score"])  # at most `positives` scores
    asked = asked.join(goals.select("row", goal.alias("goal")), "row")

    def with_goals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, ANCHORS):
                part = batch.slice(a, ANCHORS)
                label = part["label"].to_numpy()
                goals = np.full((part.num_rows, positives), -1, np.int64)
                for i, g in enumerate(part["goal"].to_pylist()):
                    goals[i, :len(g)] = g
                v = matrix(part["v"], size)
                yield pa.RecordBatch.from_pydict({
                    "rows": pa.array([part["row"].to_numpy().tobytes()]), "keys": pa.array([part["key"].fill_null(LAST).to_numpy().tobytes()]),
                    "labels": pa.array([label.tobytes()]), "words": pa.array([v.tobytes()]), "sums": pa.array([goals.tobytes()]),
                    "lo": pa.array([int(label.min())]), "hi": pa.array([int(label.max())])})

    aimed, aimed_groups = numbered(asked.sortWithinPartitions("label", "row").mapInArrow(with_goals, BLOCK.rsplit(",", 1)[0]), GROUP_ANCHORS)
    left = all_blocks.withColumn("h", everywhere(aimed_groups))
    aimed = aimed.withColumnRenamed("g", "h").withColumn("g", everywhere(left_groups))

    def other_labels(some: pd.DataFrame, others: pd.DataFrame) -> pd.DataFrame:
        found = {}
        for a, t, arow, akey, alabel, score, crow, ckey, clabel in tiles(some, others, lambda c, a: c.lo == c.hi == a.lo == a.hi):
            goals = np.frombuffer(a.sums, np.int64).reshape(-1, positives)[t]
            differs = alabel[:, None] != clabel[None]
            for p in range(positives):
                goal = goals[:, p:p + 1]
                ok = differs & (score <= goal) & (100 * score >= low * goal) & (goal >= 0)
                names = [(r, q, p) for r, q in zip(arow.tolist(), akey.tolist())]
                for name, top in zip(names, best([found.get(x, EMPTY) for x in names], score, ok, ckey, crow, negatives)):
                    found[name] = top
        parts = [hits({k[:2]: v for k, v in found.items() if k[2] == p}).assign(p=p + 1) for p in range(positives)]
        return pd.concat(parts).astype({"p": "int32"})

    second = left.groupBy("g", "h").cogroup(aimed.groupBy("g", "h")).applyInPandas(other_labels, HIT + ", p int")
    chosen = ranked(second, ["arow", "p"], negatives)
    with_positive = near.select("arow", F.col("rank").alias("p"), F.col("key").alias("positive"), F.col("score").alias("positive_score"))
    out = chosen.join(with_positive, ["arow", "p"])
    shown = lambda c: F.when(F.col(c) != LAST, F.col(c))
    return out.select(shown("anchor").alias("anchor"), shown("positive").alias("positive"), "rank", shown("key").alias("negative"),
                      "positive_score", F.col("score").alias("negative_score"))
