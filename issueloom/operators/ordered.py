"""Order-dependent building blocks that never put a whole key into one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

# WindowGroupLimit prunes on the map side up to this many rows per group
# (spark.sql.optimizer.windowGroupLimitThreshold); beyond it a salted first stage does the same.
MAP_SIDE_LIMIT = 1000


def top_n(df: DataFrame, keys: list[str], order: list[Column], n: int, rank: str = "rn", salts: int = 64) -> DataFrame:
    """First n rows per key, with their rank.

    The rank filter is pushed below the shuffle, so each map task ships at most n rows per key and a key
    that holds a third of the table costs the same as any other.
    """
    if n > MAP_SIDE_LIMIT:
        spread = df.withColumn("_salt", F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), F.lit(salts)))
        first = W.partitionBy(*keys, "_salt").orderBy(*order)
        df = spread.withColumn("_r", F.row_number().over(first)).filter(F.col("_r") <= n).drop("_r", "_salt")
    window = W.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).filter(F.col(rank) <= n)


def latest_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    return top_n(df, keys, order, 1, "_rn").drop("_rn")


def with_previous(
    df: DataFrame, key: str, ts: str, tie: str, columns: list[str], unit: str = "minute", prefix: str = "prev_"
) -> DataFrame:
    """Each row with the values of the row before it in its series, ordered by (ts, tie).

    A series may hold a third of all rows, so the window runs per (series, time slice). Only the first row of
    a slice needs the slice before it; those come from one small row per slice.
    """
    names = [f"{prefix}{c}" for c in columns]
    sliced = df.withColumn("_slice", F.date_trunc(unit, F.col(ts)))
    inner = W.partitionBy(key, "_slice").orderBy(ts, tie)
    rows = sliced.withColumn("_first", F.row_number().over(inner) == 1).withColumn(
        "_inner", F.lag(F.struct(*columns)).over(inner)
    )
    tails = sliced.groupBy(key, "_slice").agg(
        F.max_by(F.struct(*columns), F.struct(ts, tie)).alias("_tail")
    )
    carried = tails.select(
        key, "_slice", F.lag("_tail").over(W.partitionBy(key).orderBy("_slice")).alias("_carried")
    )
    joined = rows.join(carried, [key, "_slice"], "left")
    value = F.when(F.col("_first"), F.col("_carried")).otherwise(F.col("_inner"))
    out = joined.withColumn("_prev", value)
    for c, name in zip(columns, names):
        out = out.withColumn(name, F.col(f"_prev.{c}"))
    return out.drop("_slice", "_first", "_inner", "_carried", "_prev")


def with_rank(
    df: DataFrame, key: str, ts: str, tie: str, unit: str = "day", rank: str = "rank", size: str = "size"
) -> DataFrame:
    """Rank by (ts descending, tie ascending) within the key, and the size of the key, for any key size.

    Rows are counted per (key, time slice); the slices before a row give its offset.
    """
    sliced = df.withColumn("_slice", F.date_trunc(unit, F.col(ts)))
    counts = sliced.groupBy(key, "_slice").agg(F.count(F.lit(1)).alias("_n"))
    later = W.partitionBy(key).orderBy(F.col("_slice").desc_nulls_last())
    offsets = counts.select(
        key,
        "_slice",
        (F.sum("_n").over(later) - F.col("_n")).alias("_offset"),
        F.sum("_n").over(W.partitionBy(key)).alias(size),
    )
    inner = W.partitionBy(key, "_slice").orderBy(F.col(ts).desc_nulls_last(), F.col(tie))
    ranked = sliced.withColumn("_inner", F.row_number().over(inner))
    same = F.col(f"a.{key}").eqNullSafe(F.col(f"b.{key}")) & F.col("a._slice").eqNullSafe(F.col("b._slice"))
    return (
        ranked.alias("a")
        .join(offsets.alias("b"), same, "left")
        .select("a.*", (F.col("_offset") + F.col("_inner")).alias(rank), F.col(f"b.{size}").alias(size))
        .drop("_slice", "_inner")
    )


def spread_join(
    big: DataFrame, small: DataFrame, on: list[str], how: str, spread_by: list[str], salts: int = 16
) -> DataFrame:
    """Join a side with hot keys to a narrow side that is unique per key.

    The narrow side is repeated once per salt, so a hot key of the big side runs in `salts` tasks. Size estimates
    do not see the repetition, so the join is a merge join, never a broadcast.
    """
    salted = big.withColumn("_salt", F.pmod(F.xxhash64(*spread_by), F.lit(salts)).cast("int"))
    repeated = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))).hint("merge")
    return salted.join(repeated, [*on, "_salt"], how).drop("_salt")
