"""Choice of the joining threshold on labelled pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from ..functions.vectors import cosine
from ..settings import Settings
from .embed import text_vectors


def pair_similarities(pairs: DataFrame) -> DataFrame:
    return pairs.withColumn("sim", cosine("vec_a", "vec_b"))


def text_pairs(pairs: DataFrame, s: Settings, embed=None) -> DataFrame:
    """Labelled text pairs (a, b, same) with the vectors of both sides; a pair stays one row, so no text travels for it."""
    for name in ("a", "b"):
        other = [c for c in pairs.columns if c != name]
        rows = pairs.select(*other, F.col(name).alias("title"), F.lit("").alias("lead"))
        pairs = text_vectors(rows, s, embed).select(*other, F.col("title").alias(name), F.col("vec").alias(f"vec_{name}"))
    return pairs


def evaluate(pairs: DataFrame, s: Settings, embed=None, low: float = 0.72, high: float = 0.90, step: float = 0.02) -> DataFrame:
    """The sweep over labelled texts (pair, a, b, same)."""
    return sweep(pair_similarities(text_pairs(pairs, s, embed)), low, high, step)


def steps_of(low: float, high: float, step: float) -> list[float]:
    """low, low + step, ... up to high, the end included."""
    out, n = [], 0
    while low + n * step <= high + 1e-9:
        out.append(low + n * step)
        n += 1
    return out


def sweep(pairs: DataFrame, low: float = 0.72, high: float = 0.90, step: float = 0.02) -> DataFrame:
    """(tau, tp, fp, fn, precision, recall, f1) per threshold from (sim, same).

    Each pair adds to one counter, the highest threshold it passes; a running sum over the few thresholds does
    the rest, so the table is read once and never multiplied.
    """
    taus = steps_of(low, high, step)
    passed = sum(((F.col("sim") >= t).cast("int") for t in taus[1:]), (F.col("sim") >= taus[0]).cast("int"))
    counts = pairs.select(passed.alias("passed"), "same").groupBy("passed").agg(
        F.count_if("same").alias("pos"), F.count_if(~F.col("same")).alias("neg")
    )
    # pairs below all thresholds have a row of their own, so the counts are read once
    grid = pairs.sparkSession.createDataFrame([(0, None)] + [(i + 1, float(t)) for i, t in enumerate(taus)], "passed int, tau double")
    levels = grid.join(counts, "passed", "left").fillna(0, ["pos", "neg"])
    above = W.partitionBy(F.lit(0)).orderBy(F.col("passed").desc())
    everything = W.partitionBy(F.lit(0))
    rows = levels.select(
        "tau", F.sum("pos").over(above).alias("tp"), F.sum("neg").over(above).alias("fp"),
        F.sum("pos").over(everything).alias("total"),
    ).filter(F.col("tau").isNotNull()).withColumn("fn", F.col("total") - F.col("tp"))
    rows = rows.withColumn("p", F.coalesce(F.try_divide("tp", F.col("tp") + F.col("fp")), F.lit(0.0))).withColumn(
        "r", F.coalesce(F.try_divide("tp", F.col("tp") + F.col("fn")), F.lit(0.0))
    )
    f1 = F.coalesce(F.try_divide(2 * F.col("p") * F.col("r"), F.col("p") + F.col("r")), F.lit(0.0))
    return rows.select(
        F.round("tau", 3).alias("tau"), "tp", "fp", "fn", F.round("p", 3).alias("precision"),
        F.round("r", 3).alias("recall"), F.round(f1, 3).alias("f1"),
    )


def best_tau(table: DataFrame) -> DataFrame:
    best = F.max_by(F.struct(*table.columns), F.struct("f1", "tau")).alias("b")
    return table.agg(best).select("b.*")
