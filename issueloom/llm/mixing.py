"""Mixing sources to target weights by Efraimidis-Spirakis sampling, DataFrame functions only.

Sources share `share` times all words by their weights; a source's target stops at `most` times its words, and what is
above goes to the others by weight until none is above. A source first gives as many complete epochs as fit. The rest is
filled in the order of exponential keys -ln(u) / quality (u from a hash of the document's key), which is a sample without
replacement proportional to quality; prefix sums over that order stop at the target.

Prefix sums run in two steps, over narrow ranges of the keys and within a range, so a source with a third of all rows is
spread over many tasks. Texts are not shuffled.

Null texts have no words; null sources are one source, the last; null keys get one value of u. Equal rows are
interchangeable. Sources without words have target zero. Empty tables give empty results. Reruns agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import cut
from .common import free, whole

WORD = r"[^\x20\x09-\x0D]+"
SPREAD = 4096  # key ranges for each doubling of 1 + key; none has more than about a thousandth of a source


def words(text: str) -> Column:
    return F.regexp_count(whole(text), F.lit(WORD)).cast("long")


def word_length_quality(chars: Column, size: Column) -> Column:
    """1 for six characters a word, less towards very short and very long words, 0.1 at least."""
    mean = chars / F.greatest(size, F.lit(1))
    return F.greatest(F.lit(0.1), 1 - F.abs(mean - 6) / 6)


def sampling_key(key: str, quality: Column, seed: int) -> Column:
    """-ln(u) / quality with u above 0 and below 1, from 52 bits of a hash."""
    digest = F.md5(F.concat(F.lit(f"{seed}|"), F.coalesce(F.col(key).cast("string"), F.lit("null"))))
    u = (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / F.lit(2.0**52)
    return -F.ln(u) / quality


def targets(sizes: DataFrame, weights: list[float], share: float = 1.5, most: float = 2.0) -> DataFrame:
    """(source, source_size, target) from (source, source_size): weights repeat along the sources by code point, null last.

    Sources are capped in the order of their size by weight, so the common level of the others has a closed form.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    rate = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int"))
    rows = sizes.withColumn("w", rate).withColumn("ratio", F.lit(most) * F.col("source_size") / F.col("w"))
    by_ratio = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    before = F.coalesce(F.sum("source_size").over(by_ratio.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rest = F.sum("w").over(by_ratio.rowsBetween(0, Window.unboundedFollowing))
    level = (F.lit(share) * F.sum("source_size").over(Window.partitionBy()) - F.lit(most) * before) / rest
    rows = rows.withColumn("level", level)
    # in the order of the ratios, the first source that its level does not cap sets the level of all that are left
    common = F.first(F.when(F.col("level") <= F.col("ratio"), F.col("level")), ignorenulls=True).over(
        by_ratio.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    goal = F.least(common * F.col("w"), F.lit(most) * F.col("source_size"))
    return rows.withColumn("target", goal).select("source", "source_size", "target")


def plan(df: DataFrame, weights: list[float], text: str = "text", key: str = "doc_id", source: str = "source",
         seed: int = 7, share: float = 1.5, most: float = 2.0) -> DataFrame:
    """(key, source, size, sampling, source_size, target, before, taken): `taken` words come from each row, `before` are
    the words of its source with smaller sampling keys. The last row that fits in part gives the words that fit."""
    sized = df.select(F.col(key).alias("key"), F.col(source).alias("source"), words(text).alias("size"), F.length(whole(text)).alias("chars"))
    sized = sized.withColumn("sampling", sampling_key("key", word_length_quality(F.col("chars"), F.col("size")), seed)).drop("chars")
    sized = cut(sized.withColumn("slice", F.floor(F.log2(1 + F.col("sampling")) * SPREAD)))
    slices = cut(sized.groupBy("source", "slice").agg(F.sum("size").alias("n")))
    along = Window.partitionBy("source").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    slices = slices.withColumn("base", F.coalesce(F.sum("n").over(along), F.lit(0)))
    goal = targets(slices.groupBy("source").agg(F.sum("n").alias("source_size")), weights, share, most)
    bases = cut(slices.join(goal.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of"))).select(
        F.col("source").alias("of"), F.col("slice").alias("at"), "base", "source_size", "target"))
    rows = sized.join(bases, F.col("source").eqNullSafe(F.col("of")) & (F.col("slice") == F.col("at")))
    inside = Window.partitionBy("source", "slice").orderBy("sampling", "key", "size").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("before", F.col("base") + F.coalesce(F.sum("size").over(inside), F.lit(0)))
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0).cast("long"))
    rest = F.floor(F.col("target") - epochs * F.col("source_size"))
    part = F.least(F.col("size"), F.greatest(F.lit(0).cast("long"), rest - F.col("before")))
    rows = rows.withColumn("taken", (epochs * F.col("size") + part).cast("long"))
    return rows.withColumn("epochs", epochs).select("key", "source", "size", "sampling", "source_size", "target", "before", "epochs", "taken")


def mix(df: DataFrame, weights: list[float], text: str = "text", key: str = "doc_id", source: str = "source", seed: int = 7,
        share: float = 1.5, most: float = 2.0) -> DataFrame:
    """The rows of the mix with all columns, whole and repeated by epoch; a row that fits in part stays if over half fits.

    A source's choice is one bound on the sampling key, so rows are judged where they are; only the bounds travel.
    """
    rows = plan(df, weights, text, key, source, seed, share, most)
    fits = F.col("before") + F.col("size") / 2 < F.col("target") - F.col("epochs") * F.col("source_size")
    of, epochs, bound, sampling, again = free(df, "of", "epochs", "bound", "sampling", "again")
    bounds = cut(rows.groupBy(F.col("source").alias(of)).agg(F.first("epochs").alias(epochs), F.max(F.when(fits, F.col("sampling"))).alias(bound)))
    judged = df.withColumn(sampling, sampling_key(key, word_length_quality(F.length(whole(text)), words(text)), seed))
    judged = judged.join(bounds, F.col(source).eqNullSafe(F.col(of)))
    copies = F.col(epochs) + F.coalesce((F.col(sampling) <= F.col(bound)).cast("long"), F.lit(0))
    judged = judged.withColumn(again, F.explode(F.sequence(F.lit(0).cast("long"), copies))).where(F.col(again) > 0)
    return judged.select(*df.columns)
