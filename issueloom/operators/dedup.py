"""Exact and near duplicates, and the counts that depend on them."""

from __future__ import annotations

import difflib
import itertools

import pandas as pd
from pyspark.sql import Column, DataFrame, Window as W, functions as F, types as T

from ..functions.simhash import hamming
from ..session import cut
from .ordered import latest_per_key, spread_join

NO_TIME = -(2**40)  # slice of rows without a time
ANY_TIME = NO_TIME - 1  # stands for "all slices" of one hash


def first_by_id(df: DataFrame, id_col: str, order: list[Column]) -> DataFrame:
    """Exact duplicates: the first row of each id stays."""
    return latest_per_key(df, [id_col], order)


def new_only(df: DataFrame, known: DataFrame, key: str) -> DataFrame:
    return df.join(known.select(key).distinct(), key, "left_anti")


def _bands(value: Column, blocks: int, k: int, of: int = 64, shift: int = 0) -> list[Column]:
    """Keys of which at least one agrees for any two values at distance <= k: all choices of blocks - k blocks."""
    edges = [shift + of * i // blocks for i in range(blocks + 1)]

    def part(low: int, high: int) -> Column:
        return F.shiftrightunsigned(value, low).bitwiseAND(F.lit((1 << (high - low)) - 1))

    keys = []
    for number, chosen in enumerate(itertools.combinations(range(blocks), blocks - k)):
        packed = F.lit(0).cast("long")
        for b in chosen:
            packed = F.shiftleft(packed, edges[b + 1] - edges[b]).bitwiseOR(part(edges[b], edges[b + 1]))
        keys.append(F.struct(F.lit(number).alias("band"), packed.alias("val")))
    return keys


def _banded(groups: DataFrame, value: str, k: int, blocks: int) -> DataFrame:
    return groups.withColumn("_b", F.explode(F.array(*_bands(F.col(value), blocks, k)))).select(
        *groups.columns, F.col("_b.band").alias("band"), F.col("_b.val").alias("val")
    )


def hot_bands(values: DataFrame, value: str, k: int, blocks: int, hot_limit: int = 2_000) -> DataFrame:
    """Band values shared by more than hot_limit distinct hashes."""
    rows = _banded(values.select(value).distinct(), value, k, blocks)
    return (
        rows.groupBy("band", "val").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > hot_limit)
        .select("band", "val", F.lit(True).alias("_hot"))
    )


def band_rows(groups: DataFrame, value: str, k: int, blocks: int, hot: DataFrame) -> DataFrame:
    """One row per (hash, band). A hot band value is split once more.

    Splitting is exact: two hashes within distance k agree on at least one of k + 1 quarters of the word, so
    rows of a hot band value repeat once per quarter and meet only where a quarter agrees as well. Both sides of
    a join take the same list of hot values.
    """
    rows = _banded(groups, value, k, blocks)
    quarters = F.array(*_bands(F.col(value), k + 1, k))
    whole = F.array(F.struct(F.lit(-1).alias("band"), F.lit(0).cast("long").alias("val")))
    return (
        rows.join(hot, ["band", "val"], "left")
        .withColumn("_s", F.explode(F.when(F.col("_hot"), quarters).otherwise(whole)))
        .select(*groups.columns, "band", "val", F.col("_s.band").alias("sub"), F.col("_s.val").alias("subval"))
    )


BAND_KEYS = ["band", "val", "sub", "subval"]


PARTS = 32  # of a time slice


def _reached(open_: DataFrame, rows: DataFrame, seconds: float) -> DataFrame:
    """(o) of the questions (po, pt, h, slice, side) which some row of group (h, slice) answers: one before po in the order,
    and no further than `seconds` from pt. The slice lies on one side of pt, so only one end of the window cuts it.

    Rows of one time count as their first. A slice is cut into parts: in those beyond the bound every row is near enough, so
    their first row decides; in the part that holds the bound, points and questions are sorted together by the order, and
    the farthest time so far answers.
    """
    width = F.lit(seconds / PARTS)
    part = lambda t: F.greatest(F.lit(0), F.least(F.lit(PARTS - 1), F.floor((t - F.col("slice") * seconds) / width))).cast("int")
    asked = open_.select("h", "slice").distinct()
    points = rows.join(asked.hint("merge"), ["h", "slice"], "left_semi").groupBy("h", "slice", "t").agg(F.min("o").alias("o"))
    points = cut(points.withColumn("part", part(F.col("t"))))
    firsts = points.groupBy("h", "slice", "part").agg(F.min("o").alias("o"))
    firsts = firsts.groupBy("h", "slice").agg(F.collect_list(F.struct("part", "o")).alias("firsts"))  # at most PARTS
    known = spread_join(open_, firsts, ["h", "slice"], "inner", ["po"])
    known = known.withColumn("bound", F.col("pt") + F.col("side") * seconds).withColumn("part", part(F.col("bound")))
    beyond = lambda e: (F.signum(F.col("part") - e["part"]) == F.col("side")) & (e["o"] < F.col("po"))
    known = cut(known.select("h", "slice", "part", "po", "side", "bound", F.exists("firsts", beyond).alias("sure"),
                             F.exists("firsts", lambda e: (e["part"] == F.col("part")) & (e["o"] < F.col("po"))).alias("maybe")))
    doubt = known.filter(~F.col("sure") & F.col("maybe")).select("h", "slice", "part", "side", F.col("po").alias("o"), F.lit(None).cast("double").alias("t"), "bound")
    sides = F.explode(F.array(F.lit(-1), F.lit(1)))
    both = points.select("h", "slice", "part", sides.alias("side"), "o", "t", F.lit(None).cast("double").alias("bound")).unionByName(doubt)
    before = W.partitionBy("h", "slice", "part", "side").orderBy("o").rowsBetween(W.unboundedPreceding, W.currentRow)
    told = both.withColumn("far", F.when(F.col("side") < 0, F.max("t").over(before)).otherwise(-F.min("t").over(before)))
    answered = told.filter(F.col("bound").isNotNull() & (F.col("far") >= -F.col("side") * F.col("bound"))).select("o")
    return known.filter("sure").select(F.col("po").alias("o")).unionByName(answered).distinct()


def mark_near_duplicates(
    df: DataFrame,
    hash_col: str,
    order_col: str,
    time_col: str | None = None,
    k: int = 3,
    window_h: int = 48,
    blocks: int | None = None,
    hot_limit: int = 2_000,
    asked: Column | None = None,
) -> DataFrame:
    """Add `is_dup`: some row before this one in `order_col` has a hash within k bits, and the two times are at
    most window_h apart or one of them is missing. `order_col` must be unique.

    `blocks` trades copies for candidates: with 4 blocks a hash is sent 4 times under 16-bit keys, with 5 blocks 10
    times under 25-bit keys, with 6 blocks 20 times under 32-bit keys. Left open, the largest slice decides.

    `asked`, a condition on the order as column `o`, names the rows that need an answer; the others, which must come first in the
    order, are only met by them and get true.

    1. Rows collapse to groups (hash, time slice of one window). Only the first row of a group can be free of a
       duplicate inside its own group, all later ones are marked without any pair.
    2. The first rows look for earlier groups in the own and the neighbouring slices through band keys.
    3. A neighbouring group whose first row is earlier but too far in time is decided on its later rows, by an as-of
       search: nothing is paired, each open question travels once.
    """
    usable = df.filter(F.col(hash_col).isNotNull())
    seconds = F.lit(window_h * 3600)
    if time_col is None:
        clock = F.lit(None).cast("double")
    else:
        clock = F.col(time_col).cast("timestamp").cast("double")
    rows = usable.select(F.col(hash_col).alias("h"), F.col(order_col).alias("o"), clock.alias("t")).withColumn(
        "slice", F.coalesce(F.floor(F.col("t") / seconds).cast("long"), F.lit(NO_TIME))
    )
    groups = rows.groupBy("h", "slice").agg(F.min(F.struct("o", "t")).alias("m"))
    # five branches below read the groups, so they are written once
    groups = cut(groups.select("h", "slice", F.col("m.o").alias("o"), F.col("m.t").alias("t")))
    # a group that starts with a row that needs no answer marks its later rows without looking for anything
    asking = groups if asked is None else groups.filter(asked)
    slices = groups.groupBy("slice").count()
    if blocks is None:
        largest = slices.agg(F.max("count")).first()[0] or 0  # one number
        blocks = 4 if largest <= 2**18 else 5 if largest <= 2**27 else 6
    # rows without a time meet all others, and only then are the two special slices needed
    untimed = slices.agg(F.coalesce(F.bool_or(F.col("slice") == NO_TIME), F.lit(False))).scalar()
    timed = slices.agg(F.coalesce(F.bool_or(F.col("slice") != NO_TIME), F.lit(False))).scalar()
    anywhere = groups.groupBy("h").agg(F.min("o").alias("o")).select(
        "h", F.lit(ANY_TIME).alias("slice"), "o", F.lit(None).cast("double").alias("t")
    ).filter(untimed)
    around = F.array(F.col("slice") - 1, F.col("slice"), F.col("slice") + 1)
    sought = F.when(F.col("slice") == NO_TIME, F.array(F.lit(ANY_TIME))).when(
        untimed, F.array_append(around, F.lit(NO_TIME))
    ).otherwise(around)
    targets = groups.filter((F.col("slice") != NO_TIME) | timed).unionByName(anywhere)
    hot = hot_bands(groups, "h", k, blocks, hot_limit)
    probes = band_rows(asking, "h", k, blocks, hot).withColumn("seek", F.explode(sought)).select(
        *BAND_KEYS, "seek", F.col("h").alias("ph"), F.col("o").alias("po"), F.col("t").alias("pt"), F.col("slice").alias("ps")
    )
    # the rows below are exploded, which size estimates do not see: they are merged, never broadcast
    held = band_rows(targets, "h", k, blocks, hot).hint("merge").select(
        *BAND_KEYS, F.col("slice").alias("seek"), F.col("h").alias("th"), F.col("o").alias("to"), F.col("t").alias("tt")
    )
    keys = [probes[c] == held[c] for c in [*BAND_KEYS, "seek"]]
    earlier = (F.col("to") < F.col("po")) & (hamming("ph", "th") <= k)
    near = F.col("pt").isNull() | F.col("tt").isNull() | (F.abs(F.col("pt") - F.col("tt")) <= seconds)
    settled = probes.join(held, [*keys, earlier & near], "left_semi").select(F.col("po").alias("o")).distinct()
    free = asking.select("o").join(settled, "o", "left_anti")
    if time_col is not None:
        # inside one slice everything is near, so only the slices on both sides can be undecided
        beside = probes.filter((F.col("seek") == F.col("ps") - 1) | (F.col("seek") == F.col("ps") + 1))
        pending = beside.join(free.select(F.col("o").alias("po")), "po", "left_semi")
        open_ = pending.join(held, [*BAND_KEYS, "seek"]).filter(earlier & ~near).select(
            "po", "pt", F.col("th").alias("h"), F.col("seek").alias("slice"),
            F.when(F.col("seek") < F.col("ps"), -1).otherwise(1).alias("side")
        ).distinct()
        late = _reached(cut(open_), rows.filter(F.col("t").isNotNull()), window_h * 3600.0)
        free = free.join(late, "o", "left_anti")
    free = free.select(F.col("o").alias(order_col), F.lit(False).alias("_dup"))
    return df.join(free, order_col, "left").withColumn(
        "is_dup", F.col(hash_col).isNotNull() & F.coalesce(F.col("_dup"), F.lit(True))
    ).drop("_dup")


def distinct_sources(articles: DataFrame, issue: str = "issue_id") -> DataFrame:
    """Distinct sources of non-duplicate members. Two partial aggregations, so a hot issue stays small."""
    pairs = articles.filter(~F.col("is_dup") & F.col(issue).isNotNull()).select(issue, "source").distinct()
    return pairs.groupBy(issue).agg(F.count("source").alias("seen_sources"))


def member_counts(articles: DataFrame, issue: str = "issue_id") -> DataFrame:
    return articles.filter(F.col(issue).isNotNull()).groupBy(issue).agg(
        F.count_if(~F.col("is_dup")).alias("members"), F.count(F.lit(1)).alias("rows")
    )


def similar(a: str, b: str, threshold: float = 0.93) -> bool:
    """Character similarity; the two cheap upper bounds settle most pairs."""
    if a == b:
        return True
    m = difflib.SequenceMatcher(None, a, b)
    return m.real_quick_ratio() >= threshold and m.quick_ratio() >= threshold and m.ratio() >= threshold


@F.pandas_udf(T.ArrayType(T.StringType()))
def distinct_sentences(lists: pd.Series) -> pd.Series:
    """Keep the first of sentences whose character similarity reaches 0.93, in order."""

    def fold(items):
        kept: list[str] = []
        for s in items if items is not None else []:
            if not any(similar(s, k) for k in kept):
                kept.append(s)
        return kept

    return lists.map(fold)


@F.pandas_udf(T.ArrayType(T.StringType()))
def unlike(candidates: pd.Series, others: pd.Series) -> pd.Series:
    """Candidates without a similar sentence in the other list."""

    def keep(mine, theirs):
        theirs = [] if theirs is None else list(theirs)
        return [c for c in (mine if mine is not None else []) if not any(similar(c.strip(), t) for t in theirs)]

    return pd.Series([keep(m, t) for m, t in zip(candidates, others)])
