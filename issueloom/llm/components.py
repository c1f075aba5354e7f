"""Connected components of an edge table by alternating star contractions, each round written to the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..session import Scratch


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node of an edge; root is the smallest node of the component.

    A round moves every larger neighbour of a node below the node's smallest neighbour, then all smaller neighbours too.
    Long chains shrink by a factor, so rounds grow with the logarithm of the chain. The steps are joins and aggregates
    with partial sums; a node with very many edges is no group of one task. Null ends and loops are ignored; no edges
    give an empty table.
    """
    own = Scratch(edges.sparkSession)
    pairs = edges.select(F.col(a).alias("p"), F.col(b).alias("q")).where("p <> q")
    links = own.cut(pairs.select(F.greatest("p", "q").alias("x"), F.least("p", "q").alias("y")).distinct())
    seen = None
    while True:
        mark = links.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("x", "y")).alias("h")).first()
        if mark == seen or mark["n"] == 0:
            break
        seen = mark
        low = links.groupBy("y").agg(F.min("y").alias("own")).select("y", "own")
        down = links.groupBy("x").agg(F.min("y").alias("m")).withColumnRenamed("x", "y")
        low = low.join(down, "y", "left").select("y", F.coalesce("m", "own").alias("m"))
        large = links.join(low, "y").select("x", F.col("m").alias("y")).distinct()
        least = large.groupBy("x").agg(F.min("y").alias("m"))
        below = large.join(least, "x").where("y <> m").select(F.col("y").alias("x"), F.col("m").alias("y"))
        before, links = links, own.cut(below.unionByName(least.select("x", F.col("m").alias("y"))).distinct())
        own.drop(before)
    roots = links.select(F.col("y").alias("node"), F.col("y").alias("root")).distinct()
    return links.select(F.col("x").alias("node"), F.col("y").alias("root")).unionByName(roots)
