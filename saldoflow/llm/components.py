"""Connected components of a graph given as edges, by repeated star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saldoflow.llm.scratch import Scratch


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """``(node, root)`` for every node of ``edges (a, b)``; the root is the least node of its component.

    Each round links every node to the least node around it, first for the larger, then for the smaller neighbours;
    the number of rounds grows with the logarithm of the longest path. Minima are taken before any shuffle, so a node
    with very many neighbours is no bottleneck.
    """
    directed = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    sum_of = F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.lit(0))
    current, before = scratch.save_measured(directed, n=F.count("*"), h=sum_of)
    while before["n"]:
        both = current.union(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = current.select(F.col("v").alias("u"), F.col("u").alias("v")).join(least, "u")
        # An edge hangs its larger end below the least node around its smaller end.
        hung = large.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        below = hung.groupBy("u").agg(F.min("v").alias("m"))
        small = hung.join(below, "u")
        merged = small.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").union(
            below.select("u", F.col("m").alias("v"))
        )
        current, after = scratch.save_measured(merged.distinct(), n=F.count("*"), h=sum_of)
        if after == before:
            break
        before = after
    roots = current.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return current.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)
