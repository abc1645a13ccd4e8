"""Connected components by alternating stars: every edge moves to the smallest neighbour."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomsync.session import staged

def components(edges: DataFrame) -> DataFrame:
    """``node, label`` for each end of the edges ``a, b`` (long); the label is the smallest node reachable.

    Minima are aggregates, combined before the shuffle; a node with very many edges is a hot
    key of a plain join, which adaptive execution splits. Edges stay in the shared folder.
    """
    edges = staged(_ordered(edges), "edges")
    before = None
    while (now := tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())) != before:
        before = now
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("least"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.least("a", "least").alias("b"))
        large = _ordered(large)
        least = large.groupBy("a").agg(F.min("b").alias("least"))
        small = large.join(least, "a").where("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b"))
        edges = staged(_ordered(small.unionByName(least.select("a", F.col("least").alias("b")))), "edges")
    labels = edges.groupBy("a").agg(F.min("b").alias("label"))
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct()
    return labels.select(F.col("a").alias("node"), "label").unionByName(roots)


def _ordered(edges: DataFrame) -> DataFrame:
    return edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
