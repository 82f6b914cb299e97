"""Connected components by alternating large-star and small-star steps.

Every step is a min aggregate, combined before the shuffle, and an equi-join of two stored sides, which adaptive
execution splits: the centre of a star may hold a third of all links.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockyard.llm.common import saved


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return tuple(row)


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for the nodes of the links (a, b): root is the least node of the component.

    Nodes are of any ordered type. Loops and repeated links are ignored; no links give no rows. Each round is written to the
    shared folder; rounds grow with the logarithm of the longest chain.
    """
    edges = saved(edges.filter("a != b").select("a", "b").distinct())
    before = None
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = saved(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.when(F.col("m") < F.col("a"), F.col("m")).otherwise(F.col("a")).alias("m")))
        large = both.filter(F.col("b") > F.col("a")).join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.filter("a != b").distinct()
        down = large.select(F.when(F.col("a") > F.col("b"), F.col("a")).otherwise(F.col("b")).alias("a"), F.when(F.col("a") > F.col("b"), F.col("b")).otherwise(F.col("a")).alias("b"))
        down = saved(down)
        lower = saved(down.groupBy("a").agg(F.min("b").alias("m")))
        small = down.join(lower, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).union(lower.select("a", F.col("m").alias("b")))
        edges = saved(small.filter("a != b").distinct())
        now = _state(edges)
        if now == before:
            break
        before = now
    roots = edges.groupBy("a").agg(F.min("b").alias("root")).select(F.col("a").alias("node"), "root")
    return roots.union(roots.select(F.col("root").alias("node"), "root").distinct())
