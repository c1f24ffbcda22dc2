"""Connected components of links, as rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitloom.session import through_storage


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) of every node that has a link to another; the component is its smallest node.

    In each round every node is merged into the least of itself and its neighbours, by number in the first and
    every other round, by a hash of the number and the round in between, so that stars shrink at once and paths
    by a constant share. Only minima are gathered by node, which Spark combines before the shuffle.
    """
    edges = through_storage(
        links.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).where("a < b").distinct(), "links"
    )
    merges: list[DataFrame] = []
    while not edges.isEmpty():
        level = len(merges)

        def order(node: str):
            return F.col(node) if level % 2 == 0 else F.xxhash64(F.col(node), F.lit(level))

        both = edges.select(F.col("a").alias("node"), F.col("b").alias("other")).union(edges.select("b", "a"))
        least = both.groupBy("node").agg(F.min(F.struct(order("other").alias("o"), F.col("other"))).alias("least"))
        own = F.struct(order("node").alias("o"), F.col("node").alias("other"))
        merge = through_storage(least.select("node", F.least("least", own)["other"].alias("into")), "merges")
        merges.append(merge)
        moved = edges.join(merge.select(F.col("node").alias("a"), F.col("into").alias("to_a")), "a").join(
            merge.select(F.col("node").alias("b"), F.col("into").alias("to_b")), "b"
        )
        ends = moved.select(F.least("to_a", "to_b").alias("a"), F.greatest("to_a", "to_b").alias("b"))
        edges = through_storage(ends.where("a < b").distinct(), "links")
    if not merges:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = merges[-1].select("node", F.col("into").alias("root"))
    for merge in reversed(merges[:-1]):
        above = roots.select(F.col("node").alias("into"), "root")
        roots = merge.join(above, "into", "left").select("node", F.coalesce("root", "into").alias("root"))
    roots = through_storage(roots, "roots")
    names = roots.groupBy("root").agg(F.min("node").alias("component"))
    return roots.join(names, "root").select("node", "component")
