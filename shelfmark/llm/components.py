"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.frames import cut


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of `edges` (a, b); root is the smallest node reachable.

    Alternates two steps until nothing changes: every node's larger neighbours, then its smaller
    ones, are tied to its smallest neighbour. The number of edges never grows, the rounds grow
    with the logarithm of the longest path. Minima are aggregated before the shuffle and joined
    back as one stored row per node, so a node with very many links is split like any skewed join.
    Every step is stored in the checkpoint folder; a lost executor repeats one step at most."""
    links = cut(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct())
    last = None
    while True:  # ends: links only ever move to smaller nodes
        # larger neighbours of each node to its smallest neighbour (or itself)
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = cut(both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("n"), F.least("u", "m").alias("m")))
        large = both.where("v > u").join(low, F.col("u") == F.col("n")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = cut(large.distinct())
        # smaller neighbours of each node, and the node, to its smallest neighbour
        least = cut(large.groupBy("u").agg(F.min("v").alias("m")).withColumnRenamed("u", "n"))
        small = large.join(least, F.col("u") == F.col("n"))
        small = small.select(F.explode(F.array(F.col("v"), F.col("u"))).alias("u"), F.col("m").alias("v"))
        links = cut(small.where("u <> v").distinct())
        # stars: no node is both a root and a leaf, and no link changed
        now = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if last is not None and now == last:
            break
        last = now
    roots = links.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(links.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
