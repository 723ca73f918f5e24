"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, root) for every node of edges (a, b); root is the component's smallest node.

    Minima are taken by aggregation and joined back, so no neighbour list is ever held whole. Both sides of
    a join are written tables, so Spark may split the partition of a hub; each round is written too. Loops
    and repeated edges don't matter; no edges give no rows.
    """
    pairs = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), name)
    before = None
    while True:
        # Large star: a node's larger neighbours move to the smallest node around it.
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = stored(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), name)
        large = stored(both.where("v > u").join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), name)
        # Small star: a node and its smaller neighbours move to the smallest of them.
        low = stored(large.groupBy("u").agg(F.min("v").alias("m")), name)
        moved = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        pairs = stored(moved.unionByName(low.select("u", F.col("m").alias("v"))).distinct(), name)
        state = pairs.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(pairs.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
