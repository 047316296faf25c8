"""Connected components of a link table, as Spark joins (alternating large star and small star).

Every round is written to the shared folder, so a lost executor costs at most one round.
The least neighbour of a node is a partial aggregate, and the join that brings it back
carries two longs a row, which adaptive execution can split for a hub.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saleslens.llm.common import written


def _least(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("u").agg(F.min("v").alias("m"))


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for each node that has a link to another; root is the smallest node reachable.

    Links are undirected; nulls, loops and repeated links are ignored. An empty table gives no row.
    """
    edges = (links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
             .where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))).distinct())
    edges = written(edges, "links")
    state = None
    while True:
        # Large star: each neighbour above u goes to the least of u and its neighbours.
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = (both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where("u != v").distinct())
        # Small star: the neighbours below u, and u, go to the least of them.
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(low, "u")
        small = (joined.select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low.select("u", F.col("m").alias("v"))).where("u != v").distinct())
        edges = written(small, "links")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            return edges.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("root")).unionByName(
                edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        state = now
