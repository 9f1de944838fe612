"""Connected components by alternating star contraction, for any number of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywick.llm.common import parked, released

#: plain propagation of the least id would need a round per step of the longest
#: chain; the star operations need about log(nodes) rounds
MAX_ROUNDS = 60


def components(links: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of ``links(a, b)``; component is its least node.

    Each round joins every node to the least of its neighbours (large star), then
    the lesser neighbours to the least of them (small star).  A hub is only ever a
    group of sums (a minimum) and a join side that adaptive execution can split.
    """
    edges = parked(links.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    for _ in range(MAX_ROUNDS):
        both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(low, "u")
        small = joined.where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            low.select("u", F.col("m").alias("v"))
        )
        after = parked(small.where("u != v").distinct(), "edges")
        released(edges)
        edges = after
        # done when every node has one parent and no parent has one
        roles = after.select(F.col("u").alias("node"), F.lit(1).alias("child"), F.lit(0).alias("parent")).unionByName(
            after.select(F.col("v").alias("node"), F.lit(0).alias("child"), F.lit(1).alias("parent"))
        )
        open_nodes = roles.groupBy("node").agg(F.sum("child").alias("c"), F.max("parent").alias("p")).where("c > 1 or (c > 0 and p > 0)")
        if open_nodes.isEmpty():
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
                edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
            )
    raise RuntimeError(f"components are not stable after {MAX_ROUNDS} rounds")
