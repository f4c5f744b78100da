"""Connected components of a graph given by its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratawell.llm.common import Steps


def _lowest(steps: Steps, edges: DataFrame) -> DataFrame:
    """Each node that has a smaller neighbour, with its smallest."""
    return edges.groupBy("hi").agg(F.min("lo").alias("low"))


def components(steps: Steps, edges: DataFrame) -> DataFrame:
    """(node, component) of every node on an edge; component is the smallest node reachable.

    edges: (lo, hi) with lo < hi, repeats allowed.  Alternates two rewrites until nothing changes:
    neighbours above a node, then neighbours below it, are linked to the smallest one around.  Each
    keeps components as they are, and the number of rounds grows with the logarithm of the largest.
    A node with very many edges is a join key with many rows on one side only, which adaptive
    execution splits, as both sides of each join are read from step tables.
    """
    edges = steps.save(edges.filter("lo < hi").distinct())
    seen = None
    while True:
        both = edges.unionByName(edges.select(F.col("hi").alias("lo"), F.col("lo").alias("hi")))
        # both: (lo: neighbour, hi: node), each edge twice
        least = steps.save(
            both.groupBy("hi").agg(F.least(F.min("lo"), F.col("hi")).alias("low"))
        )
        large = steps.save(
            both.filter("lo > hi")
            .join(least, "hi")
            .select(F.col("low").alias("lo"), F.col("lo").alias("hi"))
            .filter("lo < hi")
            .distinct()
        )
        below = steps.save(_lowest(steps, large))
        small = steps.save(
            large.join(below, "hi")
            .select(F.col("low"), F.explode(F.array("lo", "hi")).alias("hi"))
            .filter("low < hi")
            .select(F.col("low").alias("lo"), "hi")
            .distinct()
        )
        state = small.agg(
            F.count(F.lit(1)),
            F.sum(F.xxhash64("lo", "hi").cast("decimal(38,0)")),
        ).first()
        steps.drop(edges, least, large, below)
        edges = small
        if state == seen:
            break
        seen = state
    # every component is now a star around its smallest node
    nodes = edges.select(F.col("hi").alias("node"), F.col("lo").alias("component"))
    return nodes.unionByName(
        edges.select(F.col("lo").alias("node"), F.col("lo").alias("component")).distinct()
    )
