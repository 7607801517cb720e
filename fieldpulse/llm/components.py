"""Connected components by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldpulse.llm.tables import written


def _state(edges: DataFrame) -> tuple:
    return tuple(
        edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
    )


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for each node of the edges (a, b); component is its smallest node.

    Each round links nodes to smaller neighbours, through joins only, so that a node with very
    many neighbours is split over tasks. The number of rounds grows with the logarithm of the
    longest chain.
    """
    now = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    now = written(now.distinct(), "edges")
    state = _state(now)
    while state[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(lowest, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        # u > v holds here, so the smaller neighbours of u are all of its rows.
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lowest, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.unionByName(lowest.select("u", F.col("m").alias("v")))
        now = written(small.distinct(), "edges")
        before, state = state, _state(now)
        if state == before:
            break
    nodes = now.groupBy("u").agg(F.min("v").alias("component"))
    return nodes.select(F.col("u").alias("node"), "component").unionByName(
        nodes.select(F.col("component").alias("node"), "component").distinct()
    )
