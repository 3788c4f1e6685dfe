"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import by_merge, store


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the least node around it."""
    both = edges.union(edges.select("low", "high")).toDF("node", "other")
    least = both.groupBy("node").agg(F.min("other").alias("near"))
    root = F.least("node", "near")
    return (
        both.join(by_merge(least), "node").where(F.col("other") > F.col("node"))
        .select(F.col("other").alias("high"), root.alias("low")).distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the least of them."""
    least = edges.groupBy("high").agg(F.min("low").alias("root"))
    moved = edges.join(by_merge(least), "high").where(F.col("low") > F.col("root")).select(
        F.col("low").alias("high"), F.col("root").alias("low")
    )
    return moved.union(least.select("high", "root")).distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node that has an edge; the component is its least node.

    `edges` has two columns of one sortable type; direction, repeats and loops don't matter, null
    ends are no edges. Rounds grow with the logarithm of the component size; each is written to
    the shared folder, and only two numbers come to the driver to see whether it changed anything.
    """
    a, b = edges.columns
    edges = edges.where(F.col(a) != F.col(b)).select(
        F.greatest(a, b).alias("high"), F.least(a, b).alias("low")
    )
    edges = store(edges.distinct(), "links")
    before = None
    while True:
        state = tuple(edges.agg(
            F.count(F.lit(1)), F.bit_xor(F.xxhash64("high", "low"))
        ).first())
        if state == before or state[0] == 0:
            break
        before = state
        edges = store(_small_star(_large_star(edges)), "stars")
    roots = edges.select(F.col("low").alias("node")).distinct()
    return edges.select(F.col("high").alias("node"), F.col("low").alias("component")).union(
        roots.select("node", F.col("node").alias("component"))
    )
