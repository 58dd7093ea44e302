"""Connected components of a graph kept in tables, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tradewind.operators.scratch import materialize


def _star(edges: DataFrame) -> DataFrame:
    """(node, least): each node's least neighbour or itself; combined before the shuffle."""
    return edges.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("least"))


def _large(edges: DataFrame) -> DataFrame:
    """Every node hands its larger neighbours on to the least node it knows."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return both.join(_star(both), "u").filter("v > u").select(F.col("v").alias("u"), F.col("least").alias("v"))


def _small(edges: DataFrame) -> DataFrame:
    """Every node hands itself and its smaller neighbours on to the least of them. Here u > v."""
    linked = edges.join(_star(edges), "u")
    moved = linked.select(F.explode(F.array("u", "v")).alias("w"), "least").filter("w <> least")
    return moved.select(F.col("w").alias("u"), F.col("least").alias("v"))


def connected_components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (u, v), where root is the component's least node.

    Rounds go on until the edges are stars that no longer change; their number grows with the
    logarithm of the longest chain. Each round's edges are stored. Links of a node with itself
    or with null don't count.
    """
    ordered = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    edges = materialize(ordered.filter("u > v").distinct(), "links")
    state = None
    while True:
        # 64-bit hashes summed as decimals: the sum can't overflow and doesn't depend on order.
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
        edges = materialize(_small(_large(edges).distinct()).distinct(), "links")
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
