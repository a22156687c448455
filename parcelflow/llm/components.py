"""Connected components of an edge table by alternating large and small stars.

Both steps are joins and groupings over the edges; nothing is gathered.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelflow.llm.kept import kept


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's smallest neighbour."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m"))
    linked = both.filter("b > a").join(least, F.col("a") == F.col("u"))
    root = F.least("a", "m")
    return linked.select(F.col("b").alias("a"), root.alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them."""
    least = edges.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m"))
    moved = edges.join(least, F.col("a") == F.col("u")).select(
        F.col("b").alias("a"), F.col("m").alias("b")
    )
    return moved.filter("a <> b").unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b"))).distinct()


def _state(edges: DataFrame) -> tuple:
    mixed = F.pmod(F.xxhash64("a", "b"), F.lit(1 << 40))
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(mixed)).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of the nodes that have an edge (columns a, b; bigint, not
    null); a component is named by its smallest node."""
    edges = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges = kept(edges.filter("a <> b").distinct(), "edges")
    before = None
    now = _state(edges)
    while now != before:
        edges = kept(_small_star(_large_star(edges)), "edges")
        before, now = now, _state(edges)
    roots = edges.select(F.col("b").alias("node")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        roots.select("node", F.col("node").alias("component"))
    )
