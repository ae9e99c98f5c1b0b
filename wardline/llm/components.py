"""Connected components of an edge list, by large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.llm.common import written
from wardline.session import materialize


def connected_components(edges: DataFrame) -> DataFrame:
    """From edges (a, b) one row per node: node, component (the least node that it is connected with).

    Each round ties nodes to the least node in reach, first larger neighbours (large star), then
    smaller ones (small star), until nothing changes; the rounds grow with the logarithm of the
    longest path. Least neighbours are aggregated before they are shuffled, so a node with very
    many edges is no hot key there; what is joined back to edges is one row per node.
    """
    edges = edges.select(F.col("a").cast("bigint"), F.col("b").cast("bigint")).where("a != b")
    edges = materialize(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    seen = _print(edges)
    while True:
        # A step has no more edges than it was given, and one for each node.
        edges = written(_star(_star(edges, large=True), large=False).distinct(), "edges", 2 * seen[0])
        # Stars whose centres are no one's leaf stay as they are.
        if seen == (seen := _print(edges)):
            break
    leaves = edges.select(F.col("b").alias("node"), F.col("a").alias("component"))
    centres = edges.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct()
    return leaves.unionByName(centres)


def _print(edges: DataFrame) -> tuple:
    """Number and checksum of the edges: the same before and after only if nothing changes."""
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def _star(edges: DataFrame, large: bool) -> DataFrame:
    # From a node to its neighbours: in a small star only to smaller ones.
    back = edges.select(F.col("b").alias("a"), F.col("a").alias("b"))
    sides = edges.unionByName(back) if large else back
    least = sides.groupBy("a").agg(F.min(F.least("a", "b")).alias("least"))
    tied = sides.join(least, "a")
    if large:
        out = tied.where("b > a").select(F.col("least").alias("a"), "b")
    else:
        own = least.select(F.col("least").alias("a"), F.col("a").alias("b"))
        out = tied.select(F.col("least").alias("a"), "b").unionByName(own)
    return out.where("a != b")
