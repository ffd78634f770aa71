"""Connected components of an edge table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomtrace.llm.scratch import Scratch


def _large_star(edges: DataFrame) -> DataFrame:
    """Every greater neighbour of a node is tied to the least node of its neighbourhood."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its lesser neighbours are tied to the least of them; in ``edges`` a is the greater node."""
    least = edges.groupBy("a").agg(F.min("b").alias("low"))
    moved = edges.join(least, "a").filter("b > low").select(F.col("b").alias("a"), F.col("low").alias("b"))
    return moved.union(least.select("a", F.col("low").alias("b"))).distinct()


def connected_components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, label) for every node of ``edges`` (columns a, b); label is the least node of its component.

    Large-star and small-star steps turn each component into a star around its least
    node in a number of rounds that grows as the logarithm of its size, on paths too.
    Least neighbours are found with map-side combining and joined back as one row a
    node, so a hub's neighbours need not meet in one task. Every round is written to
    the shared folder; the rounds end when both steps leave the edges as they are.
    An edge from a node to itself gives that node as its own component. No edge: no row.
    """
    own = edges.select(F.col("a").alias("node")).union(edges.select(F.col("b").alias("node"))).distinct()
    own = scratch.keep(own, "nodes")
    now = scratch.keep(edges.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    state = None
    while True:
        moved = scratch.keep(_small_star(_large_star(now)), "edges")
        scratch.drop(now)
        now = moved
        # The same edges have the same number and the same sum of hashes.
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if state == tuple(seen):
            break
        state = tuple(seen)
    labels = own.join(now.select(F.col("a").alias("node"), F.col("b").alias("label")), "node", "left")
    labels = scratch.keep(labels.select("node", F.coalesce("label", "node").alias("label")), "labels")
    scratch.drop(own)
    scratch.drop(now)
    return labels
