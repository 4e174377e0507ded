"""Connected components by alternating star contractions, all in DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tideglass.sources.workspace import stage


def _toward_least(edges: DataFrame, larger_only: bool) -> DataFrame:
    """Large star: the neighbours of a node that exceed it point to the least of it and them.
    Small star (``larger_only`` false): a node and its smaller neighbours point to the least.

    The least of each node comes from a partial aggregation and is joined back; a node with very
    many neighbours is so a skewed join key, which Spark can split, and never one group.
    """
    if larger_only:
        edges = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = edges.groupBy("a").agg(F.min("b").alias("low")) \
            .select(F.col("a").alias("of"), F.least("a", "low").alias("low"))
        out = edges.where("b > a")
    else:  # a > b on every edge
        least = edges.groupBy("a").agg(F.min("b").alias("low")).select(F.col("a").alias("of"), "low")
        out = edges
    joined = out.join(least, F.col("a") == F.col("of"))
    moved = joined.select(F.col("b").alias("a"), F.col("low").alias("b"))
    if not larger_only:
        moved = moved.unionByName(least.select(F.col("of").alias("a"), F.col("low").alias("b")))
    moved = moved.where("a != b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    return moved if larger_only else moved.distinct()  # once a round is enough


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node that has an edge; ``edges`` are (a, b) of any orderable type,
    and a root is the least node of its component. Each round is staged; a round count that grows
    with the logarithm of the longest path suffices. No edges give no rows.
    """
    edges = stage(edges.where("a != b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    seen = None
    while True:
        mark = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == seen:
            break
        seen = mark
        edges = stage(_toward_least(_toward_least(edges, True), False), "edges")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()
