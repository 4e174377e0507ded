"""Mixing sources to target weights by hash-threshold histograms (operator 9).

A document has a fixed 60-bit hash of its id. A source that may give ``extra`` words on top of
whole repeats takes the documents below a hash threshold. The threshold is found from histograms
of words by hash bucket: the bucket in which the running sum passes the budget is cut into finer
buckets, level by level, until it holds one hash value. Nothing is sorted but histograms of at
most ``2 ** BITS`` buckets a source, and the documents are then filtered by comparison alone.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from tideglass.sources.workspace import stage

WORD = r"[^\x20\x09-\x0D]+"
HASH_BITS, BITS = 60, 12


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def id_hash(doc_id: Column) -> Column:
    """60 bits of the md5 of the id as text; a NULL id hashes as the empty text."""
    digest = F.md5(F.coalesce(doc_id.cast("string"), F.lit("")))
    return F.conv(F.substring(digest, 1, HASH_BITS // 4), 16, 10).cast("long")


def source_targets(totals: DataFrame, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5,
                   most: float = 2.0) -> DataFrame:
    """``totals`` (source, source_size) with ``target``: the budget of ``share`` times all sizes
    dealt by weight, no source above ``most`` times its size, the excess dealt again.

    Weights repeat along the sources in code-point order, NULL last. With the sources in order
    of the level at which they are full, the level that dealing again ends at is the largest of
    "budget left after the sources before this one are full, per weight from here on". The
    windows have no key on purpose: they hold one row a source.
    """
    by_name = Window.orderBy(F.asc_nulls_last("source"))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                          (F.row_number().over(by_name) - 1) % len(weights) + 1)
    full = F.lit(most) * F.col("source_size")
    by_level = Window.orderBy(full / F.col("weight"), F.asc_nulls_last("source"))
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_level.rowsBetween(0, Window.unboundedFollowing)
    budget = F.lit(share) * F.sum("source_size").over(Window.partitionBy())
    level = (budget - F.coalesce(F.sum(full).over(before), F.lit(0.0))) \
        / F.sum("weight").over(onward)
    return (
        totals.withColumn("weight", weight).withColumn("level", level)
        .withColumn("target", F.least(
            full, F.col("weight") * F.max("level").over(Window.partitionBy())))
        .select("source", "source_size", "target")
    )


def source_edges(sized: DataFrame, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5,
                 most: float = 2.0) -> DataFrame:
    """One row a source of ``sized`` (source, size, hash): size, target, and where the mix cuts
    it. ``whole`` times it takes all; ``at`` is the hash of the last bucket, which has ``unit``
    words, when ``left`` words are still to be taken."""
    targets = source_targets(
        sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, most)
    whole = F.when(F.col("source_size") > 0,
                   F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    edge = targets.withColumn("whole", whole).withColumn(
        "left", F.col("target") - F.col("whole") * F.col("source_size")
    ).withColumn("at", F.lit(0).cast("long")).withColumn("unit", F.lit(0).cast("long"))
    for shift in range(HASH_BITS - BITS, -1, -BITS):
        edge = _refine(sized, stage(edge, "mix-edge"), shift)
    return stage(edge, "mix-edge")


def _with_copies(rows: DataFrame, source: str, hashed: Column, edges: DataFrame,
                 most: float) -> DataFrame:
    """``rows`` joined with the ``_mix_`` columns of their source, and ``_mix_copies``."""
    edges = edges.select(*[F.col(c).alias(f"_mix_{c}") for c in edges.columns])
    at, left = F.col("_mix_at"), F.col("_mix_left")
    # The documents of the last bucket share one hash; they go in if that ends nearer the target.
    below = (hashed < at) | ((hashed == at) & (2 * left > F.col("_mix_unit")))
    copies = F.when(
        F.col("_mix_source_size") > 0,
        F.least(F.col("_mix_whole") + below.cast("long"), F.lit(math.ceil(most)))
    ).otherwise(0).cast("long")
    return rows.join(edges, F.col(source).eqNullSafe(F.col("_mix_source"))) \
        .withColumn("_mix_copies", copies)


def _sized(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    return stage(docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
        word_count(F.col(text_col)).alias("size"), id_hash(F.col(id_col)).alias("hash"),
    ), "mix-sizes")


def mix_sources(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5,
                most: float = 2.0, id_col: str = "doc_id", text_col: str = "text",
                source_col: str = "source") -> DataFrame:
    """One row a document: doc_id, size, source, source_size, target, copies and taken words.

    ``copies`` is how often the mix takes the document, at most ``ceil(most)``; ``taken`` is
    ``copies * size``. NULL text has size 0, NULL is a source of its own. Rows with the same id
    share their hash and so their fate. A source of size 0 has target 0 and copies 0. An empty
    table gives no rows. Other columns of ``docs`` play no part.
    """
    sized = _sized(docs, id_col, text_col, source_col)
    edges = source_edges(sized, weights, share, most)
    return _with_copies(sized, "source", F.col("hash"), edges, most).select(
        "doc_id", "size", "source", F.col("_mix_source_size").alias("source_size"),
        F.col("_mix_target").alias("target"), F.col("_mix_copies").alias("copies"),
        (F.col("_mix_copies") * F.col("size")).alias("taken"))


def take_mix(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5,
             most: float = 2.0, id_col: str = "doc_id", text_col: str = "text",
             source_col: str = "source") -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them. Texts are not shuffled while the table
    of sources, one row each, is small enough for Spark to broadcast."""
    edges = source_edges(_sized(docs, id_col, text_col, source_col), weights, share, most)
    mixed = _with_copies(docs, source_col, id_hash(F.col(id_col)), edges, most)
    return mixed.where("_mix_copies > 0").withColumn(
        "_mix_copy", F.explode(F.sequence(F.lit(1), F.col("_mix_copies").cast("int")))
    ).select(*[F.col(c) for c in docs.columns])


def _refine(sized: DataFrame, edge: DataFrame, shift: int) -> DataFrame:
    """``edge`` one level finer: the boundary bucket of each source cut into ``2 ** BITS``, the
    one that passes the words left, and what is left before it."""
    key = F.expr(f"shiftright(hash, {shift})")
    inside = edge.select(F.col("source").alias("of"), F.col("at").alias("outer"))
    sums = (
        sized.withColumn("bucket", key)
        .join(inside, F.col("source").eqNullSafe(F.col("of"))
              & (F.expr(f"shiftright(bucket, {BITS})") == F.col("outer")))
        .groupBy("source", "bucket").agg(F.sum("size").alias("words"))
    )
    upto = F.sum("words").over(Window.partitionBy("source").orderBy("bucket"))
    first_over = (
        sums.withColumn("upto", upto).withColumnRenamed("source", "of")
        .join(edge, F.col("source").eqNullSafe(F.col("of")))
        .where((F.col("upto") > F.col("left")) & (F.col("upto") - F.col("words") <= F.col("left")))
        .select(F.col("of").alias("in_source"), F.col("bucket"), F.col("words"),
                (F.col("left") - F.col("upto") + F.col("words")).alias("rest"))
    )
    return (
        edge.join(first_over, F.col("source").eqNullSafe(F.col("in_source")), "left")
        .select("source", "source_size", "target", "whole",
                F.coalesce("rest", "left").alias("left"),
                F.coalesce("bucket", F.lit(0)).alias("at"),
                F.coalesce("words", F.lit(0)).alias("unit"))
    )
