"""Approximate nearest neighbours by a permutation index (operator 11).

A vector is represented by its nearest pivots, nearest first: ``PREFIX`` of at most 256 pivots, a
byte each. Vectors that lie near each other see the pivots in nearly the same order. A shard posts
its vectors in one list a pivot, with the place the pivot takes. A query walks the lists of its own
pivots; what two places of one pivot have in common, ``PREFIX - max(place, place)``, adds up to
``constant - footrule / 2``, where the footrule distance counts a pivot that is missing from a prefix
at place ``PREFIX``. The nearest by footrule are ranked again by their true inner product.

Nearness is the inner product, so long vectors are near to many queries. To see this in the pivots,
each candidate gets one more component that fills its length up to the longest one's (0 for
queries): then the largest inner product and the least distance are the same thing.

Candidates are dealt by hash into shards, queries into blocks; a (shard, block) cell is one group of
bounded size, and the cells' answers are merged by rank. Every row is indexed; only the pivots come
from a sample.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from tideglass.sources.workspace import stage

PIVOTS = 256          # at most, as a pivot's number is a byte
PIVOT_SAMPLE = 2048   # rows, the first by a hash, among which distinct vectors become pivots
PREFIX = 64
SHARE = 0.125         # of a shard's candidates, by footrule, that are ranked again
LEAST = 512           # and at least so many, so that small shards are ranked whole
SHARD_ROWS = 8192
QUERY_ROWS = 2048


def matrix(column: pa.ChunkedArray | pa.Array, width: int = 0) -> np.ndarray:
    """Lists of numbers as rows, filled up with 0 to the longest one or ``width``."""
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    size = np.asarray(pc.list_value_length(lists), dtype=np.int64)
    out = np.zeros((len(lists), max(int(size.max(initial=0)), width)))
    row = np.repeat(np.arange(len(lists)), size)
    out[row, np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)] = lists.flatten()
    return out


def filled(vectors: np.ndarray, longest: float) -> np.ndarray:
    """With the component that makes all vectors as long as the longest."""
    rest = longest * longest - np.einsum("ij,ij->i", vectors, vectors)
    return np.hstack([vectors, np.sqrt(np.maximum(rest, 0))[:, None]])


def permutations(vectors: np.ndarray, pivots: np.ndarray, prefix: int) -> np.ndarray:
    """The numbers of the nearest pivots of each vector, nearest first."""
    near = vectors @ pivots.T
    return np.argsort(-near, axis=1, kind="stable")[:, :prefix].astype(np.uint8)


def inner_products(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Sums of products in the order of the components, so that equal vectors score equally."""
    total = np.zeros(len(vectors))
    for d in range(vectors.shape[1]):
        total += vectors[:, d] * query[d]
    return total


class Shard:
    """Vectors by (id, row), and their postings: by pivot, the vectors that have it in their
    prefix and ``prefix - place``."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, vectors: np.ndarray,
                 perms: np.ndarray) -> None:
        order = np.lexsort((rows, ids))
        self.ids, self.rows, self.vectors = ids[order], rows[order], vectors[order]
        n, self.prefix = perms.shape
        pivots = perms[order].ravel()
        by_pivot = np.argsort(pivots, kind="stable")
        cuts = np.searchsorted(pivots[by_pivot], np.arange(PIVOTS + 1))
        held = (by_pivot // max(self.prefix, 1)).astype(np.int32)
        worth = (self.prefix - by_pivot % max(self.prefix, 1)).astype(np.int32)
        self.lists = [(held[a:b], worth[a:b]) for a, b in zip(cuts, cuts[1:])]

    def nearest(self, row: int, query: np.ndarray, perm: np.ndarray, k: int, share: float,
                least: int) -> tuple[np.ndarray, np.ndarray]:
        """(places in the shard, scores) of the k nearest found, nearest first."""
        common = np.zeros(len(self.ids), dtype=np.int32)
        for place, pivot in enumerate(perm):
            held, worth = self.lists[pivot]
            common[held] += np.minimum(worth, self.prefix - place)
        others = self.rows != row
        depth = max(int(np.ceil(share * len(common))), least, k)
        if depth < len(common):  # all that tie with the last one are ranked as well
            common[~others] = -1
            others &= common >= np.partition(common, len(common) - depth)[len(common) - depth]
        at = np.flatnonzero(others)
        rough = self.vectors[at] @ query
        if len(at) > k:  # sums in another order differ in the last digits only
            slack = 1e-9 * (np.abs(rough).max() + 1e-300)
            at = at[rough >= np.partition(rough, len(rough) - k)[len(rough) - k] - slack]
        score = inner_products(self.vectors[at], query)
        best = np.lexsort((at, -score))[:k]
        return at[best], score[best]


def _permute(pivots: np.ndarray, prefix: int, longest: float, scale: float):
    """Adds both permutations of a row: as a candidate, and as a query."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = matrix(batch.column("vec"), pivots.shape[1] - 1) / scale
            bare = np.hstack([vectors, np.zeros((len(vectors), 1))])
            perms = [permutations(v, pivots, prefix) for v in (filled(vectors, longest), bare)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *[pa.array([p.tobytes() for p in perm], pa.binary())
                                   for perm in perms]],
                [*batch.schema.names, "perm", "asked"])

    return run


def _search(k: int, share: float, least: int) -> Callable[[pa.Table], pa.Table]:
    def perms(column: pa.ChunkedArray) -> np.ndarray:
        held = column.to_pylist()
        return np.frombuffer(b"".join(held), np.uint8).reshape(len(held), -1)

    def search(cell: pa.Table) -> pa.Table:
        ask = np.asarray(cell["is_query"])
        ids, rows, vectors = np.asarray(cell["id"]), np.asarray(cell["row"]), matrix(cell["vec"])
        out: list[tuple[np.ndarray, ...]] = []
        if ask.any() and not ask.all():
            order = perms(cell["perm"])
            shard = Shard(ids[~ask], rows[~ask], vectors[~ask], order[~ask])
            for at in np.flatnonzero(ask):
                found, score = shard.nearest(rows[at], vectors[at], order[at], k, share, least)
                n = len(found)
                out.append((np.full(n, rows[at]), np.full(n, ids[at]), shard.ids[found],
                            shard.rows[found], score))
        columns = [np.concatenate(c) for c in zip(*out)] if out else [[]] * 5
        kinds = [pa.int64()] * 4 + [pa.float64()]
        return pa.table([pa.array(c, kind) for c, kind in zip(columns, kinds)],
                        names=["query_row", "query_id", "vec_id", "row", "score"])

    return search


def nearest(
    vectors: DataFrame, queries: str = "vec_id % 20 = 0", k: int = 20, id_col: str = "vec_id",
    vec_col: str = "embedding", pivots: int = PIVOTS, prefix: int = PREFIX, share: float = SHARE,
    least: int = LEAST,
) -> DataFrame:
    """The k nearest found of each query among all other rows: query_id, rank (from 1), vec_id,
    score. ``queries`` is a condition on the columns of ``vectors``.

    Score is the inner product in double precision, a missing component counts as 0; ties go to
    the smaller id. Rows whose id or vector is NULL, and vectors that are empty, all zero, or hold a
    NULL or a component that is not finite take no part. A row is itself: of rows that repeat an
    id, or an id and a vector, each is a candidate, also for a query of that id, and each query row
    asks for itself. Fewer than k other rows give all of them; no query rows or an empty table
    give no rows. Other columns play no part.
    """
    x = F.col("vec")
    rows = stage(
        vectors.select(
            F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("vec"),
            F.coalesce(F.expr(queries), F.lit(False)).alias("is_query"))
        .where(F.col("id").isNotNull() & x.isNotNull() & F.exists(x, lambda v: v != 0) & ~F.exists(
            x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf"))))
        .withColumn("row", F.monotonically_increasing_id()), "vectors")
    n, asked, scale, width = rows.agg(
        F.count("*"), F.count_if("is_query"), F.max(F.array_max(F.transform(x, F.abs))),
        F.max(F.size(x))).first()
    scale, width = scale or 1.0, width or 1
    square = F.aggregate(x, F.lit(0.0), lambda s, v: s + (v / scale) * (v / scale))
    longest = float(np.sqrt(rows.agg(F.max(square)).first()[0] or 1.0))
    sample = rows.orderBy(F.xxhash64("row"), "row").limit(PIVOT_SAMPLE).select("vec").toArrow()
    distinct = np.zeros((0, width))
    if sample.num_rows:
        held = matrix(sample["vec"], width)
        _, first = np.unique(held, axis=0, return_index=True)
        distinct = held[np.sort(first)[:min(pivots, PIVOTS)]]
    chosen = filled(distinct / scale, longest)

    indexed = stage(rows.mapInArrow(
        _permute(chosen, min(prefix, len(chosen)), longest, scale),
        "id long, vec array<double>, is_query boolean, row long, perm binary, asked binary",
    ), "permutations")
    shards, blocks = max(1, -(-n // SHARD_ROWS)), max(1, -(-asked // QUERY_ROWS))

    def dealt(df: DataFrame, perm: str, own: str, size: int, other: str, times: int) -> DataFrame:
        return df.withColumn(own, F.pmod(F.xxhash64("row"), F.lit(size)).cast("int")).withColumn(
            other, F.explode(F.sequence(F.lit(0), F.lit(times - 1)))
        ).select("shard", "block", F.lit(perm == "asked").alias("is_query"), "id", "row", "vec",
                 F.col(perm).alias("perm"))

    cells = dealt(indexed, "perm", "shard", shards, "block", blocks).unionByName(
        dealt(indexed.where("is_query"), "asked", "block", blocks, "shard", shards))
    found = cells.groupBy("shard", "block").applyInArrow(
        _search(k, share, least),
        "query_row long, query_id long, vec_id long, row long, score double")
    place = F.row_number().over(
        Window.partitionBy("query_row").orderBy(F.desc("score"), F.asc("vec_id"), F.asc("row")))
    return found.withColumn("rank", place).where(F.col("rank") <= k) \
        .select("query_id", "rank", "vec_id", "score")
