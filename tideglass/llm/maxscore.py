"""Exact top-k search by MaxScore (operator 1).

A vector is a bag of terms: its dimensions with non-zero weights. Candidates are dealt by hash
into shards, queries into blocks, and each (shard, block) cell is one group: both sides are
repeated only as often as the other has blocks, cells are bounded, and no pair becomes a row.

Within a cell there is a postings list a dimension. For a query, a list's bound is the largest
product it can give. The lists of least bounds whose bounds add up to less than the k-th best
score so far are non-essential: a candidate that is only in those cannot compete. The essential
lists are traversed; then, bound by bound, the others are probed for the candidates that can
still reach the k-th best score. Cells' answers are merged by a ranking per query.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from tideglass.sources.workspace import stage

SHARD_ROWS = 8192
QUERY_ROWS = 512
SEED_LISTS = 4       # lists, those of the highest bounds, whose largest entries start the search
SEED_ENTRIES = 16


class Shard:
    """Postings of a shard: by dimension, the rows with a weight there, ordered by weight; and
    the same weights by row for probing. ``ids`` ascend, so that a lower row wins a tie."""

    def __init__(self, ids: np.ndarray, weights: np.ndarray) -> None:
        order = np.argsort(ids, kind="stable")
        self.ids, self.weights = ids[order], weights[order]
        self.columns = np.ascontiguousarray(self.weights.T)
        by_weight = np.argsort(self.columns, axis=1, kind="stable")
        self.rows, self.low, self.high = [], [], []
        for column, ordered in zip(self.columns, by_weight):
            rows = ordered[column[ordered] != 0]
            self.rows.append(rows)
            self.low.append(int(column[rows[0]]) if len(rows) else 0)
            self.high.append(int(column[rows[-1]]) if len(rows) else 0)
        self.low, self.high = np.array(self.low), np.array(self.high)
        self.whole = [len(r) == len(self.ids) for r in self.rows]

    def top(self, own_id: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, scores) of the k best candidates for a query, fewer if there are fewer."""
        bound = np.maximum(np.maximum(query * self.low, query * self.high), 0)
        dims = np.argsort(-bound, kind="stable")
        dims = dims[(query[dims] != 0)]
        own = slice(*(int(np.searchsorted(self.ids, own_id, side)) for side in ("left", "right")))
        if len(self.ids) - (own.stop - own.start) <= k:
            rows = np.flatnonzero(self.ids != own_id)
            return self.ids[rows], self.weights[rows] @ query
        floor = self._start(own, query, dims, k)

        # Non-essential: the longest tail of bounds that adds up to less than the k-th best score.
        tail = np.concatenate([np.cumsum(bound[dims][::-1])[::-1], [0]])
        essential = int(np.argmax(tail < floor)) if (tail < floor).any() else len(dims)
        score = np.zeros(len(self.ids), dtype=np.int64)
        touched = np.zeros(len(self.ids), dtype=bool)
        for d in dims[:essential]:
            if self.whole[d]:
                score += query[d] * self.columns[d]
                touched[:] = True
            else:
                rows = self.rows[d]
                score[rows] += query[d] * self.columns[d][rows]
                touched[rows] = True
        if essential == len(dims):  # even a candidate without any term can be among the best
            touched[:] = True
        touched[own] = False
        rows = np.flatnonzero(touched & (score + tail[essential] >= floor))
        score = score[rows]
        for k_dim in range(essential, len(dims)):
            d = dims[k_dim]
            score = score + query[d] * self.columns[d][rows]
            able = score + tail[k_dim + 1] >= floor
            if not able.all():
                rows, score = rows[able], score[able]
        best = np.lexsort((rows, -score))[:k]
        return self.ids[rows[best]], score[best]

    def _start(self, own: slice, query: np.ndarray, dims: np.ndarray, k: int) -> float:
        """A score that k candidates reach for sure: the k-th best of a few promising ones."""
        rows = [np.arange(min(len(self.ids), k + own.stop - own.start))]
        for d in dims[:SEED_LISTS]:
            listed = self.rows[d]
            rows.append(listed[-SEED_ENTRIES:] if query[d] > 0 else listed[:SEED_ENTRIES])
        rows = np.unique(np.concatenate(rows))
        rows = rows[(rows < own.start) | (rows >= own.stop)]
        scores = self.weights[rows] @ query
        return float(np.partition(scores, len(scores) - k)[len(scores) - k])


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    """The arrays as rows of a matrix, filled up with 0."""
    lists = column.combine_chunks()
    size = np.asarray(pc.list_value_length(lists), dtype=np.int64)
    out = np.zeros((len(lists), int(size.max(initial=0))), dtype=np.int64)
    row = np.repeat(np.arange(len(lists)), size)
    out[row, np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)] = lists.flatten()
    return out


def _search(k: int) -> Callable[[pa.Table], pa.Table]:
    """The k best of a cell's candidates for each of its queries."""
    def search(cell: pa.Table) -> pa.Table:
        ask = np.asarray(cell["is_query"])
        ids, weights = np.asarray(cell["id"]), _matrix(cell["vec"])
        out: list[tuple[int, int, int]] = []
        if ask.any() and not ask.all():
            shard = Shard(ids[~ask], weights[~ask])
            for own, query in zip(ids[ask].tolist(), weights[ask]):
                found, scores = shard.top(own, query, k)
                out += [(own, i, s) for i, s in zip(found.tolist(), scores.tolist())]
        columns = list(zip(*out)) or [[], [], []]
        return pa.table([pa.array(c, pa.int64()) for c in columns],
                        names=["query_id", "vec_id", "score"])

    return search


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, id_col: str = "vec_id",
          vec_col: str = "vec") -> DataFrame:
    """The k best candidates of each query: query_id, rank (from 1), vec_id, score.

    Both sides hold (id, array of integers). The score is the inner product, a missing component
    counts as 0; ties go to the smaller id. Of several rows with one id each is a candidate, but
    none for a query of that id; of several query rows with one id the smallest array asks. Rows
    with a NULL id, a NULL array or a NULL component take no part. No queries or no other
    candidates give no rows. Other columns play no part.
    """
    def slim(df: DataFrame) -> DataFrame:
        return (
            df.select(F.col(id_col).cast("long").alias("id"),
                      F.col(vec_col).cast("array<long>").alias("vec"))
            .where("id is not null and vec is not null and not exists(vec, x -> x is null)")
        )

    candidates = stage(slim(vectors), "search-rows")
    asked = stage(slim(queries).groupBy("id").agg(F.min("vec").alias("vec")), "search-queries")
    shards = max(1, -(-candidates.count() // SHARD_ROWS))
    blocks = max(1, -(-asked.count() // QUERY_ROWS))

    def dealt(df: DataFrame, own: str, n: int, other: str, m: int, is_query: bool) -> DataFrame:
        return df.withColumn(own, F.pmod(F.xxhash64("id"), F.lit(n)).cast("int")).withColumn(
            other, F.explode(F.sequence(F.lit(0), F.lit(m - 1)))
        ).select("shard", "block", F.lit(is_query).alias("is_query"), "id", "vec")

    cells = dealt(candidates, "shard", shards, "block", blocks, False).unionByName(
        dealt(asked, "block", blocks, "shard", shards, True))
    found = cells.groupBy("shard", "block").applyInArrow(
        _search(k), "query_id long, vec_id long, score long")
    place = F.row_number().over(
        Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc("vec_id")))
    return found.withColumn("rank", place).where(F.col("rank") <= k) \
        .select("query_id", "rank", "vec_id", "score")
