"""Places and ranks inside groups of any size, in two passes.

A window function ranks a group in one task. Here the rows are sorted over all tasks by range, a
task numbers its own rows, and what the tasks before it hold of a group is added: a prefix sum over
one row for each (task, group). A group that holds most rows is so ranked by many tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tideglass.sources.workspace import stage

_INDEX_BITS = 33  # of monotonically_increasing_id: the place of a row in its partition
_INNER = ["_task", "_index"]


def _sorted_over_tasks(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The rows, written once in the order of (keys, order), with the task and the place in it.
    Written, because the sampled borders of the ranges hold for one execution only."""
    by = [*[F.asc_nulls_first(k) for k in keys], *order]
    number = F.monotonically_increasing_id()
    return stage(
        df.repartitionByRange(*by).sortWithinPartitions(*by).select(
            "*", F.shiftright(number, _INDEX_BITS).cast("int").alias("_task"),
            number.bitwiseAND((1 << _INDEX_BITS) - 1).alias("_index")), "ranked")


def _joined(left: DataFrame, right: DataFrame, on: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """``left`` with the columns ``keep`` of ``right``; NULL keys are equal."""
    named = right.select(*[F.col(c).alias(f"_r_{c}") for c in on], *keep)
    same = F.lit(True)
    for c in on:
        same = same & left[c].eqNullSafe(named[f"_r_{c}"])
    return left.join(named, same).drop(*[f"_r_{c}" for c in on])


def _placed(df: DataFrame, keys: Sequence[str], order: Sequence[Column], name: str) -> DataFrame:
    rows = _sorted_over_tasks(df, keys, order)
    per_task = rows.groupBy("_task", *keys).agg(
        F.min("_index").alias("_first"), F.count("*").alias("_n"))
    before = F.sum("_n").over(
        W.partitionBy(*keys).orderBy("_task").rowsBetween(W.unboundedPreceding, -1))
    # One row for each task that holds rows of a group, so as many at most as there are tasks.
    offsets = per_task.withColumn("_before", F.coalesce(before, F.lit(0)) - F.col("_first"))
    return _joined(rows, offsets, ["_task", *keys], ["_before"]).withColumn(
        name, F.col("_index") + F.col("_before") + 1).drop("_before")


def number_rows(df: DataFrame, keys: Sequence[str], order: Sequence[Column],
                name: str = "place") -> DataFrame:
    """``df`` with the place (from 1) of each row among the rows of its ``keys``, by ``order``.

    NULL keys are a group. Rows that ``order`` does not tell apart get different places in no
    defined order, and stay in one task: let ``order`` end with columns that tell rows apart.
    An empty table gives no rows.
    """
    return _placed(df, keys, order, name).drop(*_INNER)


def rank_rows(df: DataFrame, keys: Sequence[str], score: str, name: str = "rank",
              spread: Sequence[str] = ()) -> DataFrame:
    """``df`` with the competition rank by descending ``score`` (NULL last) inside ``keys``: equal
    scores share the first place that one of them takes. ``spread`` names columns by which rows
    of one score may be dealt to several tasks; they do not change a rank."""
    place = "_place"
    rows = _placed(df, keys, [F.desc_nulls_last(score), *[F.asc(c) for c in spread]], place)
    # A score that begins in an earlier task: its first place there counts in every later task.
    firsts = rows.groupBy("_task", *keys, score).agg(F.min(place).alias("_own")).withColumn(
        name, F.min("_own").over(W.partitionBy(*keys, score)))
    return _joined(rows, firsts, ["_task", *keys, score], [name]).drop(*_INNER, place)
