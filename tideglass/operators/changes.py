"""From changed days to the windows that they change."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, functions as F

from tideglass.operators.periods import PERIODS, period_windows

LONGEST = 61  # days from the start of a window before to the anchor, of all periods but Total


def affected_windows(days: DataFrame, first: date, last: date, min_date: date, month: str) -> DataFrame:
    """The windows of anchors ``first``..``last`` that a changed day lies in, now or in the window
    before: the columns of ``period_windows``.

    A window and the one before it are one interval, ``prev_start``..anchor. Inverted, a day reaches
    the anchors of the next two months at most, each of which is tested against its own interval
    (a calendar month's start is no monotone function of its anchor); and every Total window from
    an anchor on, the day itself or, for a day before ``min_date``, as far behind it as the day is
    before. ``days`` has a column ``date``; NULL and repeated days change nothing.
    """
    given = days.select(F.col("date").alias("changed")).where("changed is not null").distinct()
    low, high = F.greatest("changed", F.lit(first)), F.least(F.date_add("changed", LONGEST), F.lit(last))
    near = given.where(low <= high).select("changed", F.explode(F.sequence(low, high)).alias("date"))
    short = period_windows(
        near.select("date").distinct(), min_date, month, [p for p in PERIODS if p != "Total"])
    hit = near.select("changed", F.col("date").alias("_anchor")).join(
        short, F.col("_anchor") == F.col("insight_date")).where("changed >= prev_start")
    # The earliest anchor whose Total window holds a changed day: one row.
    mirrored = F.date_sub(F.date_add(F.lit(min_date), F.datediff(F.lit(min_date), "changed")), 1)
    reach = F.when(F.col("changed") >= F.lit(min_date), F.col("changed")).otherwise(mirrored)
    anchors = given.agg(F.min(reach).alias("reach")).where("reach is not null").select(
        F.greatest("reach", F.lit(first)).alias("low")).where(F.col("low") <= F.lit(last)).select(
        F.explode(F.sequence("low", F.lit(last))).alias("date"))
    return hit.drop("changed", "_anchor").distinct().unionByName(
        period_windows(anchors, min_date, month, ["Total"]))
