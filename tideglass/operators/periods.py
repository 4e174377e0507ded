"""Insight windows: anchor date and period to inclusive [start, end] and the one before (K1-K3)."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

PERIODS = ("Total", "Month", "Week", "Day")
MONTHS = ("rolling30", "calendar")
WINDOW_COLUMNS = ("window_start", "window_end", "prev_start", "prev_end")


def canonical(period: str) -> str:
    """Title case of a known period; anything else is an error."""
    name = period.strip().title()
    if name not in PERIODS:
        raise ValueError(f"unknown period {period!r}")
    return name


def _as_date(day: Column | date | str) -> Column:
    return day if isinstance(day, Column) else F.to_date(F.lit(str(day)))


def window_start(anchor: Column, period: str, min_date: Column, month: str) -> Column:
    """First day of the window. Month is either the last 30 days or the days since the same day
    of the month before (28 to 31 of them)."""
    if month not in MONTHS:
        raise ValueError(f"unknown month rule {month!r}")
    match canonical(period):
        case "Day":
            return anchor
        case "Week":
            return F.date_sub(anchor, 6)
        case "Month" if month == "rolling30":
            return F.date_sub(anchor, 29)
        case "Month":
            return F.date_add(F.add_months(anchor, -1), 1)
        case _:
            return min_date


def bounds(anchor: Column, period: str, min_date: Column | date | str, month: str) -> Column:
    """The four window dates as one struct; the previous window has the same length and ends the
    day before the start."""
    start = window_start(anchor, period, _as_date(min_date), month)
    length = F.datediff(anchor, start) + 1
    return F.struct(
        start.alias("window_start"), anchor.alias("window_end"),
        F.date_sub(start, length).alias("prev_start"), F.date_sub(start, 1).alias("prev_end"),
    )


def period_windows(
    anchors: DataFrame,
    min_date: Column | date | str,
    month: str = "rolling30",
    periods: Sequence[str] = PERIODS,
    anchor: str = "date",
) -> DataFrame:
    """One row per anchor and period."""
    day = F.col(anchor)
    rows = F.array(*[
        F.struct(
            F.lit(canonical(p)).alias("insight_type"),
            bounds(day, p, min_date, month).alias("w"),
        )
        for p in periods
    ])
    return anchors.select(day.alias("insight_date"), F.explode(rows).alias("r")).select(
        "insight_date", "r.insight_type", "r.w.*"
    )


def window_label(start: str = "window_start", end: str = "window_end") -> Column:
    """What a window is called beside its figures: "On 2021-01-31", "Last 7 days to 2021-01-31"."""
    days = F.datediff(end, start) + 1
    return F.when(days == 1, F.format_string("On %s", F.col(end).cast("string"))).otherwise(
        F.format_string("Last %d days to %s", days, F.col(end).cast("string")))


@dataclass(frozen=True)
class Window:
    """One window as plain dates, for a run over a handful of windows."""

    insight_date: date
    insight_type: str | None
    window_start: date
    window_end: date
    prev_start: date
    prev_end: date


def windows_of_anchor(
    spark: SparkSession, min_date: date, anchor: date, month: str
) -> list[Window]:
    """The four windows of one anchor as plain dates. Runs a job over four rows."""
    one = spark.range(1).select(F.lit(anchor).alias("date"))
    return [Window(**r.asDict()) for r in period_windows(one, min_date, month).collect()]


def single_window(start: date, end: date) -> Window:
    """A free window, stored under its last day, without a period name."""
    length = (end - start).days + 1
    before = date.fromordinal(start.toordinal() - 1)
    return Window(end, None, start, end, date.fromordinal(start.toordinal() - length), before)
