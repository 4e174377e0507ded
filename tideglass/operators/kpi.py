"""Window KPIs with comparison to the window before."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tideglass.functions.scalars import daily_money, ratio
from tideglass.operators.marts import zero_fill
from tideglass.operators.periods import Window
from tideglass.operators.windows import LABELS, sums_for_anchors, sums_for_windows
from tideglass.schemas import KPI

MEASURES = ("revenue", "orders")


def kpi_columns(sums: DataFrame) -> DataFrame:
    """Window sums to KPI rows. An average over no orders is 0; a change from nothing is NULL."""
    revenue, orders = F.col("revenue_cur").cast("double"), F.col("orders_cur").cast("bigint")
    before, before_n = F.col("revenue_prev").cast("double"), F.col("orders_prev").cast("bigint")
    delta = (F.col("revenue_cur") - F.col("revenue_prev")).cast("double")
    return sums.select(
        *LABELS,
        revenue.alias("revenue"),
        orders.alias("orders"),
        F.coalesce(ratio(revenue, orders), F.lit(0.0)).alias("aov"),
        before.alias("prev_revenue"),
        before_n.alias("prev_orders"),
        F.coalesce(ratio(before, before_n), F.lit(0.0)).alias("prev_aov"),
        delta.alias("delta_abs"),
        ratio(delta, before).alias("delta_pct"),
    )


def kpis(purchases: DataFrame, windows: Sequence[Window]) -> DataFrame:
    """KPI rows of a handful of windows, in one scan."""
    return kpi_columns(sums_for_windows(purchases, windows, MEASURES))


def kpi_history(
    purchases: DataFrame, first: date, last: date, min_date: date, month: str
) -> DataFrame:
    """KPI rows of all four windows of every anchor, in one pass over the daily series."""
    return kpi_columns(sums_for_anchors(purchases, first, last, min_date, month, MEASURES))


def kpi_struct() -> Column:
    """The KPI columns as the record that is stored with an insight."""
    return F.struct(*[F.col(f.name) for f in KPI.fields])


def rolling_kpis(
    purchases: DataFrame, spine: DataFrame, measures: Sequence[str] = MEASURES
) -> DataFrame:
    """One row per date with rolling day, week, 30-day month and total of each measure, and the
    periods before. Window frames over the daily series: one row per calendar day, so a single
    sorted partition is enough for any amount of events behind it."""
    exact = purchases.select(
        "date", *[daily_money(F.col(m)).alias(m) if m == "revenue" else F.col(m) for m in measures]
    )
    # Facts before the spine count in the frames that reach back to them.
    days = spine.select("date").unionByName(exact.select("date")).distinct()
    number = F.unix_date("date")
    series = zero_fill(exact, days, measures).withColumn("_n", number)
    order = W.orderBy("_n")
    frames = {
        "day": (0, 0), "week": (-6, 0), "month": (-29, 0),
        "prev_day": (-1, -1), "prev_week": (-13, -7), "prev_month": (-59, -30),
    }
    columns = [
        F.coalesce(F.sum(m).over(order.rangeBetween(*frame)), F.lit(0))
        .alias(f"{name}_{m}")
        for m in measures for name, frame in frames.items()
    ] + [
        F.sum(m).over(order.rangeBetween(W.unboundedPreceding, 0)).alias(f"total_{m}")
        for m in measures
    ]
    return series.select("date", *columns).join(spine.select("date"), "date", "left_semi")
