"""Trend signals on dense daily series (W4-W6, W9, W10). ``keys`` makes them per channel."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, Window as W, functions as F

from tideglass.functions.scalars import ratio
from tideglass.operators.marts import daily_totals, dense_series
from tideglass.schemas import CHANNEL

COMPARISONS = ("YoY", "QoQ", "MoM", "WoW")


def _series(keys: Sequence[str]):
    return W.partitionBy(*keys).orderBy("date")


def moving_average(
    series: DataFrame, value: str = "revenue", days: int = 7, keys: Sequence[str] = ()
) -> DataFrame:
    """Adds ``<value>_ma<days>``: the mean of this day and the days before it, fewer at the start."""
    frame = _series(keys).rowsBetween(1 - days, 0)
    mean = F.sum(value).over(frame).cast("double") / F.count(value).over(frame).cast("double")
    return series.withColumn(f"{value}_ma{days}", mean)


def lag_delta(
    series: DataFrame, value: str = "revenue", days: int = 7, keys: Sequence[str] = ()
) -> DataFrame:
    """Adds the value ``days`` ago, the change since then, and the change as a share of it."""
    ago = F.lag(value, days).over(_series(keys))
    with_lag = series.withColumn(f"{value}_lag{days}", ago)
    delta = F.col(value) - F.col(f"{value}_lag{days}")
    return with_lag.select(
        "*",
        delta.cast("double").alias(f"{value}_delta{days}"),
        ratio(delta, F.col(f"{value}_lag{days}")).alias(f"{value}_pct{days}"),
    )


def zscore_flags(
    series: DataFrame,
    value: str = "revenue",
    days: int = 28,
    threshold: float = 2.0,
    keys: Sequence[str] = (),
) -> DataFrame:
    """Adds ``zscore`` against the ``days`` days before (NULL where they do not vary) and
    ``is_anomaly`` where it is at least ``threshold`` either way."""
    frame = _series(keys).rowsBetween(-days, -1)
    x = F.col(value).cast("double")
    scored = series.withColumn(
        "zscore", ratio(x - F.avg(x).over(frame), F.stddev_samp(x).over(frame))
    )
    return scored.withColumn(
        "is_anomaly", F.coalesce(F.abs("zscore") >= F.lit(threshold), F.lit(False))
    )


def channel_daily(attribution: DataFrame, first: date, last: date) -> DataFrame:
    """Revenue and orders of every channel on every day."""
    return dense_series(attribution, ["revenue", "orders"], first, last, CHANNEL)


def channel_trends(attribution: DataFrame, first: date, last: date) -> DataFrame:
    """The trend signals for each channel. All windows share the channel partitioning of the
    series, so they add no shuffle to it."""
    series = channel_daily(attribution, first, last)
    return zscore_flags(
        lag_delta(moving_average(series, keys=CHANNEL), keys=CHANNEL), keys=CHANNEL
    )


def period_over_period(series: DataFrame, value: str = "revenue") -> DataFrame:
    """Each day against the day one year, quarter, month and week before, where there is one.

    An equi-join of the daily series with itself: four rows per calendar day.
    """
    base_day = F.array(
        *[F.struct(F.lit(n).alias("comparison"), F.add_months("date", -m).alias("base_date"))
          for n, m in zip(COMPARISONS, (12, 3, 1))],
        F.struct(F.lit("WoW").alias("comparison"), F.date_sub("date", 7).alias("base_date")),
    )
    base = daily_totals(series, [value]).select(
        F.col("date").alias("base_date"), F.col(value).alias(f"base_{value}")
    )
    days = series.select("date", value, F.explode(base_day).alias("c")) \
        .select("date", value, "c.*")
    delta = F.col(value) - F.col(f"base_{value}")
    return days.join(base, "base_date").select(
        "date", "comparison", "base_date", value, f"base_{value}",
        delta.cast("double").alias("delta_abs"),
        ratio(delta, F.col(f"base_{value}")).alias("delta_pct"),
    )
