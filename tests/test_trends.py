import statistics
from datetime import date, timedelta
from decimal import Decimal

import pytest

from tideglass.operators.trends import (
    channel_trends, lag_delta, moving_average, period_over_period, zscore_flags,
)

START = date(2020, 1, 1)


def series(spark, values):
    return spark.createDataFrame(
        [(START + timedelta(days=i), Decimal(v)) for i, v in enumerate(values)],
        "date date, revenue decimal(30,6)")


VALUES = [(i * 37) % 101 for i in range(60)]


def test_moving_average(spark):
    rows = moving_average(series(spark, VALUES)).orderBy("date").collect()
    for i, row in enumerate(rows):
        window = VALUES[max(0, i - 6): i + 1]
        assert row.revenue_ma7 == sum(window) / len(window)


def test_lag_delta(spark):
    rows = lag_delta(series(spark, [0] * 7 + [5, 10])).orderBy("date").collect()
    assert rows[6].revenue_delta7 is None
    # from nothing there is a change but no rate
    assert (rows[7].revenue_delta7, rows[7].revenue_pct7) == (5.0, None)


def test_zscore(spark):
    rows = zscore_flags(series(spark, VALUES)).orderBy("date").collect()
    for i, row in enumerate(rows):
        window = VALUES[max(0, i - 28): i]
        if len(window) < 2:
            assert row.zscore is None and row.is_anomaly is False
        else:
            z = (VALUES[i] - statistics.mean(window)) / statistics.stdev(window)
            assert row.zscore == pytest.approx(z)
            assert row.is_anomaly == (abs(z) >= 2)


def test_constant_series_has_no_score(spark):
    rows = zscore_flags(series(spark, [7] * 40 + [100])).collect()
    assert {r.zscore for r in rows} == {None}
    assert not any(r.is_anomaly for r in rows)


def test_threshold_and_window_are_parameters(spark):
    rows = zscore_flags(series(spark, [1, 2, 1, 2, 9]), days=4, threshold=20.0).orderBy("date").collect()
    assert rows[4].zscore > 10 and not rows[4].is_anomaly


def test_period_over_period_clamps_month_ends(spark):
    rows = {(r.date, r.comparison): r for r in period_over_period(series(spark, range(500))).collect()}
    leap = rows[date(2021, 2, 28), "YoY"]
    assert leap.base_date == date(2020, 2, 28)
    assert rows[date(2020, 3, 31), "MoM"].base_date == date(2020, 2, 29)
    assert (date(2020, 1, 7), "WoW") not in rows
    week = rows[date(2020, 1, 8), "WoW"]
    assert (float(week.revenue), float(week.base_revenue), week.delta_abs, week.delta_pct) == (7, 0, 7, None)


def test_channel_trends_fill_gaps_per_channel(spark):
    df = spark.createDataFrame(
        [(START, "a", None, "x", Decimal(7), 1), (START + timedelta(days=9), "a", None, "x", Decimal(14), 1),
         (START + timedelta(days=3), "b", "m", "x", Decimal(1), 1)],
        "date date, source string, medium string, campaign string, revenue decimal(30,6), orders bigint")
    rows = channel_trends(df, START, START + timedelta(days=9)).collect()
    assert len(rows) == 20
    a = {r.date: r for r in rows if r.source == "a"}
    assert a[START + timedelta(days=6)].revenue_ma7 == 1.0
    assert a[START + timedelta(days=7)].revenue_delta7 == -7.0
    assert a[START + timedelta(days=9)].revenue_ma7 == 2.0
