from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from tideglass.operators.marts import date_spine
from tideglass.operators.periods import canonical, period_windows, single_window, windows_of_anchor

MIN = date(2020, 11, 1)


def d(text):
    return date.fromisoformat(text)


CASES = [
    ("2021-01-31", "Day", "rolling30", "2021-01-31", "2021-01-30", "2021-01-30"),
    ("2021-01-31", "Week", "rolling30", "2021-01-25", "2021-01-18", "2021-01-24"),
    ("2021-01-31", "Month", "rolling30", "2021-01-02", "2020-12-03", "2021-01-01"),
    ("2021-01-31", "Month", "calendar", "2021-01-01", "2020-12-01", "2020-12-31"),
    ("2021-01-31", "Total", "calendar", "2020-11-01", "2020-08-01", "2020-10-31"),
    ("2021-03-31", "Month", "calendar", "2021-03-01", "2021-01-29", "2021-02-28"),
    ("2021-03-28", "Month", "calendar", "2021-03-01", "2021-02-01", "2021-02-28"),
    ("2020-03-30", "Month", "calendar", "2020-03-01", "2020-01-31", "2020-02-29"),
]


@pytest.mark.parametrize("anchor, kind, month, start, prev_start, prev_end", CASES)
def test_windows(spark, anchor, kind, month, start, prev_start, prev_end):
    windows = {w.insight_type: w for w in windows_of_anchor(spark, MIN, d(anchor), month)}
    w = windows[kind]
    assert (w.window_start, w.window_end, w.prev_start, w.prev_end) == (
        d(start), d(anchor), d(prev_start), d(prev_end))


def test_four_rows_per_anchor_and_equal_lengths(spark):
    anchors = date_spine(spark, date(2020, 1, 1), date(2021, 3, 31))
    for month in ("rolling30", "calendar"):
        rows = period_windows(anchors, MIN, month)
        assert rows.count() == 4 * anchors.count()
        uneven = rows.where(F.datediff("window_end", "window_start")
                            != F.datediff("prev_end", "prev_start"))
        assert uneven.count() == 0
        assert rows.where("prev_end <> date_sub(window_start, 1)").count() == 0


def test_period_names():
    assert [canonical(p) for p in ("total", "MONTH", " Week ")] == ["Total", "Month", "Week"]
    with pytest.raises(ValueError):
        canonical("quarter")


def test_unknown_month_rule(spark):
    with pytest.raises(ValueError):
        period_windows(date_spine(spark, MIN, MIN), MIN, "lunar")


def test_free_window():
    w = single_window(date(2021, 1, 10), date(2021, 1, 12))
    assert (w.prev_start, w.prev_end) == (date(2021, 1, 7), date(2021, 1, 9))
    assert w.prev_end - w.prev_start == timedelta(days=2)
