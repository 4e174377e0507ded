import random
from datetime import date, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tideglass.operators.changes import affected_windows
from tideglass.operators.marts import date_spine
from tideglass.operators.periods import MONTHS, period_windows
from tideglass.operators.running import read_totals, refresh_totals, sums_at, write_totals
from tideglass.operators.windows import sums_for_anchors

FIRST, LAST = date(2020, 11, 1), date(2021, 3, 31)
KIND = "date date, k string, revenue decimal(20,6), orders long"


def facts(spark, seed, days=150):
    rng = random.Random(seed)
    rows = [(FIRST + timedelta(rng.randrange(-60, days)), rng.choice(["a", "b", None, "rare"[: rng.randrange(5)]]),
             Decimal(rng.randrange(-500, 5000)) / 100, rng.randrange(3)) for _ in range(400)]
    return spark.createDataFrame(rows, KIND)


def plain(df):
    return sorted((tuple(map(str, r)) for r in df.select(*sorted(df.columns)).collect()))


@pytest.mark.parametrize("keys", [[], ["k"]])
@pytest.mark.parametrize("month", MONTHS)
def test_point_sums_equal_the_dense_series(spark, tmp_path, keys, month):
    given, path = facts(spark, 1), str(tmp_path / "t")
    write_totals(given, path, ["revenue", "orders"], LAST, keys)
    windows = period_windows(date_spine(spark, FIRST, LAST), FIRST, month)
    got = sums_at(read_totals(spark, path), windows, ["revenue", "orders"], keys)
    want = sums_for_anchors(given, FIRST, LAST, FIRST, month, ["revenue", "orders"], keys)
    assert plain(got.select(*want.columns)) == plain(want)


@pytest.mark.parametrize("changed_from", [date(2020, 9, 1), date(2020, 12, 1), date(2021, 1, 17), LAST])
def test_refresh_equals_building_anew(spark, tmp_path, changed_from):
    before, after = facts(spark, 2), facts(spark, 3)
    now = before.where(F.col("date") < F.lit(changed_from)).unionByName(
        after.where(F.col("date") >= F.lit(changed_from)))
    one, two = str(tmp_path / "one"), str(tmp_path / "two")
    write_totals(before, one, ["revenue"], LAST, ["k"])
    refresh_totals(now, one, ["revenue"], changed_from, LAST, ["k"])
    write_totals(now, two, ["revenue"], LAST, ["k"])
    windows = period_windows(date_spine(spark, FIRST, LAST), FIRST, "calendar")
    got, want = (sums_at(read_totals(spark, p), windows, ["revenue"], ["k"]) for p in (one, two))
    assert plain(got) == plain(want)


def test_refresh_takes_up_later_months(spark, tmp_path):
    given, path = facts(spark, 4), str(tmp_path / "t")
    write_totals(given.where("date < '2020-12-10'"), path, ["revenue"], date(2020, 12, 9), ["k"])
    refresh_totals(given, path, ["revenue"], date(2020, 12, 10), LAST, ["k"])
    write_totals(given, str(tmp_path / "whole"), ["revenue"], LAST, ["k"])
    windows = period_windows(date_spine(spark, FIRST, LAST), FIRST, "rolling30")
    assert plain(sums_at(read_totals(spark, path), windows, ["revenue"], ["k"])) == plain(
        sums_at(read_totals(spark, str(tmp_path / "whole")), windows, ["revenue"], ["k"]))


@pytest.mark.parametrize("month", MONTHS)
@pytest.mark.parametrize("days", [
    [], [date(2020, 11, 1)], [date(2021, 3, 31)], [date(2020, 9, 20), None], [date(2020, 6, 1)],
    [date(2021, 1, 29), date(2021, 1, 30), date(2021, 2, 28), date(2021, 2, 28)], [date(2021, 6, 1)],
])
def test_affected_windows_equal_brute_force(spark, month, days):
    given = spark.createDataFrame([(d,) for d in days], "date date")
    got = affected_windows(given, FIRST, LAST, FIRST, month).collect()
    every = period_windows(date_spine(spark, FIRST, LAST), FIRST, month).collect()
    want = [r for r in every if any(d and r.prev_start <= d <= r.window_end for d in days)]
    assert sorted(map(tuple, got)) == sorted(map(tuple, want))
