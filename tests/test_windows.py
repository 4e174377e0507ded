"""Both ways to window sums against brute force, KPIs, and the frame-based rolling form."""

import random
from datetime import date, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tideglass.operators.kpi import kpi_history, kpis, rolling_kpis
from tideglass.operators.marts import date_spine
from tideglass.operators.periods import period_windows, single_window, windows_of_anchor
from tideglass.operators.windows import sums_for_anchors, sums_for_windows
from tideglass.schemas import CHANNEL

FIRST, LAST = date(2020, 12, 20), date(2021, 4, 5)
MIN = date(2020, 12, 25)      # facts and anchors lie before it as well
SCHEMA = "date date, source string, medium string, campaign string, revenue decimal(30,6), orders bigint"


def facts(spark, seed, days=200, rows=150, start=date(2020, 10, 1)):
    rng = random.Random(seed)
    seen = {}
    for _ in range(rows):
        channel = rng.choice([("a", "x", None), ("a", None, "s"), ("b", "x", "s"), (None,) * 3])
        day = start + timedelta(days=rng.randrange(days))
        seen[(day, *channel)] = (Decimal(rng.randrange(-200, 10000)) / 100, rng.randrange(4))
    return spark.createDataFrame([(*k, *v) for k, v in seen.items()], SCHEMA), seen


def brute(seen, windows, channels=True):
    out = {}
    for w in windows:
        for (day, *channel), (revenue, orders) in seen.items():
            if w.window_start <= day <= w.window_end:
                side = 0
            elif w.prev_start <= day <= w.prev_end:
                side = 1
            else:
                continue
            key = (w.insight_date, w.insight_type, *(channel if channels else ()))
            sums = out.setdefault(key, [Decimal(0), Decimal(0), 0, 0])
            sums[side] += revenue
            sums[2 + side] += 1
    return out


def as_dict(df, keys=()):
    return {
        (r.insight_date, r.insight_type, *[r[k] for k in keys]):
            [r.revenue_cur, r.revenue_prev, r.n_cur, r.n_prev]
        for r in df.where("n_cur > 0 or n_prev > 0").collect()
    }


@pytest.mark.parametrize("month", ["rolling30", "calendar"])
@pytest.mark.parametrize("seed", [1, 2])
def test_series_equals_brute_force(spark, month, seed):
    df, seen = facts(spark, seed)
    anchors = date_spine(spark, FIRST, LAST)
    windows = period_windows(anchors, MIN, month).collect()
    got = sums_for_anchors(df, FIRST, LAST, MIN, month, ["revenue"], CHANNEL)
    assert as_dict(got, CHANNEL) == brute(seen, windows)
    stored = {(r.insight_date, r.insight_type): tuple(r)[2:] for r in windows}
    for r in got.select("insight_date", "insight_type", "window_start", "window_end",
                        "prev_start", "prev_end").distinct().collect():
        assert stored[(r.insight_date, r.insight_type)] == tuple(r)[2:]


@pytest.mark.parametrize("month", ["rolling30", "calendar"])
def test_conditional_sums_equal_brute_force(spark, month):
    df, seen = facts(spark, 3)
    for anchor in (FIRST, date(2021, 3, 30), LAST):
        windows = windows_of_anchor(spark, MIN, anchor, month)
        got = sums_for_windows(df, windows, ["revenue"], CHANNEL)
        assert as_dict(got, CHANNEL) == brute(seen, windows)


def test_series_without_keys_has_every_window(spark):
    df, seen = facts(spark, 4, days=20, rows=10, start=date(2021, 2, 1))
    got = sums_for_anchors(df, FIRST, LAST, MIN, "rolling30", ["revenue"])
    assert got.count() == 4 * ((LAST - FIRST).days + 1)
    windows = period_windows(date_spine(spark, FIRST, LAST), MIN, "rolling30").collect()
    assert as_dict(got) == brute(seen, windows, channels=False)


def test_no_facts_at_all(spark):
    df, _ = facts(spark, 5)
    empty = df.where("false")
    assert kpi_history(empty, FIRST, LAST, MIN, "calendar").where("revenue = 0").count() \
        == 4 * ((LAST - FIRST).days + 1)
    assert sums_for_anchors(empty, FIRST, LAST, MIN, "calendar", ["revenue"], CHANNEL).count() == 0


def test_several_rows_per_day_and_double_money(spark):
    rows = [(date(2021, 1, 5), 0.1, 1), (date(2021, 1, 5), 0.2, 1), (date(2021, 1, 4), 0.3, 2)]
    df = spark.createDataFrame(rows, "date date, revenue double, orders bigint")
    day = date(2021, 1, 5)
    for kpi in (kpis(df, windows_of_anchor(spark, MIN, day, "rolling30")),
                kpi_history(df, day, day, MIN, "rolling30")):
        row = kpi.where("insight_type = 'Day'").first()
        assert (row.revenue, row.orders, row.prev_revenue, row.prev_orders) == (0.3, 2, 0.3, 2)
        assert (row.delta_abs, row.delta_pct) == (0.0, 0.0)


def test_kpi_guards(spark):
    df = spark.createDataFrame([(date(2021, 1, 5), Decimal(9), 0)],
                               "date date, revenue decimal(30,6), orders bigint")
    row = kpis(df, [single_window(date(2021, 1, 5), date(2021, 1, 5))]).first()
    # revenue without orders, nothing before
    assert (row.aov, row.prev_aov, row.delta_abs, row.delta_pct) == (0.0, 0.0, 9.0, None)
    nothing = kpis(df, [single_window(date(2021, 3, 1), date(2021, 3, 7))]).first()
    assert (nothing.revenue, nothing.orders, nothing.prev_revenue) == (0.0, 0, 0.0)


def test_one_pass_equals_two_queries(spark):
    df, _ = facts(spark, 6)
    w = single_window(date(2021, 1, 1), date(2021, 1, 31))

    def total(start, end):
        return df.where(F.col("date").between(F.lit(start), F.lit(end))).agg(
            F.coalesce(F.sum("revenue"), F.lit(0)).cast("double"), F.coalesce(F.sum("orders"), F.lit(0))
        ).first()

    row = kpis(df, [w]).first()
    assert (row.revenue, row.orders) == tuple(total(w.window_start, w.window_end))
    assert (row.prev_revenue, row.prev_orders) == tuple(total(w.prev_start, w.prev_end))


def test_frames_equal_series(spark):
    df, _ = facts(spark, 7)
    daily = df.groupBy("date").agg(F.sum("revenue").cast("decimal(30,6)").alias("revenue"),
                                   F.sum("orders").alias("orders"))
    # a spine that begins after the first facts: they count in the frames that reach back
    spine = date_spine(spark, MIN, LAST)
    wide = {r.date: r for r in rolling_kpis(daily, spine).collect()}
    rows = kpi_history(daily, MIN, LAST, MIN, "rolling30").collect()
    assert len(wide) == (LAST - MIN).days + 1
    for r in rows:
        if r.insight_type == "Total":
            continue
        w, kind = wide[r.insight_date], r.insight_type.lower()
        assert (float(w[f"{kind}_revenue"]), w[f"{kind}_orders"]) == (r.revenue, r.orders)
        assert float(w[f"prev_{kind}_revenue"]) == r.prev_revenue
