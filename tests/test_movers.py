from datetime import date, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tideglass.config import BACKFILL, DAILY, MoverRules
from tideglass.operators.movers import collect_movers, mover_history, movers, rank_movers, score
from tideglass.operators.periods import single_window, windows_of_anchor
from tideglass.operators.windows import sums_for_windows
from tideglass.schemas import CHANNEL

SCHEMA = "date date, source string, medium string, campaign string, revenue decimal(30,6)"
CUR, PREV = date(2021, 1, 5), date(2021, 1, 4)
WINDOW = [single_window(CUR, CUR)]
STRICT = MoverRules(0.6, 0.4, 0.0, None, null_safe=False)


def facts(spark, *rows):
    return spark.createDataFrame(
        [(day, *channel, Decimal(str(value))) for day, channel, value in rows], SCHEMA)


A, B, C, N = ("a", "cpc", "x"), ("b", "cpc", "x"), ("c", "cpc", "x"), ("n", None, "")


@pytest.fixture
def sample(spark):
    return facts(spark, (CUR, A, 120), (PREV, A, 100), (CUR, B, 60), (PREV, C, 80),
                 (CUR, N, 70), (PREV, N, 50), (date(2021, 1, 3), A, 999))


def rows(df):
    return [tuple(r) for r in df.orderBy("rank").select(
        *CHANNEL, "revenue_cur", "revenue_prev", "delta_abs", "delta_pct", "impact_score").collect()]


def test_daily_scores(sample):
    got = rows(movers(sample, WINDOW, DAILY.movers))
    assert [r[0] for r in got] == ["c", "b", "n", "a"]
    assert got[0] == (*C, 0.0, 80.0, -80.0, -1.0, 80 * 0.6 + 1 * 0.4)
    # nothing before: the rate counts as 0, and stays NULL in the row
    assert got[1] == (*B, 60.0, 0.0, 60.0, None, 60 * 0.6)
    assert got[2] == (*N, 70.0, 50.0, 20.0, 0.4, 20 * 0.6 + 0.4 * 0.4)


def test_null_parts_split_a_channel_in_strict_mode(sample):
    got = rows(movers(sample, WINDOW, STRICT))
    assert [(r[0], r[3], r[4]) for r in got] == [
        ("c", 0.0, 80.0), ("n", 70.0, 0.0), ("b", 60.0, 0.0), ("n", 0.0, 50.0), ("a", 120.0, 100.0)]


def test_backfill_scores_and_threshold(spark, sample):
    got = rows(movers(sample, WINDOW, BACKFILL.movers))
    # c sells nothing now; b has no rate, so no score, and comes last
    assert [r[0] for r in got] == ["n", "a", "b"]
    assert got[0][-1] == 20 * 0.7 + 0.4 * 0.3 and got[2][-1] is None
    edge = facts(spark, (CUR, A, "49.99"), (CUR, B, "50.00"))
    assert [r[0] for r in rows(movers(edge, WINDOW, BACKFILL.movers))] == ["b"]


def test_ties_are_cut_by_size_and_name(spark):
    many = facts(spark, *[(CUR, (f"s{i:02d}", "m", "c"), 100) for i in range(12)],
                 (CUR, ("s99", "m", "c"), 500))
    for rules in (DAILY.movers, BACKFILL.movers):
        got = rows(movers(many, WINDOW, rules))
        assert [r[0] for r in got] == ["s99"] + [f"s{i:02d}" for i in range(7)]


def test_channels_without_facts_in_either_window_are_absent(spark):
    df = facts(spark, (date(2021, 1, 1), A, 5), (CUR, B, 0))
    # a fact of value zero is a fact
    assert [r[0] for r in rows(movers(df, WINDOW, DAILY.movers))] == ["b"]


def test_rank_shares_equal_scores(spark):
    df = facts(spark, (CUR, A, 10), (CUR, B, 10), (CUR, C, 5))
    sums = sums_for_windows(df, WINDOW, ["revenue"], CHANNEL)
    ranks = {r.source: r.impact_rank for r in rank_movers(score(sums, DAILY.movers), 8).collect()}
    assert ranks == {"a": 1, "b": 1, "c": 3}
    assert rank_movers(score(sums, DAILY.movers), 1).count() == 2


def test_records(sample):
    row = collect_movers(movers(sample, WINDOW, BACKFILL.movers)).first()
    first, last = row.top_movers[0], row.top_movers[-1]
    assert (first.source, first.medium, first.campaign) == ("n", "(none)", "(none)")
    assert (last.source, last.delta_pct, last.impact_score) == ("b", None, 0.0)
    assert [m.source for m in row.top_movers] == ["n", "a", "b"]


@pytest.mark.parametrize("preset", [DAILY, BACKFILL])
@pytest.mark.parametrize("null_safe", [True, False])
def test_history_equals_single_anchor_runs(spark, preset, null_safe):
    rng_days = [(date(2020, 11, 1) + timedelta(days=(i * 37) % 150), ch, (i * 7919) % 300 + 1)
                for i, ch in enumerate([A, B, C, N, (None, None, None)] * 24)]
    df = facts(spark, *rng_days).groupBy("date", *CHANNEL).agg(
        F.sum("revenue").cast("decimal(30,6)").alias("revenue"))
    rules = MoverRules(preset.movers.size_weight, preset.movers.rate_weight,
                       preset.movers.missing_rate, preset.movers.min_revenue, 3, null_safe)
    first, last, min_date = date(2021, 2, 26), date(2021, 3, 3), date(2020, 11, 20)
    history = mover_history(df, first, last, min_date, preset.month, rules)
    columns = ["insight_date", "insight_type", "rank", *CHANNEL, "revenue_cur", "revenue_prev",
               "impact_score"]
    got = sorted(map(str, history.select(*columns).collect()))
    expected = []
    for i in range((last - first).days + 1):
        windows = windows_of_anchor(spark, min_date, first + timedelta(days=i), preset.month)
        expected += movers(df, windows, rules).select(*columns).collect()
    assert got == sorted(map(str, expected))
