import random

import pytest
from pyspark.sql import functions as F

from tideglass.operators.ranking import _sorted_over_tasks, number_rows, rank_rows


@pytest.fixture(autouse=True)
def many_tasks(spark):
    """Small tables would be merged into one task."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_numbers_run_through_a_group_that_many_tasks_hold(spark):
    rng = random.Random(1)
    rows = [("hot" if i % 3 else None, rng.randrange(40), i) for i in range(3000)]
    rows += [(f"k{i % 50}", 1, i) for i in range(3000, 3300)]
    df = spark.createDataFrame(rows, "k string, v long, id long").repartition(7)
    placed = number_rows(df, ["k"], [F.desc("v"), F.asc("id")], "n").collect()
    assert len(placed) == len(rows)
    want = {}
    for k in {r[0] for r in rows}:
        mine = sorted([r for r in rows if r[0] == k], key=lambda r: (-r[1], r[2]))
        want |= {r[2]: n for n, r in enumerate(mine, 1)}
    assert {r["id"]: r["n"] for r in placed} == want


def test_ranks_with_ties_across_tasks(spark):
    rng = random.Random(2)
    scores = [None, 0.5, 0.5, 1.0, float(2), -3.0]
    rows = [(rng.choice(["a", None]), rng.choice(scores), i) for i in range(4000)]
    df = spark.createDataFrame(rows, "k string, score double, id long").repartition(5)
    got = {r["id"]: r["rank"] for r in rank_rows(df, ["k"], "score", spread=["id"]).collect()}
    for k, score, i in rows[::37]:
        def above(s):
            return s is not None and (score is None or s > score)
        assert got[i] == 1 + sum(above(s) for kk, s, _ in rows if kk == k)
    assert len(got) == len(rows)


def test_ranks_equal_the_window_function(spark):
    df = spark.range(5000).selectExpr("id", "id % 3 k", "double(id * 7919 % 101) score")
    got = rank_rows(df, ["k"], "score", spread=["id"])
    want = df.selectExpr("*", "rank() over (partition by k order by score desc) rank")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_one_hot_group_is_spread(spark):
    df = spark.range(20_000).selectExpr("1 k", "id % 5 score", "id")
    rows = _sorted_over_tasks(df, ["k"], [F.desc("score"), F.asc("id")])
    per_task = [r["count"] for r in rows.groupBy("_task").count().collect()]
    assert len(per_task) >= 4 and max(per_task) < 10_000


def test_empty(spark):
    df = spark.createDataFrame([], "k string, score double")
    assert rank_rows(df, ["k"], "score").collect() == []
