"""Every registered query against its SQL, on the smallest driver tables."""

import os

import pytest

from compare import connect, difference, spark_side, sql_side
from __spark_entry__ import entry
from tideglass.plans.driver_tables import order_span
from tideglass.plans.oracle import ORACLE
from tideglass.plans.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no driver tables")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, con, name):
    names, rows = spark_side(QUERIES[name](spark, SF_DIR))
    assert rows, "no rows to compare"
    assert difference(names, rows, *sql_side(con, ORACLE[name])) is None


def test_entry_runs(spark):
    assert entry(spark).columns[:3] == ["insight_date", "insight_type", "rank"]


def test_backfill_stores_every_date_of_the_span(spark):
    first, last = order_span(spark, SF_DIR)
    stored = QUERIES["run_backfill_whole"](spark, SF_DIR).select("insight_date", "insight_type")
    days = stored.distinct().groupBy("insight_date").count().collect()
    assert {r["count"] for r in days} == {4} and len(days) == (last - first).days + 1
    assert min(r.insight_date for r in days) == first


JOIN_QUERIES = [
    "flatten_keyjoin", "fct_attribution_daily", "star_channel", "kpi_backfill",
    "movers_fulljoin", "movers_backfill", "channel_trends", "period_over_period",
    "insights_backfill", "purchases_zero_filled",
]


@pytest.mark.parametrize("name", JOIN_QUERIES)
def test_no_nested_loops(spark, name):
    plan = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan
    assert "PythonUDF" not in plan


def test_attribution_from_events_shuffles_no_rows_of_items(spark):
    found = QUERIES["attribution_from_events"](spark, SF_DIR)
    plan = found._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    staged = plan[plan.index("WindowGroupLimit"):plan.index("explode(items")]
    assert "Exchange" not in staged
