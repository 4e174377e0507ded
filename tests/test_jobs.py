"""The two jobs end to end, from nested events to stored insights."""

import json
from dataclasses import replace
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tideglass.config import BACKFILL, DAILY, Gate, Tables
from tideglass.operators.kpi import kpis
from tideglass.operators.marts import attribution_daily, date_spine, purchase_lines, purchases_daily
from tideglass.operators.movers import movers
from tideglass.operators.periods import single_window, windows_of_anchor
from tideglass.operators.running import read_totals
from tideglass.operators.staging import stage_events
from tideglass.plans.insights import with_inputs
from tideglass.plans.jobs import (
    historical_insights, latest_insights, missing_insights, run_backfill, run_changes, run_holes,
    run_latest, store_totals,
)
from tideglass.schemas import INSIGHT, RAW_EVENT
from tideglass.sources.catalog import publish_table, publish_view
from tideglass.sources.events import flatten_events
from tideglass.sources.insight_store import upsert

NOW, LATER = datetime(2021, 2, 1), datetime(2021, 2, 2)
MICROS_PER_DAY = 86_400_000_000


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Forty days of events, some without purchases, stored as facts."""
    epoch = date(1970, 1, 1)
    events = []
    for i in range(40):
        day = date.fromordinal(date(2020, 12, 1).toordinal() + i)
        for j in range(i % 4):
            events.append((
                day.strftime("%Y%m%d"), (day - epoch).days * MICROS_PER_DAY + j, "Purchase", f"u{j}",
                ("NL", "UT"), ("mobile",), (["google", "direct", ""][j], "cpc", "sale"),
                [("ga_session_id", (None, i))], [("h", "Hat", "Wear", 40.0 + i, j + 1)],
            ))
    raw = spark.createDataFrame(events, RAW_EVENT)
    lines = purchase_lines(stage_events(flatten_events(raw.unionByName(raw))))
    root = tmp_path_factory.mktemp("mart")
    publish_table(purchases_daily(lines), f"{root}/purchases")
    publish_table(attribution_daily(lines), f"{root}/attribution")
    publish_view(date_spine(spark, date(2020, 12, 1), date(2021, 1, 9)), "spine")
    return Tables(purchases=f"{root}/purchases", attribution=f"{root}/attribution", dates="spine")


SPAN = (date(2020, 12, 1), date(2021, 1, 9))


def facts(spark, tables):
    return spark.read.parquet(tables.purchases), spark.read.parquet(tables.attribution)


def plain(df):
    return sorted(map(str, df.drop("raw_response").collect()))


@pytest.mark.parametrize("preset", [DAILY, BACKFILL])
def test_one_anchor_of_history_equals_latest(spark, tables, preset):
    latest = latest_insights(*facts(spark, tables), SPAN, preset)
    history = historical_insights(*facts(spark, tables), SPAN, SPAN[1], SPAN[1], preset)
    assert latest.schema.simpleString() == INSIGHT.simpleString()
    assert plain(latest) == plain(history)
    assert latest.count() == 4


def test_daily_run(spark, tables, tmp_path):
    here = replace(tables, insights=str(tmp_path / "insights"))
    rows = {r.insight_type: r for r in run_latest(spark, here, now=NOW).collect()}
    assert set(rows) == {"Total", "Month", "Week", "Day"}
    total = rows["Total"]
    assert (total.insight_date, total.window_start) == (SPAN[1], SPAN[0])
    assert (total.model_name, total.prompt_tokens, total.created_at) == ("default", 0, NOW)
    assert total.kpi_used.orders == 60
    assert len(total.top_movers_used) == 3
    assert {m.source for m in total.top_movers_used} == {"google", "direct", "(none)"}
    assert total.display_text.split("\n")[0] == "Low activity in this period."
    # the second run replaces the four rows
    assert run_latest(spark, here, now=NOW).count() == 4


def test_backfill_run(spark, tables, tmp_path):
    here = replace(tables, insights=str(tmp_path / "insights"))
    stored = run_backfill(spark, here, now=NOW)
    assert stored.count() == 160
    quiet = stored.where("kpi_used.revenue = 0 and insight_type = 'Day'")
    assert quiet.count() == 10
    assert {r.headline for r in quiet.collect()} == {"No purchase activity in this period."}
    # Total windows start with the span, also where the run starts later
    later = replace(here, insights=str(tmp_path / "later"))
    part = run_backfill(spark, later, start=date(2021, 1, 5), now=NOW)
    assert part.count() == 20
    assert {r.window_start for r in part.where("insight_type = 'Total'").collect()} == {SPAN[0]}
    # and its rows are those of the whole run
    same = stored.where(F.col("insight_date") >= F.lit(date(2021, 1, 5)))
    assert plain(part) == plain(same)
    # the daily run replaces the four rows of the newest date
    assert run_latest(spark, here, now=NOW).count() == 160


def test_free_windows_keep_their_movers(spark, tables):
    purchases, attribution = (spark.read.parquet(t) for t in (tables.purchases, tables.attribution))
    windows = [single_window(start, date(2021, 1, 9)) for start in (date(2021, 1, 6), date(2020, 12, 10))]
    found = movers(attribution, windows, DAILY.movers)
    inputs = with_inputs(kpis(purchases, windows), found).collect()
    per_window = {r.kpi.window_start: len(r.top_movers) for r in inputs}
    want = {w.window_start: found.where(F.col("window_start") == F.lit(w.window_start)).count()
            for w in windows}
    assert per_window == want and all(want.values())


def test_holes_are_found_and_only_they_are_built(spark, tables, tmp_path):
    purchases, attribution = (spark.read.parquet(t) for t in (tables.purchases, tables.attribution))
    here = with_totals(tables, tmp_path)
    store_totals(spark, here)
    totals = read_totals(spark, here.purchase_totals), read_totals(spark, here.attribution_totals)
    whole = historical_insights(purchases, attribution, SPAN)
    stored = whole.where("not (insight_type = 'Total' and insight_date = '2020-12-01')") \
        .withColumn("insight_type", F.lower("insight_type"))
    built = missing_insights(*totals, SPAN, stored)
    assert plain(built) == plain(whole.where("insight_type = 'Total' and insight_date = '2020-12-01'"))
    assert built.count() == 1
    # No facts and no series by day: only totals are read, and of the hole's months alone.
    assert all("/p/" in f or "/a/" in f or "/spine" in f
               for f in missing_insights(*totals, SPAN, whole.limit(0)).inputFiles())
    # Every window at once gives the history.
    assert plain(missing_insights(*totals, SPAN, whole.limit(0))) == plain(whole)
    # As a job: the lost rows come back, the others keep their moment.
    run_backfill(spark, here, now=NOW)
    upsert(spark, here.insights, whole.limit(0))
    assert run_holes(spark, here, now=LATER).where(F.col("created_at") == F.lit(LATER.isoformat())
                                                   .cast("timestamp_ntz")).count() == 0


def with_totals(tables, tmp_path):
    return replace(tables, insights=str(tmp_path / "insights"), purchase_totals=str(tmp_path / "p"),
                   attribution_totals=str(tmp_path / "a"))


def test_only_what_a_reload_changes_is_written_anew(spark, tables, tmp_path):
    here = with_totals(tables, tmp_path)
    run_backfill(spark, here, now=NOW)
    store_totals(spark, here)
    day = date(2020, 12, 20)

    def raised(path, name):
        facts = spark.read.parquet(path).withColumn("revenue", F.when(
            F.col("date") == F.lit(day), F.col("revenue") + 100).otherwise(F.col("revenue")))
        facts.write.parquet(str(tmp_path / name))
        return str(tmp_path / name)

    there = replace(here, purchases=raised(here.purchases, "p2"), attribution=raised(here.attribution, "a2"))
    days = spark.createDataFrame([(day,), (day,), (None,), (date(2030, 1, 1),)], "date date")
    after = run_changes(spark, there, days.where("date is null or date < '2025-01-01'"), now=LATER)
    whole = historical_insights(spark.read.parquet(there.purchases), spark.read.parquet(there.attribution), SPAN)
    assert plain(after.drop("created_at", "insight_year")) == plain(whole.drop("created_at"))
    written = {(r.insight_date, r.insight_type) for r in after.collect() if r.created_at == LATER}
    kept = {(r.insight_date, r.insight_type) for r in after.collect() if r.created_at == NOW}
    want = {(w.insight_date, w.insight_type) for anchor in after.select("insight_date").distinct().collect()
            for w in windows_of_anchor(spark, SPAN[0], anchor[0], BACKFILL.month)
            if w.prev_start <= day <= w.window_end}
    assert written == want and len(written) + len(kept) == after.count() and kept
    assert run_changes(spark, there, days.where("date is null"), now=LATER).count() == after.count()


def test_generator_behind_the_gate(spark, tables, tmp_path):
    def answer(prompts):
        told = []
        for text in prompts:
            data, _ = json.JSONDecoder().raw_decode(text[text.index('{"kpi"'):])
            told.append("broken" if data["kpi"]["period"] == "day" else json.dumps(
                {"headline": f"{data['kpi']['period']}: {len(data['top_movers'])} movers",
                 "bullets": [" one ", ""], "actions": []}))
        return told

    here = replace(tables, insights=str(tmp_path / "insights"))
    preset = replace(BACKFILL, gate=Gate(min_orders=1, not_before="2020-12-10"))
    stored = run_backfill(spark, here, preset=preset, respond=answer, model_name="told", now=NOW)
    assert stored.count() == 160
    by_model = {r.model_name for r in stored.where("window_end < '2020-12-10'").collect()}
    assert by_model == {"default"}
    asked = stored.where("model_name = 'told'")
    assert asked.where("kpi_used.orders = 0").count() == 0
    row = asked.where("insight_type = 'Total' and insight_date = '2021-01-09'").first()
    assert row.headline == "total: 3 movers" and row.bullets == ["one"]
    assert len(row.actions) == 3                     # the fallback, never an empty list
    assert '"kpi"' in row.raw_prompt
    broken = asked.where("insight_type = 'Day'").first()
    assert (broken.headline, broken.bullets) == ("AI insight", ["broken"])
    raw = asked.where("insight_type = 'Total'").select(
        F.variant_get("raw_response", "$.bullets[0]", "string")).first()[0]
    assert raw == " one "                            # kept as parsed, before tidying


def test_facts_are_computed_once_for_the_holes(spark, monkeypatch):
    """They used to be computed for the history, and once more for the tables of the job."""
    from tideglass.plans import driver_tables, queries

    asked = []
    facts = spark.sql(
        "select date'2021-01-04' as date, cast(null as string) as source, 'm' as medium, 'c' as campaign, "
        "cast(5 as decimal(30,6)) as revenue, 1L as orders, 5d as aov")
    monkeypatch.setattr(driver_tables, "purchases", lambda *a: asked.append("purchases") or facts.select(
        "date", "revenue", "orders", "aov"))
    monkeypatch.setattr(driver_tables, "attribution", lambda *a: asked.append("attribution") or facts.drop("aov"))
    monkeypatch.setattr(driver_tables, "order_span", lambda *a: (date(2021, 1, 1), date(2021, 1, 5)))
    rows = queries.insight_holes(spark, "").collect()
    assert [(r.insight_date, r.insight_type) for r in rows] == [(date(2021, 1, 1), "Total")]
    assert sorted(asked) == ["attribution", "purchases"]
