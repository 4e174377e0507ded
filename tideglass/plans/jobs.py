"""The daily run, the historical run, the repair of holes and the run after a reload (K6-K8)."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from tideglass.config import BACKFILL, DAILY, Preset, Tables
from tideglass.operators.changes import affected_windows
from tideglass.operators.kpi import MEASURES, kpi_columns, kpi_history, kpis
from tideglass.operators.marts import date_spine, span_of
from tideglass.operators.movers import mover_history, movers, score, top
from tideglass.operators.periods import period_windows, windows_of_anchor
from tideglass.operators.running import read_totals, refresh_totals, sums_at, write_totals
from tideglass.plans.insights import Count, Respond, build_insights, with_inputs
from tideglass.schemas import CHANNEL
from tideglass.sources.catalog import read_table
from tideglass.sources.insight_store import read_insights, upsert
from tideglass.sources.workspace import stage


def latest_insights(
    purchases: DataFrame,
    attribution: DataFrame,
    span: tuple[date, date],
    preset: Preset = DAILY,
    respond: Respond | None = None,
    model_name: str = "generator",
) -> DataFrame:
    """The four insight rows of the last date of ``span``."""
    first, anchor = span
    windows = windows_of_anchor(purchases.sparkSession, first, anchor, preset.month)
    inputs = with_inputs(kpis(purchases, windows), movers(attribution, windows, preset.movers))
    return build_insights(inputs, preset, respond, model_name)


def historical_insights(
    purchases: DataFrame,
    attribution: DataFrame,
    span: tuple[date, date],
    start: date | None = None,
    end: date | None = None,
    preset: Preset = BACKFILL,
    respond: Respond | None = None,
    model_name: str = "generator",
    count_tokens: Count | None = None,
) -> DataFrame:
    """Four insight rows for every date ``start``..``end``, the whole span by default, in one
    pass. Total windows begin at the start of the span whatever ``start`` is."""
    min_date, max_date = span
    first, last = start or min_date, end or max_date
    inputs = with_inputs(
        kpi_history(purchases, first, last, min_date, preset.month),
        mover_history(attribution, first, last, min_date, preset.month, preset.movers),
    )
    return build_insights(inputs, preset, respond, model_name, count_tokens)


def insights_for_windows(
    purchase_totals: DataFrame,
    attribution_totals: DataFrame,
    windows: DataFrame,
    preset: Preset = BACKFILL,
    respond: Respond | None = None,
    model_name: str = "generator",
) -> DataFrame:
    """The insight rows of a table of windows (as ``period_windows`` gives), from running totals at
    their boundary days."""
    ranked = top(score(sums_at(attribution_totals, windows, ["revenue"], CHANNEL), preset.movers),
                 preset.movers.top_k)
    inputs = with_inputs(kpi_columns(sums_at(purchase_totals, windows, MEASURES)), ranked)
    return build_insights(inputs, preset, respond, model_name)


def missing_windows(span: tuple[date, date], stored: DataFrame, month: str) -> DataFrame:
    """The windows of every (date, period) of the span that ``stored`` does not have."""
    there = stored.select(
        F.col("insight_date").alias("_date"), F.initcap("insight_type").alias("_type"))
    every = period_windows(date_spine(stored.sparkSession, *span), span[0], month)
    return every.join(there, (F.col("insight_date") == F.col("_date"))
                      & (F.col("insight_type") == F.col("_type")), "left_anti")


def missing_insights(
    purchase_totals: DataFrame,
    attribution_totals: DataFrame,
    span: tuple[date, date],
    stored: DataFrame,
    preset: Preset = BACKFILL,
    respond: Respond | None = None,
    model_name: str = "generator",
) -> DataFrame:
    """The insight rows of every (date, period) of the span that ``stored`` does not have, at the
    cost of the holes: no history is built. Texts are made for those only, so a generator is asked
    for nothing that is there."""
    return insights_for_windows(
        purchase_totals, attribution_totals, missing_windows(span, stored, preset.month),
        preset, respond, model_name)


def store_totals(spark: SparkSession, tables: Tables) -> None:
    """Builds both tables of running totals from all facts."""
    _, last = span_of(read_table(spark, tables, tables.dates))
    write_totals(read_table(spark, tables, tables.purchases), tables.purchase_totals, MEASURES, last)
    write_totals(read_table(spark, tables, tables.attribution), tables.attribution_totals,
                 ["revenue"], last, CHANNEL)


def run_holes(
    spark: SparkSession, tables: Tables, preset: Preset = BACKFILL,
    respond: Respond | None = None, model_name: str = "generator", now: datetime | None = None,
) -> DataFrame:
    """Adds the insights that the table lacks, from the stored running totals."""
    rows = missing_insights(
        read_totals(spark, tables.purchase_totals), read_totals(spark, tables.attribution_totals),
        span_of(read_table(spark, tables, tables.dates)), read_insights(spark, tables.insights),
        preset, respond, model_name)
    return upsert(spark, tables.insights, rows, now=now)


def run_changes(
    spark: SparkSession, tables: Tables, days: DataFrame, preset: Preset = BACKFILL,
    respond: Respond | None = None, model_name: str = "generator", now: datetime | None = None,
) -> DataFrame:
    """After the facts of ``days`` (a column ``date``) have changed: brings the running totals up
    to date from the first of them, and writes anew the insights whose windows a changed day lies
    in, and no others. The rest of the table keeps its rows and their ``created_at``."""
    first, last = span_of(read_table(spark, tables, tables.dates))
    days = stage(days.select("date").distinct(), "changed-days")
    changed_from = days.agg(F.min("date")).first()[0]
    if changed_from is None:
        return read_insights(spark, tables.insights)
    refresh_totals(read_table(spark, tables, tables.purchases), tables.purchase_totals, MEASURES,
                   changed_from, last)
    refresh_totals(read_table(spark, tables, tables.attribution), tables.attribution_totals,
                   ["revenue"], changed_from, last, CHANNEL)
    rows = insights_for_windows(
        read_totals(spark, tables.purchase_totals), read_totals(spark, tables.attribution_totals),
        affected_windows(days, first, last, first, preset.month), preset, respond, model_name)
    return upsert(spark, tables.insights, rows, now=now)


def run_latest(
    spark: SparkSession,
    tables: Tables,
    preset: Preset = DAILY,
    respond: Respond | None = None,
    model_name: str = "generator",
    now: datetime | None = None,
) -> DataFrame:
    """Daily run: write the insights of the newest date and return the insight table."""
    rows = latest_insights(
        read_table(spark, tables, tables.purchases),
        read_table(spark, tables, tables.attribution),
        span_of(read_table(spark, tables, tables.dates)),
        preset, respond, model_name,
    )
    return upsert(spark, tables.insights, rows, now=now)


def run_backfill(
    spark: SparkSession,
    tables: Tables,
    start: date | None = None,
    end: date | None = None,
    preset: Preset = BACKFILL,
    respond: Respond | None = None,
    model_name: str = "generator",
    now: datetime | None = None,
    null_safe: bool = True,
) -> DataFrame:
    """Historical run: write four insights per date and return the insight table."""
    rows = historical_insights(
        read_table(spark, tables, tables.purchases),
        read_table(spark, tables, tables.attribution),
        span_of(read_table(spark, tables, tables.dates)),
        start, end, preset, respond, model_name,
    )
    return upsert(spark, tables.insights, rows, null_safe, now)
