"""One query per operator of the inventory, over the driver's whole tables.

Each takes (spark, sf_dir) and returns a DataFrame of plain columns. ``oracle.py`` has the SQL
that gives the same rows.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import replace
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tideglass.config import BACKFILL, DAILY, Gate, MoverRules, Tables
from tideglass.functions.keys import EVENT_HASH
from tideglass.functions.scalars import daily_money, micros_to_ntz, ntz_text, ntz_to_micros, parse_day
from tideglass.operators import quality, staging, trends
from tideglass.operators.kpi import kpi_columns, kpi_history, kpi_struct, kpis, rolling_kpis
from tideglass.operators.marts import (
    attribution_daily, date_span, dim_channel, purchase_lines, purchases_daily, reconcile,
    shorten_labels, star, strict_revenue, zero_fill,
)
from tideglass.operators.movers import (
    collect_movers, mover_history, movers, rank_movers, score,
)
from tideglass.operators.narrative import (
    default_insight, display_text, parse_response, prompt, prompt_data, sanitize, wants_model,
)
from tideglass.operators.periods import (
    period_windows, single_window, window_label, windows_of_anchor,
)
from tideglass.operators.running import read_totals, refresh_totals, sums_at, write_totals
from tideglass.operators.windows import sums_for_windows
from tideglass.plans import driver_tables as tables
from tideglass.plans.insights import build_insights, with_inputs
from tideglass.plans.jobs import (
    historical_insights, latest_insights, missing_insights, run_backfill, run_changes, run_latest,
    store_totals,
)
from tideglass.schemas import CHANNEL, INSIGHT, KPI, MOVER
from tideglass.sources import catalog, events, insight_store, lake, loads
from tideglass.sources.workspace import fresh_folder, stage

STRICT_DAILY = MoverRules(0.6, 0.4, 0.0, None, null_safe=False)
FIRST_RUN, SECOND_RUN = datetime(2024, 1, 1), datetime(2024, 1, 2)
MOVER_AMOUNTS = ["revenue_cur", "revenue_prev", "delta_abs", "delta_pct", "impact_score"]


def _as_double(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("double") for c in columns})


# --- scans, sources, sinks -----------------------------------------------------------------

def scan_date_range(spark: SparkSession, sf: str) -> DataFrame:
    path = fresh_folder(spark, "raw")
    lake.replace_table(tables.nested(tables.flat_events(spark, sf)), path, "event_date")
    raw = events.scan_events(spark, path, "20240103", "20240128")
    return events.flatten_params(raw)


def roundtrip_partitioned(spark: SparkSession, sf: str) -> DataFrame:
    path = fresh_folder(spark, "flat")
    lake.write_by_date(tables.flat_events(spark, sf), path)
    return lake.load_events(spark, path)


def load_by_pattern(spark: SparkSession, sf: str) -> DataFrame:
    path = fresh_folder(spark, "flat")
    lake.write_by_date(tables.flat_events(spark, sf), path)
    return lake.load_events(spark, path, pattern=r".*date=2024-01-(0[1-9]|1[0-9]|2[0-4])/.*")


def skipped_files(spark: SparkSession, sf: str) -> DataFrame:
    """Two files that are no Parquet lie in the lake: the rest loads, and the two are reported."""
    path = fresh_folder(spark, "flat")
    lake.write_by_date(tables.flat_events(spark, sf), path)
    for day in ("2024-01-05", "2024-01-09"):
        spark.createDataFrame([("no parquet",)], "line string").coalesce(1) \
            .write.mode("append").text(f"{path}/date={day}")
    loaded = lake.load_events(spark, path, on_error="continue").groupBy("date").agg(
        F.count("*").alias("n_rows"))
    skipped = loads.skipped_files(spark, path).groupBy(
        F.to_date(F.regexp_extract("path", r"date=([0-9-]+)/", 1)).alias("day")
    ).agg(F.count("*").alias("n_skipped"))
    return loaded.join(skipped, F.col("date") == F.col("day"), "left").select(
        "date", "n_rows", F.coalesce("n_skipped", F.lit(0)).alias("n_skipped"))


def incremental_load(spark: SparkSession, sf: str) -> DataFrame:
    """Two deliveries, loaded as they come: first the days up to the 20th, with two files that are
    no Parquet; then the other days, with one more. The load is run twice after each. By day: the
    rows loaded and those the ledger tells of, failed files, those with a reason, and loads."""
    source, root = fresh_folder(spark, "delivered"), fresh_folder(spark, "loaded")
    flat = tables.flat_events(spark, sf)

    def deliver(condition: str, *damaged: str) -> None:
        lake.write_by_date(flat.where(condition), source)
        for day in damaged:
            spark.createDataFrame([("no parquet",)], "line string").coalesce(1) \
                .write.mode("append").text(f"{source}/date={day}")
        for _ in range(2):
            loads.load_new(spark, source, root)

    deliver("day(event_dt) <= 20", "2024-01-05", "2024-01-09")
    deliver("day(event_dt) > 20", "2024-01-25")
    entries = loads.read_ledger(spark, root).groupBy(
        F.to_date(F.regexp_extract("path", r"date=([0-9-]+)/", 1)).alias("day")).agg(
        F.count_if(F.col("outcome") == "failed").alias("n_failed"),
        F.count_if((F.col("outcome") == "failed") & (F.length("reason") > 0)).alias("n_reasons"),
        F.count_distinct("load_id").alias("n_loads"), F.sum("n_rows").alias("n_in_ledger"))
    rows = loads.read_loaded(spark, root).groupBy(F.col("event_dt").alias("date")).agg(
        F.count("*").alias("n_rows"), F.sum(F.col("price").cast("decimal(20,6)")).cast("double").alias("price"))
    return rows.join(entries, F.col("date") == F.col("day")).select(
        "date", "n_rows", "price", "n_in_ledger", "n_failed", "n_reasons",
        "n_loads")


def lake_listing(spark: SparkSession, sf: str) -> DataFrame:
    """The files of each day of the lake, from the listing alone: how a path ends, that there are
    files and that they hold bytes. Their names and sizes are the writer's."""
    path = fresh_folder(spark, "flat")
    lake.write_by_date(tables.flat_events(spark, sf), path)
    tail = F.regexp_extract("path", r"(date=[0-9-]+)/[^/]+\.parquet$", 1)
    return lake.list_files(spark, path).groupBy(tail.alias("folder")).agg(
        (F.count("*") >= 1).alias("has_files"), (F.min("length") > 0).alias("all_hold_bytes"),
        (F.count_distinct("path") == F.count("*")).alias("listed_once")).select(
        F.to_date(F.substring("folder", 6, 10)).alias("date"), "folder", "has_files",
        "all_hold_bytes", "listed_once")


def named_tables(spark: SparkSession, sf: str) -> DataFrame:
    """Facts read by the names of a job's settings: one by path, one by a catalog name."""
    named = Tables(purchases=fresh_folder(spark, "purchases"), attribution="attribution_by_name")
    catalog.publish_table(tables.purchases(spark, sf), named.purchases)
    catalog.publish_view(tables.attribution(spark, sf), named.attribution)
    by_day = catalog.read_table(spark, named, named.attribution).groupBy("date").agg(
        F.sum("revenue").alias("channel_revenue"))
    return _as_double(catalog.read_table(spark, named, named.purchases).join(by_day, "date"),
                      "revenue", "channel_revenue").select("date", "revenue", "channel_revenue")


def materialised_layers(spark: SparkSession, sf: str) -> DataFrame:
    """Staging as a view, the mart of it as a stored table by day."""
    catalog.publish_view(_staged(spark, sf), "staging_layer")
    lines = purchase_lines(spark.table("staging_layer"))
    mart = fresh_folder(spark, "mart")
    catalog.publish_table(purchases_daily(lines), mart, "date")
    stored = catalog.read_table(spark, Tables(), mart)
    return _as_double(stored.select("date", "revenue", "orders"), "revenue")


def variant_to_typed(spark: SparkSession, sf: str) -> DataFrame:
    flat = tables.flat_events(spark, sf)
    as_sent = flat.withColumn("event_timestamp", ntz_to_micros(F.col("event_timestamp")))
    rows = as_sent.select(F.to_variant_object(F.struct("*")).alias("v"))
    return lake.type_variant_rows(rows)


def variant_cast_losses(spark: SparkSession, sf: str) -> DataFrame:
    flat = tables.flat_events(spark, sf)
    # The session arrives as text, for some events as text that is no number.
    as_sent = flat.select(F.struct(
        "event_name", "price",
        F.when(F.col("event_name") == "CLICK", F.lit("none"))
        .otherwise(F.col("ga_session_id").cast("string")).alias("ga_session_id"),
    ).alias("s"))
    return lake.cast_losses(as_sent.select(F.parse_json(F.to_json("s")).alias("v")))


def reload_date_range(spark: SparkSession, sf: str) -> DataFrame:
    path = fresh_folder(spark, "flat")
    flat = tables.flat_events(spark, sf)
    lake.write_by_date(flat, path)
    # The corrected delivery has no errors, other prices, and nothing at all for one of the days.
    corrected = flat.where((F.col("event_name") != "ERROR") & (F.col("event_dt") != "2024-01-15")) \
        .withColumn("price", F.col("price") + 1)
    lake.reload_dates(corrected, path, date(2024, 1, 10), date(2024, 1, 20))
    return lake.load_events(spark, path)


def _loaded_insights(spark: SparkSession, sf: str) -> DataFrame:
    """One 'Day' insight per purchase day."""
    return tables.purchases(spark, sf).select(
        F.col("date").alias("insight_date"), F.lit("day").alias("insight_type"),
        F.format_string("%d orders", "orders").alias("headline"),
        F.lit("first").alias("model_name"),
    )


def _updates(spark: SparkSession, sf: str) -> DataFrame:
    """For each purchase day a new 'Day' insight and one without a type."""
    kinds = F.array(F.lit("Day"), F.lit(None).cast("string"))
    return _loaded_insights(spark, sf).select(
        "insight_date", F.explode(kinds).alias("insight_type"),
        F.concat("headline", F.lit(", revised")).alias("headline"),
        F.lit("second").alias("model_name"),
    )


def _upserted(spark: SparkSession, sf: str, null_safe: bool) -> DataFrame:
    """A table written elsewhere, with types in lower case, and two runs that bring the even days
    from 1995 on: odd days of those years stay as they are, years before are not touched."""
    path = fresh_folder(spark, "insights")
    insight_store.conform_to_schema(_loaded_insights(spark, sf).withColumn(
        "created_at", F.lit(FIRST_RUN.isoformat()).cast("timestamp_ntz"))
    ).withColumn(insight_store.YEAR, F.year("insight_date")) \
        .write.partitionBy(insight_store.YEAR).parquet(path)
    updates = _updates(spark, sf).where(
        (F.year("insight_date") >= 1995) & (F.dayofmonth("insight_date") % 2 == 0))
    insight_store.upsert(spark, path, updates, null_safe, SECOND_RUN)
    return insight_store.upsert(spark, path, updates, null_safe, SECOND_RUN).select(
        "insight_date", "insight_type", "window_start", "window_end", "headline",
        F.size("bullets").alias("n_bullets"), F.col("kpi_used.revenue").alias("revenue"),
        "model_name", "prompt_tokens", "created_at", "raw_prompt",
        F.to_json("raw_response").alias("raw_response"), "display_text")


def upsert_insights(spark: SparkSession, sf: str) -> DataFrame:
    return _upserted(spark, sf, True)


def upsert_insights_strict(spark: SparkSession, sf: str) -> DataFrame:
    return _upserted(spark, sf, False)


def insights_for_date(spark: SparkSession, sf: str) -> DataFrame:
    path = fresh_folder(spark, "insights")
    stored = insight_store.upsert(
        spark, path, _loaded_insights(spark, sf).unionByName(_updates(spark, sf).where(
            F.col("insight_type").isNull())), now=FIRST_RUN,
    )
    return insight_store.insights_on(stored, tables.order_span(spark, sf)[1]).select(
        "insight_date", "insight_type", "headline"
    )


def latest_insights_query(spark: SparkSession, sf: str) -> DataFrame:
    def stamped(df: DataFrame, at: datetime) -> DataFrame:
        return insight_store.conform_to_schema(
            df.withColumn("created_at", F.lit(at.isoformat()).cast("timestamp_ntz"))
        )

    versions = stamped(_loaded_insights(spark, sf), FIRST_RUN).withColumn(
        "insight_type", F.initcap("insight_type")
    ).unionByName(stamped(_updates(spark, sf), SECOND_RUN))
    return insight_store.latest(versions, 16)


def insight_schema_evolve(spark: SparkSession, sf: str) -> DataFrame:
    path = fresh_folder(spark, "older")
    _loaded_insights(spark, sf).drop("insight_type").write.parquet(path)
    older = spark.read.schema(INSIGHT).parquet(path)
    newer = insight_store.conform_to_schema(_updates(spark, sf))
    return older.unionByName(newer).select(
        "insight_date", "insight_type", "headline", "model_name", "window_end", "prompt_tokens",
        "display_text",
    )


# --- flattening and staging ----------------------------------------------------------------

def flatten_params(spark: SparkSession, sf: str) -> DataFrame:
    return events.flatten_params(tables.raw_events(spark, sf))


def explode_items(spark: SparkSession, sf: str) -> DataFrame:
    return events.explode_items(tables.raw_events(spark, sf))


def flatten_explode(spark: SparkSession, sf: str) -> DataFrame:
    return events.flatten_events(tables.raw_events(spark, sf))


def flatten_keyjoin(spark: SparkSession, sf: str) -> DataFrame:
    return events.flatten_events(tables.raw_events(spark, sf), mode="keyjoin")


def _staged(spark: SparkSession, sf: str) -> DataFrame:
    return staging.stage_events(tables.delivered_twice(tables.flat_events(spark, sf)))


def stg_events(spark: SparkSession, sf: str) -> DataFrame:
    return _staged(spark, sf)


def row_key(spark: SparkSession, sf: str) -> DataFrame:
    keyed = staging.with_row_key(staging.standardise(events.flatten_events(
        tables.raw_events(spark, sf))))
    return keyed.select("event_ts", "event_name", "user_pseudo_id", "ga_session_id", "item_id",
                        "row_key")


def dedup_lineitem(spark: SparkSession, sf: str) -> DataFrame:
    lines = tables.table(spark, sf, "lineitem")
    order = [F.desc("l_shipdate"), *[
        F.asc_nulls_last(c) for c in lines.columns
        if c not in ("l_orderkey", "l_linenumber", "l_shipdate")
    ]]
    return staging.dedup(lines, ["l_orderkey", "l_linenumber"], order)


def purchase_lines_query(spark: SparkSession, sf: str) -> DataFrame:
    return purchase_lines(_staged(spark, sf)).select(
        "event_dt", "event_ts", "user_pseudo_id", *CHANNEL, "item_id", "price", "quantity"
    )


# --- facts and dimensions ------------------------------------------------------------------

def fct_purchases_daily(spark: SparkSession, sf: str) -> DataFrame:
    return _as_double(tables.purchases(spark, sf), "revenue")


def fct_attribution_daily(spark: SparkSession, sf: str) -> DataFrame:
    return _as_double(tables.attribution(spark, sf), "revenue")


def attribution_from_events(spark: SparkSession, sf: str) -> DataFrame:
    flat = events.flatten_events(tables.raw_events(spark, sf), deal_by=[EVENT_HASH])
    lines = purchase_lines(staging.stage_events(flat, ["purchase"]))
    return _as_double(attribution_daily(lines), "revenue")


def dim_channel_query(spark: SparkSession, sf: str) -> DataFrame:
    return dim_channel(tables.attribution(spark, sf))


def date_span_query(spark: SparkSession, sf: str) -> DataFrame:
    return date_span(
        tables.table(spark, sf, "orders").select(F.to_date("o_orderdate").alias("date"))
    )


def purchases_zero_filled(spark: SparkSession, sf: str) -> DataFrame:
    filled = zero_fill(tables.purchases(spark, sf), tables.calendar(spark, sf),
                       ["revenue", "orders"])
    return _as_double(filled, "revenue")


def star_channel(spark: SparkSession, sf: str) -> DataFrame:
    # Facts are stored once, as a warehouse does; the dimension is made from the stored rows.
    facts = stage(tables.attribution(spark, sf), "facts")
    joined = star(facts, tables.calendar(spark, sf), dim_channel(facts))
    return _as_double(joined.groupBy("channel_key", *CHANNEL, F.year("date").alias("year")).agg(
        F.sum("revenue").alias("revenue"), F.sum("orders").alias("orders")
    ), "revenue")


def revenue_reconciliation(spark: SparkSession, sf: str) -> DataFrame:
    """Every row is delivered twice; some sessions' rows a third time with another price. Those
    share the key of their row, so the mart has them once and the strict baseline twice: a gap
    within the tolerance for few such sessions, and beyond it for many."""
    raw = tables.raw_events(spark, sf)
    by_event = events.flatten_events(raw, deal_by=[EVENT_HASH])
    by_session = events.flatten_events(raw, deal_by=["event_dt", "user_pseudo_id", "ga_session_id"])

    def checked(case: str, every: int) -> DataFrame:
        times = F.when(F.col("ga_session_id") % every == 0, F.array(*map(F.lit, (0, 0, 1)))) \
            .otherwise(F.array(F.lit(0), F.lit(0)))

        def delivered(flat: DataFrame) -> DataFrame:
            return flat.withColumn("_copy", F.explode(times)) \
                .withColumn("price", F.col("price") + F.col("_copy")).drop("_copy")

        mart = purchases_daily(purchase_lines(staging.stage_events(delivered(by_event), ["purchase"])))
        baseline = strict_revenue(staging.standardise(delivered(by_session)))
        return reconcile(mart, baseline, 0.01).select(F.lit(case).alias("delivery"), "*")

    return checked("few copies", 997).unionByName(checked("many copies", 10))


def source_labels(spark: SparkSession, sf: str) -> DataFrame:
    labelled = shorten_labels(
        tables.attribution(spark, sf), {"MACHINERY": "Private", "HOUSEHOLD": "Home"}
    )
    return _as_double(
        labelled.groupBy("source_label").agg(F.sum("revenue").alias("revenue")), "revenue"
    )


# --- periods, KPIs, movers -----------------------------------------------------------------

def period_windows_query(spark: SparkSession, sf: str) -> DataFrame:
    first, _ = tables.order_span(spark, sf)
    return period_windows(tables.calendar(spark, sf), first, "rolling30")


def period_windows_edate(spark: SparkSession, sf: str) -> DataFrame:
    first, _ = tables.order_span(spark, sf)
    return period_windows(tables.calendar(spark, sf), first, "calendar")


def _latest_windows(spark: SparkSession, sf: str, month: str):
    first, last = tables.order_span(spark, sf)
    return windows_of_anchor(spark, first, last, month)


def kpi_window(spark: SparkSession, sf: str) -> DataFrame:
    return kpis(tables.purchases(spark, sf), _latest_windows(spark, sf, "rolling30"))


def kpi_backfill(spark: SparkSession, sf: str) -> DataFrame:
    first, last = tables.order_span(spark, sf)
    return kpi_history(tables.purchases(spark, sf), first, last, first, "calendar")


def rolling_kpis_query(spark: SparkSession, sf: str) -> DataFrame:
    wide = rolling_kpis(tables.purchases(spark, sf), tables.calendar(spark, sf))
    return _as_double(wide, *[c for c in wide.columns if c.endswith("revenue")])


def _ranked(df: DataFrame) -> DataFrame:
    return df.select(
        "insight_date", "insight_type", "rank", *CHANNEL, *MOVER_AMOUNTS
    )


def movers_fulljoin(spark: SparkSession, sf: str) -> DataFrame:
    windows = _latest_windows(spark, sf, "rolling30")
    return _ranked(movers(tables.attribution(spark, sf), windows, STRICT_DAILY))


def movers_nullsafe(spark: SparkSession, sf: str) -> DataFrame:
    windows = _latest_windows(spark, sf, "rolling30")
    return _ranked(movers(tables.attribution(spark, sf), windows, DAILY.movers))


def movers_conditional(spark: SparkSession, sf: str) -> DataFrame:
    windows = _latest_windows(spark, sf, "calendar")
    return _ranked(movers(tables.attribution(spark, sf), windows, BACKFILL.movers))


def movers_backfill(spark: SparkSession, sf: str) -> DataFrame:
    first, last = tables.order_span(spark, sf)
    return _ranked(mover_history(
        tables.attribution(spark, sf), first, last, first, "calendar", BACKFILL.movers
    ))


def movers_records(spark: SparkSession, sf: str) -> DataFrame:
    windows = _latest_windows(spark, sf, "rolling30")
    lists = collect_movers(movers(tables.attribution(spark, sf), windows, DAILY.movers))
    return lists.select("insight_date", "insight_type", F.posexplode("top_movers")).select(
        "insight_date", "insight_type", "pos", "col.*"
    )


def movers_rank(spark: SparkSession, sf: str) -> DataFrame:
    windows = _latest_windows(spark, sf, "rolling30")
    sums = sums_for_windows(tables.attribution(spark, sf), windows, ["revenue"], CHANNEL)
    return rank_movers(score(sums, DAILY.movers)).select(
        "insight_date", "insight_type", *CHANNEL, "impact_score", "impact_rank"
    )


# --- trends --------------------------------------------------------------------------------

def _filled(spark: SparkSession, sf: str) -> DataFrame:
    return zero_fill(tables.purchases(spark, sf), tables.calendar(spark, sf), ["revenue"])


def trend_ma7(spark: SparkSession, sf: str) -> DataFrame:
    return _as_double(trends.moving_average(_filled(spark, sf)), "revenue")


def trend_wow(spark: SparkSession, sf: str) -> DataFrame:
    return _as_double(trends.lag_delta(_filled(spark, sf)), "revenue", "revenue_lag7")


def trend_zscore(spark: SparkSession, sf: str) -> DataFrame:
    flagged = _as_double(trends.zscore_flags(_filled(spark, sf)), "revenue")
    return flagged.withColumn("zscore", F.round("zscore", 6))


def channel_trends(spark: SparkSession, sf: str) -> DataFrame:
    trend = trends.channel_trends(tables.attribution(spark, sf), *tables.order_span(spark, sf))
    return _as_double(trend.withColumn("zscore", F.round("zscore", 6)), "revenue", "revenue_lag7")


def period_over_period(spark: SparkSession, sf: str) -> DataFrame:
    return _as_double(trends.period_over_period(_filled(spark, sf)), "revenue", "base_revenue")


# --- scalar functions ----------------------------------------------------------------------

def scalar_dates(spark: SparkSession, sf: str) -> DataFrame:
    text = F.date_format("o_orderdate", "yyyyMMdd")
    return tables.table(spark, sf, "orders").select(
        "o_orderkey", parse_day(text).alias("day"),
        parse_day(F.concat(F.substring(text, 1, 4), F.lit("1332"))).alias("no_day"),
        F.add_months("o_orderdate", -1).alias("month_before"),
    )


def scalar_timestamps(spark: SparkSession, sf: str) -> DataFrame:
    micros = ntz_to_micros(F.col("ts"))
    return tables.table(spark, sf, "events").select(
        "event_id", micros.alias("micros"), micros_to_ntz(micros).alias("ts"),
        micros_to_ntz(-micros - 1).alias("before_epoch"), ntz_text(F.col("ts")).alias("ts_text"),
    )


def scalar_formatting(spark: SparkSession, sf: str) -> DataFrame:
    day = F.to_date("o_orderdate")
    return tables.table(spark, sf, "orders").select(
        "o_orderkey", F.date_add(day, 1).alias("next_day"),
        F.format_string("/events/date=%s/", F.date_format(day, "yyyy-MM-dd")).alias("folder"),
        F.format_number(F.col("o_orderkey"), 0).alias("key_text"),
    )


# --- texts ---------------------------------------------------------------------------------

def _spoken(spark: SparkSession, sf: str) -> DataFrame:
    """A narrative out of each conversation turn: its lines, sentences and clauses."""
    text = F.col("text")
    return tables.table(spark, sf, "conversations").select(
        "conv_id", "turn", "role", "text",
        F.struct(
            F.concat(F.lit("  "), F.get(F.split(text, "\n"), 0), F.lit(" \t")).alias("headline"),
            F.split(text, r"\.").alias("bullets"),
            F.when(F.col("role") != "user", F.split(text, ",")).alias("actions"),
        ).alias("narrative"),
    )


def _narrative_columns(df: DataFrame, narrative: Column) -> DataFrame:
    n = df.withColumn("n", narrative)
    return n.select(
        "conv_id", "turn", F.col("n.headline").alias("headline"),
        F.size("n.bullets").alias("n_bullets"), F.array_join("n.bullets", "|").alias("bullets"),
        F.size("n.actions").alias("n_actions"), F.array_join("n.actions", "|").alias("actions"),
    )


def sanitize_insight(spark: SparkSession, sf: str) -> DataFrame:
    return _narrative_columns(
        _spoken(spark, sf), sanitize(F.col("narrative"), BACKFILL.text)
    )


def display_text_compact(spark: SparkSession, sf: str) -> DataFrame:
    return _spoken(spark, sf).select(
        "conv_id", "turn", display_text(F.col("narrative"), DAILY.text).alias("display_text")
    )


def display_text_wide(spark: SparkSession, sf: str) -> DataFrame:
    return _spoken(spark, sf).select(
        "conv_id", "turn", display_text(F.col("narrative"), BACKFILL.text).alias("display_text")
    )


def parse_response_query(spark: SparkSession, sf: str) -> DataFrame:
    spoken = _spoken(spark, sf)
    response = F.when(F.col("role") == "assistant", F.to_json("narrative")) \
        .when(F.col("role") == "system", F.to_json("narrative.bullets")) \
        .otherwise(F.concat(F.lit(" "), F.col("text")))
    told = F.to_json("narrative")
    gap = F.to_json(F.col("narrative").withField("bullets", F.concat(
        F.array(F.lit(None).cast("string")), F.col("narrative.bullets"))))
    cases = {"as it is": response, "goes on": F.concat(told, F.lit(" and so on")),
             "fence": F.concat(told, F.lit("\n```")), "gap": gap}
    given = spoken.select("conv_id", "turn", F.explode(F.array(*[
        F.struct(F.lit(k).alias("kind"), v.alias("response")) for k, v in cases.items()
    ])).alias("r")).select("conv_id", F.concat_ws(" ", "turn", "r.kind").alias("turn"), "r.response")
    return _narrative_columns(given, parse_response(F.col("response"), DAILY.text))


def default_insight_query(spark: SparkSession, sf: str) -> DataFrame:
    rows = kpi_backfill(spark, sf).withColumn("n", default_insight(kpi_struct()))
    return rows.select(
        "insight_date", "insight_type", F.col("n.headline").alias("headline"),
        F.array_join("n.bullets", "|").alias("bullets"),
        F.array_join("n.actions", "|").alias("actions"),
    )


def generator_gate(spark: SparkSession, sf: str) -> DataFrame:
    gate = Gate(min_revenue=100000.0, min_orders=2, not_before="1996-01-01")
    return kpi_backfill(spark, sf).select(
        "insight_date", "insight_type", wants_model(kpi_struct(), gate).alias("use_model")
    )


def prompt_payload(spark: SparkSession, sf: str) -> DataFrame:
    windows = _latest_windows(spark, sf, "rolling30")
    inputs = with_inputs(
        kpis(tables.purchases(spark, sf), windows),
        movers(tables.attribution(spark, sf), windows, DAILY.movers),
    )
    payload = prompt_data(F.col("kpi"), F.col("top_movers"), F.lower("insight_type"))
    sent = inputs.select("insight_date", "insight_type", F.parse_json(payload).alias("p"))

    # All that was sent, read back: the KPI record, and each mover with its amounts.
    return sent.select(
        "insight_date", "insight_type", F.variant_get("p", "$.kpi.period", "string").alias("period"),
        F.variant_get("p", "$.kpi", KPI.simpleString()).alias("kpi"),
        F.posexplode_outer(F.variant_get(
            "p", "$.top_movers", T.ArrayType(MOVER).simpleString())).alias("mover_pos", "m"),
    ).select("insight_date", "insight_type", "period", *_kpi_columns(), "mover_pos", "m.*")


def prompt_text(spark: SparkSession, sf: str) -> DataFrame:
    """The prompt around the data, for either preset; the data is in ``prompt_payload``."""
    windows = _latest_windows(spark, sf, "rolling30")
    inputs = with_inputs(
        kpis(tables.purchases(spark, sf), windows),
        movers(tables.attribution(spark, sf), windows, DAILY.movers),
    )
    data = prompt_data(F.col("kpi"), F.col("top_movers"))
    both = F.explode(F.array(*[
        F.struct(F.lit(p.name).alias("preset"), F.replace(
            prompt(F.col("kpi"), F.col("top_movers"), p.text), data, F.lit("{}")).alias("text"))
        for p in (DAILY, BACKFILL)])).alias("p")
    return inputs.select("insight_date", "insight_type", both).select(
        "insight_date", "insight_type", "p.*")


def _kpi_columns() -> list[Column]:
    return [F.col(f"kpi.{f.name}").alias(f"kpi_{f.name}") for f in KPI.fields]


def _whole(rows: DataFrame) -> DataFrame:
    """Every stored column as a plain one, a row for each mover and one for none."""
    return rows.withColumnRenamed("kpi_used", "kpi").select(
        "insight_date", "insight_type", "window_start", "window_end", "headline",
        F.array_join("bullets", "|").alias("bullets"),
        F.array_join("actions", "|").alias("actions"),
        *_kpi_columns(), "model_name", "prompt_tokens", "created_at", "raw_prompt",
        F.to_json("raw_response").alias("raw_response"), "display_text",
        F.posexplode_outer("top_movers_used").alias("mover_pos", "m"),
    ).select("*", "m.*").drop("m")


def _facts(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, tuple[date, date]]:
    return (tables.purchases(spark, sf), tables.attribution(spark, sf),
            tables.order_span(spark, sf))


def insights_latest(spark: SparkSession, sf: str) -> DataFrame:
    return _whole(latest_insights(*_facts(spark, sf)))


def insights_backfill(spark: SparkSession, sf: str) -> DataFrame:
    return _whole(historical_insights(*_facts(spark, sf)))


def _job_tables(spark: SparkSession, sf: str) -> Tables:
    """The facts and the date dimension stored where a job finds them."""
    folder = fresh_folder(spark, "job")
    named = Tables(*[f"{folder}/{n}" for n in (
        "purchases", "attribution", "dates", "insights", "purchase-totals", "attribution-totals")])
    catalog.publish_table(tables.purchases(spark, sf), named.purchases)
    catalog.publish_table(tables.attribution(spark, sf), named.attribution)
    catalog.publish_table(tables.calendar(spark, sf), named.dates)
    return named


def run_latest_stored(spark: SparkSession, sf: str) -> DataFrame:
    """The daily job, run twice, as its table has it afterwards."""
    named = _job_tables(spark, sf)
    run_latest(spark, named, now=FIRST_RUN)
    return _whole(run_latest(spark, named, now=SECOND_RUN))


def run_backfill_whole(spark: SparkSession, sf: str) -> DataFrame:
    """The historical job over its whole span, as its table has it afterwards."""
    return _whole(run_backfill(spark, _job_tables(spark, sf), now=FIRST_RUN))


def run_backfill_stored(spark: SparkSession, sf: str) -> DataFrame:
    """The historical job from the second year on, as its table has it afterwards; the whole span
    is ``run_backfill_whole``."""
    first, _ = tables.order_span(spark, sf)
    start = date.fromordinal(first.toordinal() + 365)
    return _whole(run_backfill(spark, _job_tables(spark, sf), start=start, now=FIRST_RUN))


def _stored_totals(spark: SparkSession, named: Tables) -> tuple[DataFrame, DataFrame]:
    store_totals(spark, named)
    return read_totals(spark, named.purchase_totals), read_totals(spark, named.attribution_totals)


def insight_holes(spark: SparkSession, sf: str) -> DataFrame:
    """A table that lost the Total insight of every first of a month and all of one day: those,
    and only those, are built again, from stored running totals."""
    named, span = _job_tables(spark, sf), tables.order_span(spark, sf)
    facts = [spark.read.parquet(p) for p in (named.purchases, named.attribution)]
    stored = historical_insights(*facts, span).where(
        ~((F.col("insight_type") == "Total") & (F.dayofmonth("insight_date") == 1))
        & (F.col("insight_date") != "1995-06-15"))
    return _whole(missing_insights(*_stored_totals(spark, named), span, stored))


def insight_changes(spark: SparkSession, sf: str) -> DataFrame:
    """The historical job ran while four days were missing from the facts. They are brought in, and
    every insight that depends on one of them, and no other, is written anew."""
    named = _job_tables(spark, sf)
    first, last = tables.order_span(spark, sf)
    days = [date.fromordinal(d) for d in (
        first.toordinal() + 500, first.toordinal() + 501, last.toordinal() - 40, last.toordinal())]
    known = replace(named, purchases=f"{named.purchases}-before", attribution=f"{named.attribution}-before")
    for now, then in ((named.purchases, known.purchases), (named.attribution, known.attribution)):
        catalog.publish_table(spark.read.parquet(now).where(~F.col("date").isin(days)), then)
    run_backfill(spark, known, now=FIRST_RUN)
    store_totals(spark, known)
    changed = spark.createDataFrame([(d,) for d in days], "date date")
    return _whole(run_changes(spark, named, changed, now=SECOND_RUN))


def window_sums_at(spark: SparkSession, sf: str) -> DataFrame:
    """Revenue and orders of every window of the calendar, read from running totals that were
    stored half way and brought up to date from there."""
    named = _job_tables(spark, sf)
    first, last = tables.order_span(spark, sf)
    half = date.fromordinal((first.toordinal() + last.toordinal()) // 2)
    facts = spark.read.parquet(named.purchases)
    write_totals(facts.where(F.col("date") < F.lit(half)), named.purchase_totals, ["revenue", "orders"], half)
    refresh_totals(facts, named.purchase_totals, ["revenue", "orders"], half, last)
    windows = period_windows(tables.calendar(spark, sf), first, "calendar")
    return kpi_columns(sums_at(read_totals(spark, named.purchase_totals), windows, ["revenue", "orders"]))


def free_window(spark: SparkSession, sf: str) -> DataFrame:
    """Insights of two windows that are no period, both ending on the last day."""
    purchases, attribution, (_, last) = _facts(spark, sf)
    windows = [single_window(date.fromordinal(last.toordinal() - n), last) for n in (9, 99)]
    inputs = with_inputs(kpis(purchases, windows), movers(attribution, windows, DAILY.movers))
    return _whole(build_insights(inputs, DAILY))


def window_labels(spark: SparkSession, sf: str) -> DataFrame:
    windows = period_windows_query(spark, sf)
    return windows.select("insight_date", "insight_type", window_label().alias("label"),
                          window_label("prev_start", "prev_end").alias("prev_label"))


def generated_insights(spark: SparkSession, sf: str) -> DataFrame:
    def orders_told(prompts: list[str]) -> list[str]:
        """A stand-in generator: repeats the order count it finds in the prompt's data. Defined
        here, so that it travels to the tasks by value."""
        answers = []
        for text in prompts:
            data, _ = json.JSONDecoder().raw_decode(text[text.index('{"kpi"'):])
            answers.append(json.dumps({
                "headline": f"{data['kpi']['orders']} orders",
                "bullets": [data["kpi"]["period"], *[m["campaign"] for m in data["top_movers"]]],
                "actions": [],
            }))
        return answers

    def lines(texts: list[str]) -> list[int]:
        """A stand-in for a tokenizer: counts the lines."""
        return [t.count("\n") for t in texts]

    rows = historical_insights(*_facts(spark, sf), respond=orders_told, model_name="told",
                               count_tokens=lines)
    return rows.select(
        "insight_date", "insight_type", "headline", F.array_join("bullets", "|").alias("bullets"),
        F.size("actions").alias("n_actions"), "model_name", "prompt_tokens",
        F.variant_get("raw_response", "$.headline", "string").alias("raw_headline"),
    )


# --- data quality --------------------------------------------------------------------------

def dq_not_null(spark: SparkSession, sf: str) -> DataFrame:
    return quality.check_not_null(_staged(spark, sf))


def dq_unique(spark: SparkSession, sf: str) -> DataFrame:
    keyed = staging.with_row_key(staging.standardise(
        tables.delivered_twice(tables.flat_events(spark, sf))))
    return quality.check_unique(keyed)


def dq_accepted_values(spark: SparkSession, sf: str) -> DataFrame:
    return quality.check_accepted(_staged(spark, sf))


def dq_row_key_recompute(spark: SparkSession, sf: str) -> DataFrame:
    """The keys of one item's rows have been written wrongly, those of another are missing."""
    wrong = F.when(F.col("item_id") == "7", F.reverse("row_key")) \
        .when(F.col("item_id") == "8", F.lit(None)).otherwise(F.col("row_key"))
    return quality.check_row_key(_staged(spark, sf).withColumn("row_key", wrong))


def dq_purchase_lines(spark: SparkSession, sf: str) -> DataFrame:
    staged = _staged(spark, sf)
    return quality.check_purchase_lines(staged, purchase_lines(staged))


def dq_param_keys(spark: SparkSession, sf: str) -> DataFrame:
    """Views carry their first parameter twice."""
    twice = F.concat("event_params", F.slice("event_params", 1, 1))
    raw = tables.raw_events(spark, sf).withColumn("event_params", F.when(
        F.col("event_name") == "view_item", twice).otherwise(F.col("event_params")))
    return quality.check_param_keys(raw, ["page_location", "page_referrer", "ga_session_id"])


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "scan_date_range": scan_date_range,
    "roundtrip_partitioned": roundtrip_partitioned,
    "load_by_pattern": load_by_pattern,
    "skipped_files": skipped_files,
    "incremental_load": incremental_load,
    "lake_listing": lake_listing,
    "named_tables": named_tables,
    "materialised_layers": materialised_layers,
    "variant_to_typed": variant_to_typed,
    "variant_cast_losses": variant_cast_losses,
    "reload_date_range": reload_date_range,
    "insight_schema_evolve": insight_schema_evolve,
    "upsert_insights": upsert_insights,
    "upsert_insights_strict": upsert_insights_strict,
    "insights_for_date": insights_for_date,
    "latest_insights": latest_insights_query,
    "flatten_params": flatten_params,
    "explode_items": explode_items,
    "flatten_explode": flatten_explode,
    "flatten_keyjoin": flatten_keyjoin,
    "stg_events": stg_events,
    "row_key": row_key,
    "dedup_lineitem": dedup_lineitem,
    "purchase_lines": purchase_lines_query,
    "fct_purchases_daily": fct_purchases_daily,
    "fct_attribution_daily": fct_attribution_daily,
    "attribution_from_events": attribution_from_events,
    "dim_channel": dim_channel_query,
    "date_span": date_span_query,
    "purchases_zero_filled": purchases_zero_filled,
    "star_channel": star_channel,
    "revenue_reconciliation": revenue_reconciliation,
    "source_labels": source_labels,
    "period_windows": period_windows_query,
    "period_windows_edate": period_windows_edate,
    "kpi_window": kpi_window,
    "kpi_backfill": kpi_backfill,
    "rolling_kpis": rolling_kpis_query,
    "movers_fulljoin": movers_fulljoin,
    "movers_nullsafe": movers_nullsafe,
    "movers_conditional": movers_conditional,
    "movers_backfill": movers_backfill,
    "movers_records": movers_records,
    "movers_rank": movers_rank,
    "trend_ma7": trend_ma7,
    "trend_wow": trend_wow,
    "trend_zscore": trend_zscore,
    "channel_trends": channel_trends,
    "period_over_period": period_over_period,
    "scalar_dates": scalar_dates,
    "scalar_timestamps": scalar_timestamps,
    "scalar_formatting": scalar_formatting,
    "sanitize_insight": sanitize_insight,
    "display_text_compact": display_text_compact,
    "display_text_wide": display_text_wide,
    "parse_response": parse_response_query,
    "default_insight": default_insight_query,
    "generator_gate": generator_gate,
    "prompt_payload": prompt_payload,
    "prompt_text": prompt_text,
    "generated_insights": generated_insights,
    "run_latest_stored": run_latest_stored,
    "run_backfill_whole": run_backfill_whole,
    "run_backfill_stored": run_backfill_stored,
    "insight_holes": insight_holes,
    "insight_changes": insight_changes,
    "window_sums_at": window_sums_at,
    "free_window": free_window,
    "window_labels": window_labels,
    "insights_latest": insights_latest,
    "insights_backfill": insights_backfill,
    "dq_not_null": dq_not_null,
    "dq_unique": dq_unique,
    "dq_accepted_values": dq_accepted_values,
    "dq_row_key_recompute": dq_row_key_recompute,
    "dq_purchase_lines": dq_purchase_lines,
    "dq_param_keys": dq_param_keys,
}
