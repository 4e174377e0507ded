"""Purchase lines, daily facts, dimensions, zero-filled series."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from tideglass.functions.keys import channel_key
from tideglass.functions.scalars import daily_money, money, ratio
from tideglass.schemas import CHANNEL

# What makes two purchase lines one order.
ORDER_KEY = ("user_pseudo_id", "ga_session_id", "event_ts")

# What makes two raw rows one purchase line in the strict revenue baseline.
STRICT_LINE_KEY = (
    "event_dt", "user_pseudo_id", "ga_session_id", "item_id", "item_name", "price", "quantity",
)


def purchase_lines(staged: DataFrame) -> DataFrame:
    """Purchase events that carry both a price and a quantity."""
    return staged.where(
        (F.col("event_name") == "purchase")
        & F.col("price").isNotNull() & F.col("quantity").isNotNull()
    )


def line_revenue() -> Column:
    return money(F.col("price") * F.col("quantity"))


def _order_count(order_key: Sequence[str]) -> Column:
    # A struct is never NULL itself, so an order without a session still counts.
    return F.count_distinct(F.struct(*order_key))


def purchases_daily(lines: DataFrame, order_key: Sequence[str] = ORDER_KEY) -> DataFrame:
    """Revenue, distinct orders and average order value per day.

    The distinct count is planned in two steps, first by (day, order) and then by day, so one
    day holding most lines is spread over the orders it has.
    """
    return (
        lines.groupBy(F.col("event_dt").alias("date"))
        .agg(
            daily_money(F.sum(line_revenue())).alias("revenue"),
            _order_count(order_key).alias("orders"),
        )
        .withColumn("aov", F.coalesce(ratio(F.col("revenue"), F.col("orders")), F.lit(0.0)))
    )


def attribution_daily(lines: DataFrame, order_key: Sequence[str] = ORDER_KEY) -> DataFrame:
    """Revenue and distinct orders per day and channel; a NULL channel part is a value."""
    return lines.groupBy(F.col("event_dt").alias("date"), *CHANNEL).agg(
        daily_money(F.sum(line_revenue())).alias("revenue"),
        _order_count(order_key).alias("orders"),
    )


def dim_channel(attribution: DataFrame) -> DataFrame:
    """The distinct channels with their key."""
    return attribution.select(*CHANNEL).distinct().withColumn("channel_key", channel_key())


def date_spine(spark: SparkSession, first: date, last: date) -> DataFrame:
    """Every date from ``first`` to ``last``."""
    return spark.range(1).select(
        F.explode(F.sequence(F.lit(first), F.lit(last))).alias("date")
    )


def date_span(dates: DataFrame) -> DataFrame:
    return dates.agg(F.min("date").alias("min_date"), F.max("date").alias("max_date"))


def span_of(dates: DataFrame) -> tuple[date, date]:
    """First and last date of the date dimension; an empty one is an error. Runs a job."""
    first, last = date_span(dates).first()
    if last is None:
        raise RuntimeError("the date dimension is empty")
    return first, last


def zero_fill(daily: DataFrame, spine: DataFrame, measures: Sequence[str]) -> DataFrame:
    """One row per date of the spine; measures are 0 where the facts have no row."""
    return spine.join(daily.select("date", *measures), "date", "left").select(
        "date", *[F.coalesce(F.col(m), F.lit(0)).cast(daily.schema[m].dataType).alias(m)
                  for m in measures]
    )


def daily_totals(
    facts: DataFrame, measures: Sequence[str], keys: Sequence[str] = ()
) -> DataFrame:
    """One row per key and date. Facts built here already are; then this adds no shuffle, and for
    facts from elsewhere it bounds what the windows by key can meet: one row per calendar day."""
    def total(m: str) -> Column:
        # A sum of decimals is ten digits wider than its input; keep the width, let counts widen.
        kind = facts.schema[m].dataType
        return F.sum(m).cast(kind) if isinstance(kind, T.DecimalType) else F.sum(m)

    return facts.groupBy("date", *keys).agg(*[total(m).alias(m) for m in measures])


def spread_by(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``df`` partitioned by ``keys`` into the session's number of shuffle partitions.

    For rows that the next step multiplies. AQE sizes partitions by what enters them: it would
    merge the few megabytes of sparse facts into one task, which then grows them a hundredfold.
    A partitioning with a stated number is left alone, and windows by ``keys`` reuse it.
    """
    if not keys:
        return df
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def dense_series(
    daily: DataFrame,
    measures: Sequence[str],
    first: date,
    last: date,
    keys: Sequence[str] = (),
) -> DataFrame:
    """For each key a row for every date ``first``..``last``, zero where the facts have none.

    Each fact row fills the days up to the next one, and the first row also the days before it,
    so the grid needs neither a cross join nor a join back: one shuffle by key, of a group that
    cannot outgrow the calendar. Without keys the series is one row per day, and one task.
    """
    by_day = Window.partitionBy(*keys).orderBy("date")
    in_span = daily.where(F.col("date").between(F.lit(first), F.lit(last)))
    totals = daily_totals(in_span, measures, keys)
    placed = spread_by(totals, keys).select(
        *keys, "date", *measures,
        F.lag("date").over(by_day).alias("_before"),
        F.lead("date").over(by_day).alias("_after"),
    )
    fill_from = F.when(F.col("_before").isNull(), F.lit(first)).otherwise(F.col("date"))
    fill_to = F.coalesce(F.date_sub("_after", 1), F.lit(last))
    kinds = totals.schema
    return placed.withColumn("_day", F.explode(F.sequence(fill_from, fill_to))).select(
        *keys,
        F.col("_day").alias("date"),
        *[
            F.when(F.col("_day") == F.col("date"), F.col(m)).otherwise(F.lit(0))
            .cast(kinds[m].dataType).alias(m)
            for m in measures
        ],
    )


def star(attribution: DataFrame, dates: DataFrame, channels: DataFrame) -> DataFrame:
    """Facts with both dimensions. The channel join runs on the hashed key, which makes it an
    ordinary equi-join although channel parts may be NULL. No side is broadcast by hand: the
    channel dimension grows with the data, so the choice is left to its measured size."""
    facts = attribution.withColumn("channel_key", channel_key()).drop(*CHANNEL)
    return facts.join(dates, "date").join(channels, "channel_key")


def shorten_labels(
    df: DataFrame, labels: Mapping[str, str], column: str = "source", out: str = "source_label"
) -> DataFrame:
    """Adds ``out``: the display text of ``column``, mapped where ``labels`` names it."""
    shown = F.col(column)
    for value, text in labels.items():
        shown = F.when(F.col(column) == value, F.lit(text)).otherwise(shown)
    return df.withColumn(out, shown)


def strict_revenue(staged_raw: DataFrame, key: Sequence[str] = STRICT_LINE_KEY) -> DataFrame:
    """Revenue of the strict baseline: distinct purchase lines, whatever their row key."""
    lines = purchase_lines(staged_raw).select(*key).distinct()
    return lines.agg(daily_money(F.sum(line_revenue())).alias("revenue"))


def reconcile(mart: DataFrame, baseline: DataFrame, tolerance: float) -> DataFrame:
    """Mart revenue against the baseline, in one row: both totals, the gap, within tolerance.

    ``tolerance`` is a share of the baseline. Each side is a total, so one row per side meets.
    """
    tagged = mart.select(
        F.lit(True).alias("is_mart"), daily_money(F.col("revenue")).alias("revenue")
    ).unionByName(baseline.select(
        F.lit(False).alias("is_mart"), daily_money(F.col("revenue")).alias("revenue")
    ))
    totals = tagged.agg(
        F.coalesce(F.sum(F.when(F.col("is_mart"), F.col("revenue"))), F.lit(0))
        .cast("double").alias("mart_revenue"),
        F.coalesce(F.sum(F.when(~F.col("is_mart"), F.col("revenue"))), F.lit(0))
        .cast("double").alias("baseline_revenue"),
    )
    gap = F.col("mart_revenue") - F.col("baseline_revenue")
    return totals.select(
        "mart_revenue", "baseline_revenue", gap.alias("gap"),
        (F.abs(gap) <= F.abs("baseline_revenue") * F.lit(tolerance)).alias("within_tolerance"),
    )
