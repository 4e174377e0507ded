"""Nested raw events to the flat event-by-item table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tideglass.functions.keys import EVENT_HASH, event_hash
from tideglass.functions.scalars import micros_to_ntz, parse_day
from tideglass.schemas import FLAT_EVENT, ITEM, RAW_EVENT

ITEM_COLUMNS = ITEM.fieldNames()

HOT_EVENTS = 1_000      # of one key of the key join, from which on they are dealt
HOT_BUCKETS = 10_000    # as many hash buckets of keys, the largest, the driver is told of
BUCKETS = 1 << 18
DEALT_EVENTS = 200_000  # for each task that events are dealt to, before their items are exploded


def scan_events(spark: SparkSession, path: str, start: str, end: str) -> DataFrame:
    """Raw events of the days ``start``..``end`` ('yyyyMMdd', inclusive).

    The table is partitioned by ``event_date``, so the range prunes folders before any read.
    """
    raw = spark.read.schema(RAW_EVENT).option("basePath", path).parquet(path)
    return days_between(raw, start, end)


def days_between(raw: DataFrame, start: str | None, end: str | None) -> DataFrame:
    if start is not None:
        raw = raw.where(F.col("event_date") >= start)
    if end is not None:
        raw = raw.where(F.col("event_date") <= end)
    return raw


def param(key: str, kind: str) -> Column:
    """Value of one event parameter, NULL when absent; the first one counts if a key repeats.

    The position among the keys picks the value at that position: plain array expressions, which
    stay in generated code and read only the nested fields they name. A higher-order filter would
    do the same interpreted. ``get`` gives NULL for position 0 - 1, where ``element_at`` raises.
    """
    position = F.array_position("event_params.key", F.lit(key)).cast("int")
    return F.get(F.col(f"event_params.value.{kind}"), position - 1)


def event_columns() -> list[Column]:
    """The thirteen event-level columns of the flat table."""
    return [
        parse_day(F.col("event_date")).alias("event_dt"),
        micros_to_ntz(F.col("event_timestamp")).alias("event_timestamp"),
        F.col("event_name"),
        F.col("user_pseudo_id"),
        F.col("geo.country").alias("country"),
        F.col("geo.region").alias("region"),
        F.col("device.category").alias("device_category"),
        F.col("traffic_source.source").alias("source"),
        F.col("traffic_source.medium").alias("medium"),
        F.col("traffic_source.name").alias("campaign"),
        param("page_location", "string_value").alias("page_location"),
        param("page_referrer", "string_value").alias("page_referrer"),
        param("ga_session_id", "int_value").alias("ga_session_id"),
    ]


def flatten_params(raw: DataFrame) -> DataFrame:
    """One row per event: struct fields and parameters as plain columns. No shuffle."""
    return raw.select(*event_columns())


def explode_items(raw: DataFrame) -> DataFrame:
    """One row per item with its event's day, name and user; events without items drop out."""
    return raw.select(
        parse_day(F.col("event_date")).alias("event_dt"),
        "event_name",
        "user_pseudo_id",
        F.explode("items").alias("item"),
    ).select("event_dt", "event_name", "user_pseudo_id", *[f"item.{c}" for c in ITEM_COLUMNS])


def _hot_buckets(raw: DataFrame, bucket: Column) -> list[int]:
    """The buckets with HOT_EVENTS or more, the largest first and HOT_BUCKETS at most. One scan of
    the key, and a shuffle of a count for each bucket and task."""
    counted = raw.groupBy(bucket.alias("bucket")).count().where(F.col("count") >= HOT_EVENTS)
    return [r.bucket for r in counted.orderBy(F.desc("count"), "bucket").limit(HOT_BUCKETS).collect()]


def _tasks(raw: DataFrame) -> int:
    at_least = int(raw.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(at_least, -(-raw.count() // DEALT_EVENTS))


def flatten_events(
    raw: DataFrame, start: str | None = None, end: str | None = None, mode: str = "explode",
    salt: int = 8, deal_by: Sequence[str] = (),
) -> DataFrame:
    """The 18-column flat table for one range of days, used for events and items alike.

    ``explode``  each event with its own items; events without items keep one row with NULL item
                 columns. A narrow plan: no join, no shuffle. With ``deal_by`` (event columns, or
                 EVENT_HASH, which the flat table then has too) events are shuffled by those
                 before their items are exploded, so that a later step whose keys hold them, as
                 the de-duplication or a distinct, shuffles no rows of items. It counts the events
                 first, to deal DEALT_EVENTS to a task; rows alike in ``deal_by`` share a task.
    ``keyjoin``  events joined to items on (day, event name, user). The key holds no timestamp,
                 so an event meets the items of all same-named events its user had that day, and
                 the result grows with the product of the two sides. That product is the defined
                 content of the older table, so nothing is left out here; use it only to
                 reproduce that table. Items travel as the arrays they came in, once, and are
                 exploded after the join. The events of a hot key are dealt over ``salt`` join keys
                 and its items repeated for each, so that it is worked on by ``salt`` tasks; raise
                 it with the largest key's share of the rows. Which keys are hot is counted first,
                 which runs a job.
    """
    raw = days_between(raw, start, end)
    if mode == "explode":
        events = raw.select(*event_columns(), "items")
        if deal_by:
            if EVENT_HASH in deal_by:
                events = events.withColumn(EVENT_HASH, event_hash(events, "event_timestamp"))
            events = events.repartition(_tasks(raw), *deal_by)
        flat = events.select("*", F.explode_outer("items").alias("item")).select(
            "*", *[f"item.{c}" for c in ITEM_COLUMNS]
        )
    elif mode == "keyjoin":
        key = ["event_dt", "event_name", "user_pseudo_id"]
        bucket = F.pmod(F.xxhash64(*key), F.lit(BUCKETS)).cast("int")
        keyed = raw.withColumn("event_dt", parse_day(F.col("event_date")))
        is_hot = bucket.isin(_hot_buckets(keyed, bucket))
        one_of = F.pmod(F.xxhash64("event_timestamp", "ga_session_id"), F.lit(salt)).cast("int")
        dealt = flatten_params(raw).withColumn("_salt", F.when(is_hot, one_of).otherwise(0))
        items = keyed.where(F.size("items") > 0).select(*key, "items", F.explode(
            F.when(is_hot, F.sequence(F.lit(0), F.lit(salt - 1))).otherwise(F.array(F.lit(0)))
        ).alias("_salt"))
        flat = dealt.join(items, [*key, "_salt"], "left").select(
            *dealt.columns, F.explode_outer("items").alias("item")
        ).select("*", *[f"item.{c}" for c in ITEM_COLUMNS])
    else:
        raise ValueError(f"unknown flatten mode {mode!r}")
    return flat.select(*FLAT_EVENT.fieldNames(), *[c for c in deal_by if c == EVENT_HASH])
