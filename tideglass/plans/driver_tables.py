"""The driver's star-schema tables seen as web events, order lines and facts.

Everything is derived from whole tables by column expressions, equi-joins and aggregates.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tideglass.functions.scalars import blank_to_null, money, ntz_to_micros
from tideglass.operators.marts import attribution_daily, date_spine, purchases_daily
from tideglass.schemas import FLAT_EVENT, RAW_EVENT


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _percent(c: str) -> Column:
    """0.07 -> 7."""
    return (F.col(c) * 100 + 0.5).cast("int")


def _compact(day: Column) -> Column:
    """DATE to 'yyyyMMdd'."""
    return F.replace(day.cast("string"), F.lit("-"), F.lit(""))


def _text(*parts: Column | str) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested raw events: one per order line, with as many items as its line number says."""
    discount, tax = _percent("l_discount"), _percent("l_tax")
    param = "struct<key:string,value:struct<string_value:string,int_value:bigint>>"

    def entry(key: str, text: Column | None = None, number: Column | None = None) -> Column:
        return F.struct(
            F.lit(key).alias("key"),
            F.struct(
                (F.lit(None) if text is None else text).cast("string").alias("string_value"),
                (F.lit(None) if number is None else number).cast("bigint").alias("int_value"),
            ).alias("value"),
        ).cast(param)

    def item(i: Column) -> Column:
        return F.struct(
            _text(F.col("l_partkey"), "-", i).alias("item_id"),
            _text("item ", i).alias("item_name"),
            F.col("l_returnflag").alias("item_category"),
            F.when(i < 7, F.col("l_extendedprice")).alias("price"),
            i.cast("bigint").alias("quantity"),
        )

    params = F.array(
        entry("page_location", text=_text("/part/", F.col("l_partkey"))),
        entry("ga_session_id", number=F.col("l_orderkey")),
    )
    referrer = F.array(entry("page_referrer", text=_text("/supplier/", F.col("l_suppkey"))))
    columns = {
        "event_date": _compact(F.to_date("l_shipdate")),
        "event_timestamp": ntz_to_micros(F.col("l_shipdate"))
        + F.col("l_orderkey") * 8 + F.col("l_linenumber"),
        "event_name": F.when(F.col("l_returnflag") == "N", "Purchase")
        .when(F.col("l_returnflag") == "A", "add_to_cart").otherwise("view_item"),
        "user_pseudo_id": F.col("l_suppkey").cast("string"),
        "geo": F.struct(F.col("l_linestatus").alias("country"),
                        F.col("l_returnflag").alias("region")),
        "device": F.struct(
            F.when(tax < 3, "desktop").when(tax < 5, "mobile").when(tax < 7, "tablet")
            .when(tax > 7, "smart tv").alias("category")
        ),
        "traffic_source": F.struct(
            F.when(discount == 0, "").otherwise(_text("src_", discount)).alias("source"),
            F.when(F.col("l_linestatus") == "F", "").otherwise("cpc").alias("medium"),
            _text("campaign_", tax).alias("name"),
        ),
        "event_params": F.when(discount >= 5, F.concat(params, referrer)).otherwise(params),
        "items": F.when(F.col("l_quantity") == 2, F.array().cast(RAW_EVENT["items"].dataType))
        .when(F.col("l_quantity") > 2,
              F.transform(F.sequence(F.lit(1), F.col("l_linenumber")), item)),
    }
    return table(spark, sf_dir, "lineitem").select(*[
        columns[f.name].cast(f.dataType).alias(f.name) for f in RAW_EVENT.fields
    ])


def flat_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat events out of the event stream, one item each."""
    kind = F.col("event_type")
    item = F.get_json_object("props", "$.k")
    columns = {
        "event_dt": F.to_date("ts"),
        "event_timestamp": F.col("ts"),
        "event_name": F.upper(kind),
        "user_pseudo_id": F.when(kind != "signup", F.col("user_id").cast("string")),
        "device_category": F.when(kind == "view", "desktop").when(kind == "click", "mobile")
        .when(kind == "error", "kiosk").when(kind == "purchase", "(unknown)"),
        "source": F.when(kind == "error", "").when(kind != "view", _text("web_", kind)),
        "medium": F.when(kind == "click", "").otherwise("organic"),
        "campaign": _text("k", item),
        "page_location": _text("/", kind),
        "ga_session_id": F.when(kind != "view", F.col("event_id")),
        "item_id": item,
        "item_name": _text("item ", item),
        "price": F.when(item != "7", F.col("value")),
        "quantity": F.lit(1),
    }
    return table(spark, sf_dir, "events").select(*[
        columns.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in FLAT_EVENT.fields
    ])


def delivered_twice(flat: DataFrame) -> DataFrame:
    """The flat events and, once more, all of them with a higher price under the same key."""
    return flat.unionByName(flat.withColumn("price", F.col("price") + 1))


def nested(flat: DataFrame) -> DataFrame:
    """Flat events put back into the raw nested layout, one item per event."""
    item = RAW_EVENT["items"].dataType.elementType
    return flat.select(
        _compact(F.col("event_dt")).alias("event_date"),
        ntz_to_micros(F.col("event_timestamp")).alias("event_timestamp"),
        "event_name", "user_pseudo_id",
        F.struct("country", "region").alias("geo"),
        F.struct(F.col("device_category").alias("category")).alias("device"),
        F.struct("source", "medium", F.col("campaign").alias("name")).alias("traffic_source"),
        F.array(
            F.struct(
                F.lit("page_location").alias("key"),
                F.struct(F.col("page_location").alias("string_value"),
                         F.lit(None).cast("bigint").alias("int_value")).alias("value"),
            ),
            F.struct(
                F.lit("ga_session_id").alias("key"),
                F.struct(F.lit(None).cast("string").alias("string_value"),
                         F.col("ga_session_id").alias("int_value")).alias("value"),
            ),
        ).alias("event_params"),
        F.array(F.struct(*item.fieldNames())).alias("items"),
    )


def order_lines(spark: SparkSession, sf_dir: str, channels: bool = True) -> DataFrame:
    """One purchase line per order, worth its discounted lines, with the order's channel.

    Lines are added up per order before any join, so an order with very many lines reaches the
    join as one row.
    """
    worth = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
        F.sum(money(F.col("l_extendedprice") * (1 - F.col("l_discount"))))
        .cast("double").alias("price")
    )
    orders = table(spark, sf_dir, "orders").join(
        worth, F.col("o_orderkey") == F.col("l_orderkey")
    )
    line = [
        F.to_date("o_orderdate").alias("event_dt"), F.col("o_orderdate").alias("event_ts"),
        F.col("o_custkey").cast("string").alias("user_pseudo_id"),
        F.col("o_orderkey").alias("ga_session_id"),
        F.lit("purchase").alias("event_name"), F.col("price"),
        F.lit(1).cast("bigint").alias("quantity"),
    ]
    if not channels:
        return orders.select(*line)
    customers = table(spark, sf_dir, "customer").join(
        table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    return orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).select(
        *line,
        F.col("c_mktsegment").alias("source"),
        F.nullif(F.col("o_orderpriority"), F.lit("4-NOT SPECIFIED")).alias("medium"),
        blank_to_null(F.col("n_name")).alias("campaign"),
    )


def purchases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return purchases_daily(order_lines(spark, sf_dir, channels=False))


def attribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return attribution_daily(order_lines(spark, sf_dir))


def order_span(spark: SparkSession, sf_dir: str) -> tuple[date, date]:
    """First and last order date: a scan of one column, one row to the driver."""
    return tuple(
        table(spark, sf_dir, "orders").agg(
            F.min(F.to_date("o_orderdate")), F.max(F.to_date("o_orderdate"))
        ).first()
    )


def calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The date dimension: every day between the first and the last order."""
    return date_spine(spark, *order_span(spark, sf_dir))
