"""Data-quality checks as queries (Q1-Q4, Q6). Each returns what it finds; nothing is raised."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tideglass.functions.keys import ROW_KEY_COLUMNS, row_key

REQUIRED = ("event_dt", "event_ts", "event_name", "user_pseudo_id", "row_key")

# fixed values: device categories that pass
DEVICES = ("desktop", "mobile", "tablet", "(unknown)")


def check_not_null(df: DataFrame, columns: Sequence[str] = REQUIRED) -> DataFrame:
    """(column_name, failures) for each column, counted in one pass."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).alias("failures")) for c in columns
    ])).alias("r")).select("r.*")


def check_unique(df: DataFrame, columns: Sequence[str] = ("row_key",)) -> DataFrame:
    """The key values that occur more than once, with their count; NULL keys are not compared."""
    present = df
    for c in columns:
        present = present.where(F.col(c).isNotNull())
    return present.groupBy(*columns).agg(F.count("*").alias("n")).where("n > 1")


def check_accepted(
    df: DataFrame, column: str = "device_category", values: Sequence[str] = DEVICES
) -> DataFrame:
    """The values outside the accepted ones, with their count; NULL passes."""
    return df.where(~F.col(column).isin(*values)).groupBy(column).agg(F.count("*").alias("n"))


def check_row_key(staged: DataFrame, columns: Sequence[str] = ROW_KEY_COLUMNS) -> DataFrame:
    """Rows in all, and rows whose stored key differs from the key computed again."""
    again = row_key(staged, tuple(columns))
    return staged.agg(
        F.count("*").alias("n_rows"),
        F.count_if(~F.col("row_key").eqNullSafe(again)).alias("mismatches"),
    )


def check_purchase_lines(staged: DataFrame, lines: DataFrame) -> DataFrame:
    """Purchase rows without price or quantity: kept in staging, absent from the lines."""
    incomplete = F.col("price").isNull() | F.col("quantity").isNull()
    both = staged.where(F.col("event_name") == "purchase").select(
        F.lit("staging").alias("layer"), incomplete.alias("incomplete")
    ).unionByName(lines.select(F.lit("lines").alias("layer"), incomplete.alias("incomplete")))
    return both.groupBy("layer").agg(
        F.count("*").alias("n_rows"), F.count_if("incomplete").alias("n_incomplete")
    )


def check_param_keys(raw: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per parameter, the events that carry its key more than once (the first one is used)."""
    def repeated(key: str) -> Column:
        return F.size(F.filter("event_params", lambda p: p["key"] == key)) > 1

    counts = raw.agg(*[F.count_if(repeated(k)).alias(k) for k in keys])
    return counts.select(F.explode(F.array(*[
        F.struct(F.lit(k).alias("param"), F.col(k).alias("failures")) for k in keys
    ])).alias("r")).select("r.*")
