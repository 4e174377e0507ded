"""Scalar expressions: dates, timestamps, text, money and guarded division."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tideglass.schemas import MONEY, MONEY_TOTAL

# Whitespace at either end, as Unicode sees it, plus the four ASCII separator controls.
_EDGE_SPACE = r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$"


def parse_day(text: Column) -> Column:
    """'yyyyMMdd' text to DATE; NULL when the text is no such date."""
    return F.try_to_date(text, "yyyyMMdd")


def micros_to_ntz(micros: Column) -> Column:
    """Epoch microseconds to TIMESTAMP_NTZ, whatever the session time zone."""
    epoch = F.expr("timestamp_ntz'1970-01-01 00:00:00'")
    return F.timestamp_add("MICROSECOND", micros, epoch)


def ntz_to_micros(ts: Column) -> Column:
    """TIMESTAMP_NTZ to epoch microseconds, whatever the session time zone. ``unix_micros`` and
    ``timestamp_diff`` would go through the zone."""
    since_epoch = ts - F.expr("timestamp_ntz'1970-01-01 00:00:00'")
    seconds = since_epoch.cast("interval second").cast("decimal(18,6)")
    return (seconds * 1000000).cast("bigint")


def ntz_text(ts: Column) -> Column:
    """'yyyy-MM-dd HH:mm:ss.ffffff'. The cast drops trailing zeros, so they are put back;
    ``date_format`` would move a wall-clock time that falls into a DST gap of the session zone."""
    text = ts.cast("string")
    return F.substring(
        F.concat(text, F.when(F.length(text) == 19, F.lit(".000000")).otherwise(F.lit("000000"))),
        1, 26,
    )


def blank_to_null(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def strip(text: Column) -> Column:
    return F.regexp_replace(text, _EDGE_SPACE, "")


def money(amount: Column) -> Column:
    return amount.cast(MONEY)


def daily_money(amount: Column) -> Column:
    return amount.cast(MONEY_TOTAL)


def ratio(numerator: Column, denominator: Column) -> Column:
    """Division in DOUBLE; NULL where the denominator is zero or NULL."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def thousands(number: Column) -> Column:
    """1234567.5 -> '1,234,568' (half-even, no decimals)."""
    return F.format_number(number, 0)


def json_text(value: Column) -> Column:
    """JSON that keeps NULL fields."""
    return F.to_json(value, {"ignoreNullFields": "false"})
