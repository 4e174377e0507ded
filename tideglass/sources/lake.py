"""The date-partitioned Parquet lake between export and staging."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tideglass.functions.scalars import micros_to_ntz
from tideglass.schemas import FLAT_EVENT
from tideglass.sources.workspace import stage

DAY_FOLDER = "date"
EVENT_DAY = "event_dt"


def write_by_date(df: DataFrame, path: str, date_col: str = "event_dt") -> None:
    """Write ``date=YYYY-MM-DD`` folders, replacing the days present in ``df`` and no others.

    One job replaces a loop over days. The rebalance hint lets AQE size the files from the
    measured shuffle: small days share a task, and a day holding most rows is split over many.
    ``date_col`` stays in the files; the folder name is a copy of it.
    """
    (
        df.withColumn(DAY_FOLDER, F.col(date_col))
        .hint("rebalance", F.col(DAY_FOLDER))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(DAY_FOLDER)
        .parquet(path)
    )


def replace_table(df: DataFrame, path: str, date_col: str = "event_dt") -> None:
    """Create or replace the whole table, partitioned by ``date_col``."""
    (
        df.hint("rebalance", F.col(date_col))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .partitionBy(date_col)
        .parquet(path)
    )


def list_files(spark: SparkSession, path: str, glob: str = "*.parquet") -> DataFrame:
    """Path, size and change time of the files below ``path``; no file content is read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", glob)
        .load(path)
        .select("path", "length", "modificationTime")
    )


def load_events(
    spark: SparkSession,
    path: str,
    dates: tuple[date | str, date | str] | None = None,
    pattern: str | None = None,
    on_error: str = "abort",
    schema: T.StructType = FLAT_EVENT,
) -> DataFrame:
    """Flat events of the lake: all, a range of days, or the files whose path matches ``pattern``.

    ``dates`` prunes folders and is the preferred way. ``pattern`` is a regular expression for
    the whole path; a range of months loaded by three patterns elsewhere is one alternation here.
    ``on_error="abort"`` fails the read at an unreadable file, ``"continue"`` skips it;
    ``loads.skipped_files`` then names what was left out. Parquet has no per-row continue: a file is
    read or skipped as a whole.
    """
    if on_error not in ("continue", "abort"):
        raise ValueError(f"unknown on_error {on_error!r}")
    events = (
        spark.read.schema(T.StructType([*schema.fields, T.StructField(DAY_FOLDER, T.DateType())]))
        .option("basePath", path)
        .option("ignoreCorruptFiles", str(on_error == "continue").lower())
        .parquet(path)
    )
    if EVENT_DAY in schema.names:  # not the mark of an emptied day
        events = events.where(F.col(EVENT_DAY).isNotNull() | F.col(DAY_FOLDER).isNull())
    if dates is not None:
        first, last = (F.to_date(F.lit(str(d))) for d in dates)
        events = events.where(F.col(DAY_FOLDER).between(first, last))
    if pattern is not None:
        events = events.where(F.col("_metadata.file_path").rlike(f"^(?:{pattern})$"))
    return events


def type_variant_rows(
    df: DataFrame, column: str = "v", schema: T.StructType = FLAT_EVENT, strict: bool = True
) -> DataFrame:
    """Rows held in one VARIANT column to typed columns; a missing path gives NULL.

    Timestamps are epoch microseconds in the variant. ``strict=False`` turns a value that does
    not fit its type into NULL, otherwise it is an error.
    """
    get = F.variant_get if strict else F.try_variant_get
    v = F.col(column)
    return df.select(*[
        micros_to_ntz(get(v, f"$.{f.name}", "bigint")).alias(f.name)
        if isinstance(f.dataType, T.TimestampNTZType)
        else get(v, f"$.{f.name}", f.dataType.simpleString()).alias(f.name)
        for f in schema.fields
    ])


def cast_losses(df: DataFrame, column: str = "v", schema: T.StructType = FLAT_EVENT) -> DataFrame:
    """Per column, how many values a lenient load turns into NULL: present in the variant, but
    not of the type wanted. One pass, one row."""
    v = F.col(column)

    def lost(field: T.StructField):
        kind = "bigint" if isinstance(field.dataType, T.TimestampNTZType) \
            else field.dataType.simpleString()
        value = F.try_variant_get(v, f"$.{field.name}", "variant")
        there = value.isNotNull() & ~F.is_variant_null(value)
        return F.count_if(there & F.try_variant_get(v, f"$.{field.name}", kind).isNull())

    return df.agg(*[lost(f).alias(f.name) for f in schema.fields])


def reload_dates(
    df: DataFrame, path: str, start: date, end: date, date_col: str = "event_dt"
) -> None:
    """Make the lake hold, for ``start``..``end``, exactly the rows of ``df`` in that range.

    Days of the range that ``df`` has no rows for are emptied as well, as deleting the range
    before an insert would do. Replacing and emptying are one overwrite: an emptied day gets one
    row with nothing but its folder, which ``load_events`` leaves out (a row's own date is never
    NULL in the folder of a day). A run that dies before the commit changes nothing.
    """
    spark = df.sparkSession
    in_range = df.where(F.col(date_col).between(F.lit(start), F.lit(end)))
    stored = (
        spark.read.schema(T.StructType().add(DAY_FOLDER, T.DateType()))
        .option("basePath", path).parquet(path)
        .where(F.col(DAY_FOLDER).between(F.lit(start), F.lit(end)))
    )
    emptied = stored.distinct().join(
        in_range.select(F.col(date_col).alias(DAY_FOLDER)).distinct(), DAY_FOLDER, "left_anti")
    rows = in_range.withColumn(DAY_FOLDER, F.col(date_col)).unionByName(
        emptied, allowMissingColumns=True)
    (
        stage(rows, "reloaded-days").hint("rebalance", F.col(DAY_FOLDER))
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(DAY_FOLDER).parquet(path)
    )
