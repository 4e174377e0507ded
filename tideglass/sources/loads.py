"""Incremental, repeatable loading of files into a table, with a ledger.

A load takes the files below a source that the ledger does not have yet (by path, size and change
time), writes their rows, and then adds one ledger row a file: loaded, empty or failed, with the
reason. Rows lie in a folder of their load, and only loads that the ledger names are read: a load that
died before its ledger entry is as if it had never run, and may be repeated.
"""

from __future__ import annotations

import io
from collections.abc import Iterator
from datetime import datetime

import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tideglass.schemas import FLAT_EVENT
from tideglass.sources.lake import list_files
from tideglass.sources.workspace import fresh_folder, remove_folder, stage

LEDGER = T.StructType([
    T.StructField("path", T.StringType()), T.StructField("length", T.LongType()),
    T.StructField("changed", T.TimestampType()), T.StructField("load_id", T.StringType()),
    T.StructField("loaded_at", T.TimestampNTZType()), T.StructField("outcome", T.StringType()),
    T.StructField("reason", T.StringType()), T.StructField("n_rows", T.LongType()),
])
LOADED, EMPTY, FAILED = "loaded", "empty", "failed"
LARGEST = 1 << 30  # bytes of a file without rows that are looked into for the reason


def plain_path(path: Column | str) -> Column:
    """A local path without its scheme, which readers write in different ways."""
    return F.regexp_replace(path, "^file:/+", "/")


def data_files(spark: SparkSession, source: str) -> DataFrame:
    """The files that a reader of ``source`` would read, whatever their names: path, length,
    changed. Names that begin with a dot or an underscore are left out, as readers do."""
    return list_files(spark, source, "*").select(
        plain_path("path").alias("path"), "length", F.col("modificationTime").alias("changed"))


def _footer(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        reasons: list[str | None] = []
        for content in batch["content"]:
            try:
                rows = pq.read_metadata(io.BytesIO(content)).num_rows
                reasons.append(f"{rows} rows in the footer, none readable" if rows else None)
            except (pa.ArrowException, OSError) as error:
                reasons.append(str(error).split("\n")[0])
        yield pd.DataFrame({"path": batch["path"], "reason": reasons})


def examine(spark: SparkSession, files: DataFrame) -> DataFrame:
    """Of files that gave no row, path and the reason; NULL for a sound file without rows. Their
    content is read in tasks, a file at a time."""
    # As many names as files gave no row. The reader's own listing holds as many on the driver.
    paths = [r.path for r in files.where(F.col("length") <= LARGEST).select("path").collect()]
    large = files.where(F.col("length") > LARGEST).select(
        "path", F.lit("gives no row and is too large to look into").alias("reason"))
    if not paths:
        return large
    content = spark.read.format("binaryFile").load(paths).select(plain_path("path").alias("path"), "content")
    return large.unionByName(content.mapInPandas(_footer, "path string, reason string"))


def outcomes(spark: SparkSession, files: DataFrame, rows_of: DataFrame) -> DataFrame:
    """``files`` with outcome, reason and n_rows, given the number of rows read from each path."""
    counted = files.join(rows_of, "path", "left")
    silent = stage(counted.where("n_rows is null").select("path", "length"), "silent-files")
    reasons = examine(spark, silent)
    return counted.join(reasons, "path", "left").select(
        *files.columns, F.when(F.col("n_rows") > 0, F.lit(LOADED)).when(
            F.col("reason").isNull(), F.lit(EMPTY)).otherwise(F.lit(FAILED)).alias("outcome"),
        "reason", F.coalesce("n_rows", F.lit(0).cast("long")).alias("n_rows"))


def skipped_files(spark: SparkSession, source: str, schema: T.StructType = FLAT_EVENT) -> DataFrame:
    """The files below ``source`` that a read with ``on_error="continue"`` leaves out, whatever
    their names: path, length, reason. A sound file without rows loses nothing and is not listed."""
    rows_of = spark.read.schema(schema).option("ignoreCorruptFiles", "true").parquet(source).groupBy(
        plain_path("_metadata.file_path").alias("path")).agg(F.count("*").alias("n_rows"))
    return outcomes(spark, data_files(spark, source), rows_of).where(
        F.col("outcome") == FAILED).select("path", "length", "reason")


def read_ledger(spark: SparkSession, root: str) -> DataFrame:
    """One row a file and load; empty before the first load."""
    spark.createDataFrame([], LEDGER).write.mode("append").parquet(f"{root}/ledger")
    return spark.read.schema(LEDGER).parquet(f"{root}/ledger")


def new_files(spark: SparkSession, source: str, root: str) -> DataFrame:
    """The files that are not in the ledger as they are now: new, or changed since they were
    loaded or found damaged. A file that comes again with another content is loaded again."""
    known = read_ledger(spark, root).select("path", "length", "changed")
    return data_files(spark, source).join(known, ["path", "length", "changed"], "left_anti")


def load_new(
    spark: SparkSession, source: str, root: str, on_error: str = "continue",
    schema: T.StructType = FLAT_EVENT, now: datetime | None = None,
) -> DataFrame:
    """Loads what is new below ``source`` and returns the ledger rows of this load.

    ``on_error="continue"`` leaves out a file that cannot be read, ``"abort"`` fails and leaves the
    table as it was. A source without new files adds nothing. One writer at a time.
    """
    if on_error not in ("continue", "abort"):
        raise ValueError(f"unknown on_error {on_error!r}")
    files = stage(new_files(spark, source, root), "new-files")
    paths = [r.path for r in files.select("path").collect()]  # the reader lists them there as well
    if not paths:
        return read_ledger(spark, root).limit(0)
    rows_folder = fresh_folder(spark, "load")
    load_id = rows_folder.rsplit("-", 1)[1]
    target = f"{root}/rows/load_id={load_id}"
    (
        spark.read.schema(schema).option("ignoreCorruptFiles", "true").parquet(*paths)
        .select(*schema.names, plain_path("_metadata.file_path").alias("source_file"))
        .write.parquet(target)
    )
    rows_of = spark.read.parquet(target).groupBy(F.col("source_file").alias("path")).agg(
        F.count("*").alias("n_rows"))
    entry = stage(outcomes(spark, files, rows_of), "load-entry")
    if on_error == "abort" and entry.where(F.col("outcome") == FAILED).limit(1).count():
        remove_folder(spark, target)
        raise RuntimeError(f"files below {source} cannot be read")
    stamp = F.localtimestamp() if now is None else F.lit(now.isoformat()).cast("timestamp_ntz")
    # The one step that makes the load's rows visible.
    entry.withColumn("load_id", F.lit(load_id)).withColumn("loaded_at", stamp) \
        .select(*LEDGER.names).coalesce(1).write.mode("append").parquet(f"{root}/ledger")
    return read_ledger(spark, root).where(F.col("load_id") == load_id)


def read_loaded(spark: SparkSession, root: str, schema: T.StructType = FLAT_EVENT) -> DataFrame:
    """The rows of all loads in the ledger. Of a file that was loaded again after a change, the
    rows of its newest load."""
    ledger = read_ledger(spark, root).where(F.col("outcome") != FAILED)
    current = ledger.groupBy("path").agg(
        F.max_by("load_id", F.struct("loaded_at", "changed", "load_id")).alias("load_id"))
    stored = T.StructType([*schema.fields, T.StructField("source_file", T.StringType()),
                           T.StructField("load_id", T.StringType())])
    if not ledger.where(F.col("outcome") == LOADED).limit(1).count():
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(stored).option("basePath", f"{root}/rows").parquet(f"{root}/rows")
    return rows.join(
        current, (rows["load_id"] == current["load_id"]) & (F.col("source_file") == F.col("path")),
        "left_semi").select(*schema.names)
