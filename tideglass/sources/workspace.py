"""Where a job may put intermediate tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def fresh_folder(spark: SparkSession, purpose: str) -> str:
    """A new, unused folder that the driver and all executors see.

    It lies under the folder that ``spark.checkpoint.dir`` names, or, without that setting, under
    the session's warehouse folder, which is shared for the same reasons.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{root.rstrip('/')}/tideglass/{purpose}-{uuid.uuid4().hex}"


def remove_folder(spark: SparkSession, folder: str) -> None:
    """Deletes a folder on whatever store it lies. PySpark has no call for it, so this one place
    goes through the JVM's file systems; it needs a classic session."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def stage(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written to a fresh folder and read again: cuts the lineage, and what comes after
    neither computes ``df`` twice nor depends on the executors that did."""
    folder = fresh_folder(df.sparkSession, purpose)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)
