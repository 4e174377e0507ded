"""Named tables: reading by name or path, publishing as view or table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tideglass.config import Tables


def read_table(
    spark: SparkSession, tables: Tables, name: str, schema: T.StructType | None = None
) -> DataFrame:
    """A Parquet path when ``name`` has a slash, else a catalog table or view."""
    if "/" in name:
        reader = spark.read.schema(schema) if schema is not None else spark.read
        return reader.parquet(name)
    return spark.table(tables.qualify(name))


def publish_view(df: DataFrame, name: str) -> None:
    """Staging layer: computed again on each read."""
    df.createOrReplaceTempView(name)


def publish_table(df: DataFrame, path: str, partition: str | None = None) -> None:
    """Mart layer: stored, and replaced as a whole on each run."""
    if partition is None:
        df.write.mode("overwrite").parquet(path)
    else:
        (
            df.hint("rebalance", F.col(partition))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "static")
            .partitionBy(partition)
            .parquet(path)
        )
