"""The stored insights: additive schema, keyed upsert, point read, latest.

The table holds four rows per day, some 1,500 a year, so it is partitioned by year: an upsert
rewrites the years it touches, and a read of one date opens one small folder.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from tideglass.schemas import INSIGHT
from tideglass.sources.workspace import fresh_folder, remove_folder

YEAR = "insight_year"
STORED = T.StructType([*INSIGHT.fields, T.StructField(YEAR, T.IntegerType())])


def conform_to_schema(df: DataFrame, schema: T.StructType = INSIGHT) -> DataFrame:
    """``df`` with exactly the columns of ``schema``: missing ones become typed NULLs."""
    present = {c.lower(): c for c in df.columns}
    return df.select(*[
        (F.col(present[f.name.lower()]).cast(f.dataType) if f.name.lower() in present
         else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in schema.fields
    ])


def create_if_missing(spark: SparkSession, path: str) -> None:
    """An empty table at ``path`` unless there is one; an existing table is left as it is."""
    spark.createDataFrame([], STORED).write.mode("ignore").partitionBy(YEAR).parquet(path)


def read_insights(spark: SparkSession, path: str) -> DataFrame:
    """All stored insights. Files written before a column existed yield NULL for it."""
    return spark.read.schema(STORED).option("basePath", path).parquet(path)


def _one_per_key(df: DataFrame, null_safe: bool, *first: Column) -> DataFrame:
    """One row a key, by ``first`` and then by all other columns, so that the order of the rows
    never decides. Without ``null_safe`` a NULL in the key makes a row a key of its own."""
    rest = [F.to_json(f.name) if isinstance(f.dataType, T.VariantType) else F.col(f.name)
            for f in INSIGHT.fields]
    rank = Window.partitionBy("insight_date", _type_key(null_safe)).orderBy(
        *first, *[c.asc_nulls_last() for c in rest])
    keyless = F.col("insight_date").isNull()
    if not null_safe:
        keyless = keyless | F.col("insight_type").isNull()
    return df.withColumn("_rank", F.row_number().over(rank)) \
        .where((F.col("_rank") == 1) | keyless).drop("_rank")


def _type_key(null_safe: bool) -> Column:
    return F.coalesce("insight_type", F.lit("")) if null_safe else F.col("insight_type")


def merge_rows(
    existing: DataFrame, rows: DataFrame, null_safe: bool = True, now: datetime | None = None
) -> DataFrame:
    """``existing`` after ``rows`` have been merged in by (insight_date, insight_type).

    A matched row is replaced, an unmatched one added; both get ``created_at = now``. With
    ``null_safe`` a NULL type is a key like ''; without, it matches nothing and is always added.
    Types are brought to title case on both sides, so that 'total' and 'Total' are one key. Of
    several rows for one key in ``rows`` one is kept, by a fixed order of all columns; of several
    stored rows for one key, as tables written elsewhere have, the newest.
    """
    # Given as text, the moment does not pass through any time zone.
    stamp = F.localtimestamp() if now is None else F.lit(now.isoformat()).cast("timestamp_ntz")
    rows = (
        conform_to_schema(rows)
        .withColumn("insight_type", F.initcap("insight_type"))
        .withColumn("created_at", stamp)
    )
    rows = _one_per_key(
        rows, null_safe, F.desc_nulls_last("window_end"), F.asc_nulls_last("headline"),
        F.asc_nulls_last("display_text"), F.asc_nulls_last("model_name"))
    existing = _one_per_key(
        conform_to_schema(existing).withColumn("insight_type", F.initcap("insight_type")),
        null_safe, F.desc_nulls_last("created_at"))

    replaced = rows.select(
        F.col("insight_date").alias("_date"), _type_key(null_safe).alias("_type")
    )
    kept = existing.join(
        replaced,
        (F.col("insight_date") == F.col("_date")) & (_type_key(null_safe) == F.col("_type")),
        "left_anti",
    )
    return kept.unionByName(rows)


def upsert(
    spark: SparkSession,
    path: str,
    rows: DataFrame,
    null_safe: bool = True,
    now: datetime | None = None,
) -> DataFrame:
    """Merge ``rows`` into the table at ``path`` and return the table.

    Only the years that ``rows`` touch are read and rewritten. The merged years are first written
    to the shared work folder, then put in place from there: the table is never overwritten while
    it is read, and a generator behind ``rows`` runs once. A run that dies can be run again with
    the same rows: years it had replaced come out the same. The work folders are removed at the
    end. One writer at a time.
    """
    create_if_missing(spark, path)
    given = fresh_folder(spark, "rows")
    conform_to_schema(rows).withColumn(YEAR, F.year("insight_date")) \
        .write.parquet(given)
    rows = spark.read.schema(STORED).parquet(given)

    # One value per calendar year: bounded by the span of the data, not by its size.
    years = [r[0] for r in rows.select(YEAR).distinct().collect()]
    touched = F.col(YEAR).isin([y for y in years if y is not None])
    if None in years:
        touched = touched | F.col(YEAR).isNull()
    merged = merge_rows(read_insights(spark, path).where(touched), rows, null_safe, now)

    staged = fresh_folder(spark, "merged")
    merged.withColumn(YEAR, F.year("insight_date")).write.parquet(staged)
    (
        spark.read.schema(STORED).parquet(staged)
        .hint("rebalance", F.col(YEAR))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(YEAR)
        .parquet(path)
    )
    spark.catalog.refreshByPath(path)
    remove_folder(spark, given)
    remove_folder(spark, staged)
    return read_insights(spark, path)


def insights_on(insights: DataFrame, day: date) -> DataFrame:
    """The rows of one date. The year is given as well, so that one folder is opened."""
    return insights.where((F.col(YEAR) == day.year) & (F.col("insight_date") == F.lit(day)))


def latest(insights: DataFrame, n: int = 16) -> DataFrame:
    """The newest version per (date, type), newest dates first, ``n`` rows, short headline."""
    newest = Window.partitionBy("insight_date", "insight_type").orderBy(
        F.desc_nulls_last("created_at"), F.asc_nulls_last("headline")
    )
    return (
        insights.select("insight_date", "insight_type", "created_at", "headline")
        .withColumn("_rank", F.row_number().over(newest))
        .where("_rank = 1")
        .orderBy(F.desc_nulls_last("insight_date"), F.asc_nulls_last("insight_type"))
        .limit(n)
        .select("insight_date", "insight_type", F.left("headline", F.lit(80)).alias("headline"))
    )
