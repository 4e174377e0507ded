"""Running totals kept as a table, and window sums read from it at their boundary days.

The table has, for each key, a row for every day with facts, holding the totals up to that day, and an
opening row for every later month, holding those up to the day before the month. It is partitioned by
month, so the totals as of any day are the last row of each key in one partition. A window sum is the
difference of two of them: a few windows cost the months of their boundary days, whatever the length
of the history and of the windows.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F, types as T

from tideglass.operators.marts import daily_totals
from tideglass.operators.windows import LABELS
from tideglass.schemas import MONEY_TOTAL
from tideglass.sources.workspace import stage

MONTH = "month"
ROWS = "n"  # the number of facts, kept beside the measures


def _points(facts: DataFrame, measures: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """One row a key and day; money given as DOUBLE is added as DECIMAL."""
    exact = facts.select("date", *keys, F.lit(1).cast("bigint").alias(ROWS), *[
        F.col(m).cast(MONEY_TOTAL).alias(m)
        if isinstance(facts.schema[m].dataType, (T.DoubleType, T.FloatType)) else F.col(m)
        for m in measures])
    return daily_totals(exact, [*measures, ROWS], keys).withColumnRenamed("date", "day")


def _with_openings(points: DataFrame, measures: Sequence[str], keys: Sequence[str],
                   last: date) -> DataFrame:
    """Running totals over ``points``, and the opening rows of the months up to ``last``."""
    by_day = W.partitionBy(*keys).orderBy("day")
    sums = by_day.rowsBetween(W.unboundedPreceding, 0)
    kinds = {m: points.schema[m].dataType for m in [*measures, ROWS]}
    running = points.select(
        *keys, "day", F.coalesce(F.lead("day").over(by_day), F.lit(last)).alias("_next"),
        *[F.sum(m).over(sums).cast(T.DecimalType(38, kind.scale) if isinstance(kind, T.DecimalType)
                                   else "bigint").alias(m) for m, kind in kinds.items()])
    month, after = F.trunc("day", "MM"), F.add_months(F.trunc("day", "MM"), 1)
    until = F.trunc("_next", "MM")
    opened = F.when(after <= until, F.sequence(after, until, F.expr("interval 1 month")))
    own = F.array(F.struct(month.alias(MONTH), F.col("day").alias("as_of")))
    openings = F.transform(
        opened, lambda m: F.struct(m.alias(MONTH), F.date_sub(m, 1).alias("as_of")))
    rows = F.explode(F.concat(own, F.coalesce(openings, F.array().cast(
        "array<struct<month:date,as_of:date>>")))).alias("r")
    return running.select(*keys, *kinds, rows).select(
        *keys, F.col("r.as_of").alias("day"), *kinds, f"r.{MONTH}")


def write_totals(facts: DataFrame, path: str, measures: Sequence[str], last: date,
                 keys: Sequence[str] = ()) -> None:
    """Builds the table from all facts. ``last`` is the last day that will be asked for; a key
    whose parts are NULL is a key. Without facts the table is empty."""
    _with_openings(_points(facts.where(F.col("date") <= F.lit(last)), measures, keys), measures, keys, last) \
        .write.mode("overwrite").partitionBy(MONTH).parquet(path)


def read_totals(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).withColumn(MONTH, F.col(MONTH).cast("date"))


def refresh_totals(facts: DataFrame, path: str, measures: Sequence[str], changed_from: date,
                   last: date, keys: Sequence[str] = ()) -> None:
    """Brings the table up to date after facts of ``changed_from`` or later have changed.

    The month's opening rows stand for all that was before, so neither earlier facts nor earlier
    totals are read; months from there on are replaced by one dynamic overwrite.
    """
    spark = facts.sparkSession
    stored = read_totals(spark, path)
    newest = stored.agg(F.max(MONTH)).first()[0]
    if newest is None:
        write_totals(facts, path, measures, last, keys)
        return
    month = min(changed_from.replace(day=1), newest)
    opening = stored.where((F.col(MONTH) == F.lit(month)) & (F.col("day") < F.lit(month))).drop(MONTH)
    points = _points(facts.where(F.col("date").between(F.lit(month), F.lit(last))), measures, keys)
    points = opening.unionByName(points).select(*opening.columns)
    fresh = _with_openings(points, measures, keys, last).where(F.col(MONTH) >= F.lit(month))
    stage(fresh, "totals").write.mode("overwrite").option("partitionOverwriteMode", "dynamic") \
        .partitionBy(MONTH).parquet(path)
    spark.catalog.refreshByPath(path)


def sums_at(totals: DataFrame, windows: DataFrame, measures: Sequence[str],
            keys: Sequence[str] = ()) -> DataFrame:
    """The columns of ``sums_for_windows`` for a table of windows. With keys, a key has a row for
    each window that one of its facts falls into, now or before; without, every window has one."""
    names = [*measures, ROWS]
    sides = F.array(*[
        F.struct(day.alias("as_of"), F.lit(side).alias("side"), F.lit(plus).alias("plus"))
        for day, side, plus in (
            (F.col("window_end"), "cur", True), (F.date_sub("window_start", 1), "cur", False),
            (F.col("prev_end"), "prev", True), (F.date_sub("prev_start", 1), "prev", False))])
    probes = windows.select(*LABELS, F.explode(sides).alias("p")).select(*LABELS, "p.*")
    days = probes.select(F.col("as_of").alias("_as_of")).distinct()
    stood = totals.join(
        days, (F.col(MONTH) == F.trunc("_as_of", "MM")) & (F.col("day") <= F.col("_as_of"))
    ).groupBy("_as_of", *keys).agg(F.max_by(F.struct(*names), "day").alias("t"))
    found = probes.join(stood, F.col("as_of") == F.col("_as_of"))

    def total(m: str, side: str):
        value = F.when(F.col("plus"), F.col(f"t.{m}")).otherwise(-F.col(f"t.{m}"))
        return F.sum(F.when(F.col("side") == side, value)).alias(f"{m}_{side}")

    columns = [f"{m}_{side}" for m in names for side in ("cur", "prev")]
    sums = found.groupBy(*LABELS, *keys).agg(*[total(m, s) for m in names for s in ("cur", "prev")])
    filled = [F.coalesce(c, F.lit(0)).cast(sums.schema[c].dataType).alias(c) for c in columns]
    if keys:
        return sums.select(*LABELS, *keys, *filled).where("n_cur > 0 or n_prev > 0")
    of = sums.select(*[F.col(c).alias(f"_of_{c}") for c in LABELS], *columns)
    same = F.lit(True)
    for c in LABELS:
        same = same & F.col(c).eqNullSafe(F.col(f"_of_{c}"))
    return windows.select(*LABELS).join(of, same, "left").select(*LABELS, *filled)
