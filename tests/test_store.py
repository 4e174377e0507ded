import os
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tideglass.schemas import INSIGHT
from tideglass.sources.insight_store import (
    conform_to_schema, create_if_missing, insights_on, latest, merge_rows, read_insights, upsert,
)

T1, T2 = datetime(2021, 1, 1), datetime(2021, 1, 2)
DAY, OTHER = date(2020, 12, 31), date(2021, 1, 1)


def rows(spark, *items):
    return spark.createDataFrame(list(items), "insight_date date, insight_type string, headline string")


def content(df):
    return sorted((str(r.insight_date), str(r.insight_type), r.headline, r.created_at)
                  for r in df.select("insight_date", "insight_type", "headline", "created_at").collect())


def test_insert_then_update(spark, tmp_path):
    path = str(tmp_path / "insights")
    upsert(spark, path, rows(spark, (DAY, "Day", "a"), (DAY, "Week", "b"), (OTHER, "Day", "c")), now=T1)
    table = upsert(spark, path, rows(spark, (DAY, "Day", "new"), (DAY, "Month", "d")), now=T2)
    assert content(table) == [
        ("2020-12-31", "Day", "new", T2), ("2020-12-31", "Month", "d", T2),
        ("2020-12-31", "Week", "b", T1), ("2021-01-01", "Day", "c", T1)]


def test_twice_is_once(spark, tmp_path):
    path = str(tmp_path / "insights")
    batch = rows(spark, (DAY, "Day", "a"), (DAY, None, "b"))
    once = content(upsert(spark, path, batch, now=T1))
    assert content(upsert(spark, path, batch, now=T1)) == once


def test_null_type_is_a_key_or_is_none(spark, tmp_path):
    batch = rows(spark, (DAY, None, "a"))
    for null_safe, n in ((True, 1), (False, 2)):
        path = str(tmp_path / f"insights-{null_safe}")
        upsert(spark, path, batch, null_safe, T1)
        assert upsert(spark, path, batch, null_safe, T2).count() == n
    blank = upsert(spark, str(tmp_path / "insights-True"), rows(spark, (DAY, "", "b")), True, T2)
    assert blank.count() == 1        # NULL and '' are one key


def test_rows_without_a_date_are_kept(spark, tmp_path):
    path = str(tmp_path / "insights")
    upsert(spark, path, rows(spark, (None, "Day", "a"), (DAY, "Day", "b")), now=T1)
    table = upsert(spark, path, rows(spark, (None, "Day", "c")), now=T2)
    assert sorted(r.headline for r in table.collect()) == ["a", "b", "c"]


def test_case_of_type_is_one_key(spark, tmp_path):
    path = str(tmp_path / "insights")
    upsert(spark, path, rows(spark, (DAY, "total", "a")), now=T1)
    assert content(upsert(spark, path, rows(spark, (DAY, "Total", "b")), now=T2)) == [
        ("2020-12-31", "Total", "b", T2)]


def test_stored_lower_case_types_match(spark, tmp_path):
    """A table written elsewhere may hold 'total' where 'Total' comes in."""
    path = str(tmp_path / "insights")
    conform_to_schema(rows(spark, (DAY, "total", "a"), (DAY, "week", "b"), (DAY, "Week", "c"))) \
        .withColumn("created_at", F.when(F.col("headline") != "c", F.lit("2021-01-01"))
                    .otherwise(F.lit("2020-01-01")).cast("timestamp_ntz")) \
        .withColumn("insight_year", F.year("insight_date")) \
        .write.partitionBy("insight_year").parquet(path)
    assert content(upsert(spark, path, rows(spark, (DAY, "Total", "new")), now=T2)) == [
        ("2020-12-31", "Total", "new", T2), ("2020-12-31", "Week", "b", datetime(2021, 1, 1))]


def test_ties_do_not_depend_on_row_order(spark):
    batch = spark.createDataFrame(
        [(DAY, "Day", "a", n, [f"b{n}"]) for n in (2, 0, 1)],
        "insight_date date, insight_type string, headline string, prompt_tokens long, bullets array<string>")
    none = conform_to_schema(rows(spark))
    for df in (batch, batch.orderBy("prompt_tokens"), batch.orderBy(F.desc("prompt_tokens"))):
        kept = merge_rows(none, df.coalesce(1), now=T1).collect()
        assert [(r.prompt_tokens, r.bullets) for r in kept] == [(0, ["b0"])]


def test_work_folders_are_removed(spark, tmp_path):
    root = spark.conf.get("spark.checkpoint.dir") + "/tideglass"
    before = set(os.listdir(root)) if os.path.isdir(root) else set()
    upsert(spark, str(tmp_path / "i"), rows(spark, (DAY, "Day", "a")), now=T1)
    assert set(os.listdir(root)) == before


def test_same_key_twice_in_one_batch(spark, tmp_path):
    batch = rows(spark, (DAY, "Day", "b"), (DAY, "day", "a"))
    assert content(upsert(spark, str(tmp_path / "i"), batch, now=T1)) == [("2020-12-31", "Day", "a", T1)]


def test_untouched_years_are_not_rewritten(spark, tmp_path):
    path = str(tmp_path / "insights")
    upsert(spark, path, rows(spark, (DAY, "Day", "a"), (OTHER, "Day", "c")), now=T1)
    before = set(read_insights(spark, path).where("insight_date = '2020-12-31'").inputFiles())
    files = {f for f in before if "insight_year=2020" in f}
    upsert(spark, path, rows(spark, (OTHER, "Day", "d")), now=T2)
    after = {f for f in read_insights(spark, path).inputFiles() if "insight_year=2020" in f}
    assert files == after and files


def test_older_layout(spark, tmp_path):
    path = str(tmp_path / "older")
    rows(spark, (DAY, "x", "a")).drop("insight_type").withColumn("insight_year", F.lit(2020)) \
        .write.partitionBy("insight_year").parquet(path)
    table = read_insights(spark, path)
    assert (table.first().headline, table.first().insight_type, table.first().display_text) == ("a", None, None)
    assert upsert(spark, path, rows(spark, (DAY, "Day", "b")), now=T1).count() == 2
    conformed = conform_to_schema(rows(spark, (DAY, "Day", "a")))
    assert conformed.schema.simpleString() == INSIGHT.simpleString()


def test_create_leaves_an_existing_table(spark, tmp_path):
    path = str(tmp_path / "insights")
    create_if_missing(spark, path)
    assert read_insights(spark, path).count() == 0
    upsert(spark, path, rows(spark, (DAY, "Day", "a")), now=T1)
    create_if_missing(spark, path)
    assert read_insights(spark, path).count() == 1


def test_raw_response_survives(spark, tmp_path):
    batch = rows(spark, (DAY, "Day", "a")).withColumn("raw_response", F.parse_json(F.lit('{"k": [1]}')))
    table = upsert(spark, str(tmp_path / "i"), batch, now=T1)
    assert table.select(F.to_json("raw_response")).first()[0] == '{"k":[1]}'


def test_point_read_opens_one_folder(spark, tmp_path):
    path = str(tmp_path / "insights")
    table = upsert(spark, path, rows(spark, (DAY, "Day", "a"), (OTHER, "Day", "b")), now=T1)
    found = insights_on(table, OTHER)
    assert [r.headline for r in found.collect()] == ["b"]
    plan = found.select("headline")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(insight_year" in plan


def test_latest(spark):
    versions = conform_to_schema(spark.createDataFrame(
        [(DAY, "Day", "old", T1), (DAY, "Day", "n" * 100, T2), (OTHER, "Week", "w", T1),
         (OTHER, "Day", "d", T1), (OTHER, None, "none", T1)],
        "insight_date date, insight_type string, headline string, created_at timestamp_ntz"))
    assert [tuple(r) for r in latest(versions, 4).collect()] == [
        (OTHER, "Day", "d"), (OTHER, "Week", "w"), (OTHER, None, "none"), (DAY, "Day", "n" * 80)]
    assert latest(versions, 2).count() == 2


def test_merge_without_files(spark):
    existing = conform_to_schema(rows(spark, (DAY, "Day", "a"), (DAY, "Week", "b")))
    merged = merge_rows(existing, rows(spark, (DAY, "day", "c")), now=T1)
    assert sorted(r.headline for r in merged.collect()) == ["b", "c"]
    stamped = merge_rows(existing, rows(spark, (DAY, "day", "c"))).where("headline = 'c'").first()
    assert stamped.created_at is not None
