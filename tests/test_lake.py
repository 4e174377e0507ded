import os
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tideglass.config import Tables
from tideglass.schemas import FLAT_EVENT
from tideglass.sources.catalog import publish_table, publish_view, read_table
from tideglass.sources.loads import LEDGER, load_new, read_ledger, read_loaded, skipped_files
from tideglass.sources.lake import (
    cast_losses, list_files, load_events, reload_dates, replace_table,
    type_variant_rows, write_by_date,
)
from tideglass.sources.workspace import fresh_folder


def events(spark, days, price=1.0):
    rows = [(date(2020, 12, d), datetime(2020, 12, d, 8, 0, 0, i), "view", "u", None, None, None,
             None, None, None, None, None, None, str(i), None, None, price, 1)
            for d in days for i in range(3)]
    return spark.createDataFrame(rows, FLAT_EVENT)


def per_day(df):
    return {r[0].day: r[1] for r in df.groupBy("date").count().collect()}


def test_each_write_replaces_its_days_only(spark, tmp_path):
    path = str(tmp_path / "lake")
    write_by_date(events(spark, [1, 2]), path)
    write_by_date(events(spark, [2, 3], price=9.0), path)
    stored = load_events(spark, path)
    assert per_day(stored) == {1: 3, 2: 3, 3: 3}
    assert stored.where("event_dt <> date").count() == 0
    assert {r[0] for r in stored.where("price = 9").select("event_dt").collect()} == {
        date(2020, 12, 2), date(2020, 12, 3)}


def test_replace_table_replaces_everything(spark, tmp_path):
    path = str(tmp_path / "flat")
    replace_table(events(spark, [1, 2]), path)
    replace_table(events(spark, [3]), path)
    assert spark.read.schema(FLAT_EVENT).parquet(path).count() == 3


def test_reload_empties_days_without_new_rows(spark, tmp_path):
    path = str(tmp_path / "lake")
    write_by_date(events(spark, [1, 2, 3, 4]), path)
    reload_dates(events(spark, [1, 2], price=5.0), path, date(2020, 12, 2), date(2020, 12, 3))
    assert per_day(load_events(spark, path)) == {1: 3, 2: 3, 4: 3}
    assert load_events(spark, path).where("price = 5").count() == 3
    # again: the same rows, not twice as many
    reload_dates(events(spark, [1, 2], price=5.0), path, date(2020, 12, 2), date(2020, 12, 3))
    assert per_day(load_events(spark, path)) == {1: 3, 2: 3, 4: 3}


def test_dates_prune_and_pattern_filters(spark, tmp_path):
    path = str(tmp_path / "lake")
    write_by_date(events(spark, [1, 2, 30]), path)
    some = load_events(spark, path, dates=("2020-12-01", "2020-12-02"))
    assert per_day(some) == {1: 3, 2: 3}
    assert "PartitionFilters: [isnotnull(date" in some._jdf.queryExecution().executedPlan().toString()
    assert per_day(load_events(spark, path, pattern=r".*date=2020-12-(0[1-9]|1[0-9])/.*")) == {1: 3, 2: 3}
    # the pattern is for the whole path
    assert load_events(spark, path, pattern=r"date=2020-12-01").count() == 0


def test_corrupt_file(spark, tmp_path):
    path = str(tmp_path / "lake")
    write_by_date(events(spark, [1, 2]), path)
    with open(os.path.join(path, "date=2020-12-02", "part-bad.parquet"), "wb") as bad:
        bad.write(b"this is no parquet file")
    with pytest.raises(Exception):
        load_events(spark, path).collect()
    assert per_day(load_events(spark, path, on_error="continue")) == {1: 3, 2: 3}
    # whatever their names, and not a sound file without rows or one that readers pass over
    for name in ("000000000001.parquet", "_hidden.parquet"):
        with open(os.path.join(path, "date=2020-12-01", name), "wb") as bad:
            bad.write(b"PAR1 but no more")
    events(spark, []).coalesce(1).drop("event_dt").write.mode("append").parquet(f"{path}/date=2020-12-02")
    skipped = {os.path.basename(r.path): r for r in skipped_files(spark, path).collect()}
    assert skipped.keys() == {"part-bad.parquet", "000000000001.parquet"}
    assert skipped["part-bad.parquet"].length == 23 and all(r.reason for r in skipped.values())
    os.remove(os.path.join(path, "date=2020-12-01", "000000000001.parquet"))
    # a file outside the pattern is not even opened
    good = load_events(spark, path, pattern=r".*date=2020-12-01/.*", on_error="abort")
    assert per_day(good) == {1: 3}
    with pytest.raises(ValueError):
        load_events(spark, path, on_error="ignore")


def test_list_files(spark, tmp_path):
    path = str(tmp_path / "lake")
    write_by_date(events(spark, [1, 2]), path)
    files = list_files(spark, path).collect()
    assert {f.path.split("/")[-2] for f in files} == {"date=2020-12-01", "date=2020-12-02"}
    assert all(f.length > 0 for f in files)


def variants(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "t string").select(
        F.parse_json("t").alias("v"))


def test_variant_rows(spark):
    good = '{"event_dt": "2020-12-01", "event_timestamp": 1606780800000001, "price": 2, "quantity": 3}'
    rows = type_variant_rows(variants(spark, good, "{}"))
    assert rows.schema.simpleString() == FLAT_EVENT.simpleString()
    first, empty = rows.collect()
    assert (first.event_dt, first.event_timestamp) == (
        date(2020, 12, 1), datetime(2020, 12, 1, 0, 0, 0, 1))
    assert (first.price, first.quantity, first.user_pseudo_id) == (2.0, 3, None)
    assert all(value is None for value in empty)


def test_variant_strict_and_lenient(spark):
    bad = variants(spark, '{"quantity": "many", "price": 1.5}', '{"price": null}')
    with pytest.raises(Exception):
        type_variant_rows(bad).collect()
    assert [(r.quantity, r.price) for r in type_variant_rows(bad, strict=False).collect()] == [
        (None, 1.5), (None, None)]
    losses = cast_losses(bad).first()
    assert (losses.quantity, losses.price, losses.user_pseudo_id) == (1, 0, 0)


def test_named_tables(spark, tmp_path):
    tables = Tables(namespace="sales")
    assert tables.qualify("fct") == "sales.fct"
    assert tables.qualify("other.fct") == "other.fct"
    assert tables.qualify("/data/fct") == "/data/fct"
    publish_view(events(spark, [1]), "flat_view")
    assert read_table(spark, Tables(), "flat_view").count() == 3
    for _ in range(2):
        publish_table(events(spark, [1, 2]), str(tmp_path / "mart"), "event_dt")
    assert read_table(spark, Tables(), str(tmp_path / "mart"), FLAT_EVENT).count() == 6


def test_work_folders_are_below_the_shared_one(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    one, two = fresh_folder(spark, "x"), fresh_folder(spark, "x")
    assert one != two and one.startswith(shared)


def test_loads_are_incremental_and_repeatable(spark, tmp_path):
    source, root = str(tmp_path / "in"), str(tmp_path / "table")
    assert read_loaded(spark, root).count() == 0
    write_by_date(events(spark, [1, 2]), source)
    bad = os.path.join(source, "date=2020-12-02", "000000000001.parquet")
    with open(bad, "wb") as file:
        file.write(b"no parquet")
    first = load_new(spark, source, root).collect()
    assert {r.outcome for r in first} == {"loaded", "failed"}
    failed = [r for r in first if r.outcome == "failed"]
    assert [os.path.basename(r.path) for r in failed] == ["000000000001.parquet"] and failed[0].reason
    assert per_day(read_loaded(spark, root).withColumn("date", F.col("event_dt"))) == {1: 3, 2: 3}
    assert load_new(spark, source, root).count() == 0          # nothing new, the bad one is known
    # a new day, and the damaged file comes again, sound
    write_by_date(events(spark, [3]), source)
    events(spark, [2]).coalesce(1).write.parquet(str(tmp_path / "sound"))
    part = next(f for f in os.listdir(tmp_path / "sound") if f.endswith(".parquet"))
    os.replace(tmp_path / "sound" / part, bad)
    second = load_new(spark, source, root).collect()
    assert {r.outcome for r in second} == {"loaded"} and sum(r.n_rows for r in second) == 6
    rows = read_loaded(spark, root).withColumn("date", F.col("event_dt"))
    assert per_day(rows) == {1: 3, 2: 6, 3: 3}
    # a load that dies before its ledger entry leaves nothing behind that is read
    events(spark, [9]).withColumn("source_file", F.lit("x")).write.parquet(f"{root}/rows/load_id=dead")
    assert per_day(read_loaded(spark, root).withColumn("date", F.col("event_dt"))) == {1: 3, 2: 6, 3: 3}
    with open(bad, "wb") as file:
        file.write(b"damaged again")
    with pytest.raises(RuntimeError):
        load_new(spark, source, root, on_error="abort")
    assert read_ledger(spark, root).columns == LEDGER.names
    assert read_ledger(spark, root).count() == len(first) + len(second)
