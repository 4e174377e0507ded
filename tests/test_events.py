from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tideglass.functions.scalars import micros_to_ntz, ntz_text, ntz_to_micros
from tideglass.operators.quality import check_param_keys
from tideglass.schemas import FLAT_EVENT, RAW_EVENT
from tideglass.sources import events
from tideglass.sources.events import explode_items, flatten_events, flatten_params, scan_events
from tideglass.sources.lake import replace_table

HAT = ("h", "Hat", "Wear", 10.5, 2)
MUG = ("m", "Mug", "Home", 4.0, 1)


def text(key, value):
    return (key, (value, None))


def number(key, value):
    return (key, (None, value))


def event(day="20201201", micros=1606780800000001, name="purchase", user="u1", params=(), items=()):
    return (day, micros, name, user, ("NL", "UT"), ("mobile",), ("google", "cpc", "sale"),
            None if params is None else list(params), None if items is None else list(items))


@pytest.fixture
def raw(spark):
    return spark.createDataFrame([
        event(items=[HAT], params=[text("page_location", "/a"), number("ga_session_id", 7)]),
        event(micros=1606780800000002, items=[MUG, HAT],
              params=[text("page_location", "/first"), text("page_location", "/second")]),
        event(name="view", items=None, params=None),
        event(name="scroll"),
        event(user=None, items=[MUG]),
        event(day="20201130", items=[HAT]),
    ], RAW_EVENT)


def test_flat_columns_and_types(raw):
    assert flatten_events(raw).schema.simpleString() == FLAT_EVENT.simpleString()


def test_absent_and_repeated_params(raw):
    rows = {r.event_timestamp.microsecond: r
            for r in flatten_params(raw.where("event_name = 'purchase' and user_pseudo_id = 'u1' "
                                              "and event_date = '20201201'")).collect()}
    assert (rows[1].page_location, rows[1].page_referrer, rows[1].ga_session_id) == ("/a", None, 7)
    assert (rows[2].page_location, rows[2].ga_session_id) == ("/first", None)
    assert all(r.page_location is None
               for r in flatten_params(raw.where("event_name = 'view'")).collect())


def test_repeated_params_are_counted(raw):
    found = {r.param: r.failures for r in check_param_keys(
        raw, ["page_location", "ga_session_id"]).collect()}
    assert found == {"page_location": 1, "ga_session_id": 0}


def test_explode_keeps_events_without_items(raw):
    flat = flatten_events(raw)
    assert flat.count() == 7
    kept = flat.where("event_name in ('view', 'scroll')").collect()
    assert [r.item_id for r in kept] == [None, None]
    assert explode_items(raw).count() == 5


def test_keyjoin_pairs_same_named_events_of_a_user_and_day(raw):
    flat = flatten_events(raw, "20201201", "20201231", mode="keyjoin")
    bought = flat.where("event_name = 'purchase' and user_pseudo_id = 'u1'")
    # two events and the three items of both
    assert bought.count() == 6
    # a NULL user equals nothing, so this event keeps no item, not even its own
    assert [r.item_id for r in flat.where("user_pseudo_id is null").collect()] == [None]
    assert flat.where("event_name in ('view', 'scroll')").count() == 2


def test_one_range_for_events_and_items(raw):
    for mode in ("explode", "keyjoin"):
        days = {r[0] for r in flatten_events(raw, "20201130", "20201130", mode)
                .select("event_dt").collect()}
        assert days == {date(2020, 11, 30)}
        november = flatten_events(raw, "20201130", "20201130", mode).collect()
        assert [r.item_id for r in november] == ["h"]


def test_unknown_mode(raw):
    with pytest.raises(ValueError):
        flatten_events(raw, mode="outer")


def test_scan_prunes_days(spark, raw, tmp_path):
    replace_table(raw, str(tmp_path / "raw"), "event_date")
    scan = scan_events(spark, str(tmp_path / "raw"), "20201201", "20201201")
    plan = scan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan
    assert scan.count() == 5


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_timestamps_do_not_depend_on_the_session_zone(spark, zone):
    moments = [datetime(2021, 3, 14, 2, 30, 0, 1), datetime(1969, 12, 31, 23, 59, 59, 999999),
               datetime(2020, 11, 1, 1, 30), datetime(2001, 1, 1, 0, 0, 0, 500000)]
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.createDataFrame([(m,) for m in moments], "ts timestamp_ntz")
        micros = ntz_to_micros(F.col("ts"))
        got = df.select("ts", micros.alias("us"), micros_to_ntz(micros).alias("back"),
                        ntz_text(F.col("ts")).alias("text")).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    epoch = datetime(1970, 1, 1)
    for row in got:
        gap = row.ts - epoch
        assert row.us == (gap.days * 86400 + gap.seconds) * 1_000_000 + gap.microseconds
        assert row.back == row.ts
        assert row.text == row.ts.strftime("%Y-%m-%d %H:%M:%S.%f")


def test_hot_user_keeps_all_pairs(spark):
    """One user has a third of all events; the key join gives every pair, the explode every item."""
    hot = [event(micros=i, user="hot", items=[HAT]) for i in range(40)]
    cold = [event(micros=i, user=f"u{i}", items=[MUG]) for i in range(80)]
    raw = spark.createDataFrame(hot + cold, RAW_EVENT)
    assert flatten_events(raw, mode="keyjoin").count() == 40 * 40 + 80
    assert flatten_events(raw).count() == 120


def test_keyjoin_sends_items_once_and_repeats_those_of_hot_keys_alone(spark, monkeypatch):
    """Items used to be exploded and repeated eight times before the shuffle, whatever their key."""
    monkeypatch.setattr(events, "HOT_EVENTS", 30)
    hot = [event(micros=i, user="hot", items=[HAT, None] if i % 2 else []) for i in range(40)]
    cold = [event(micros=i, user=f"u{i % 40}", items=[MUG]) for i in range(80)]
    unknown = [event(micros=i, user=None, items=[HAT]) for i in range(40)]
    raw = spark.createDataFrame(hot + cold + unknown, RAW_EVENT)
    got = flatten_events(raw, mode="keyjoin")
    pairs = flatten_params(raw).join(explode_items(raw), ["event_dt", "event_name", "user_pseudo_id"], "left")
    assert sorted(map(str, got.collect())) == sorted(map(str, pairs.select(*got.columns).collect()))
    assert got.count() == 40 * 40 + 40 * 2 * 2 + 40
    before = got._jdf.queryExecution().optimizedPlan().toString().split("Join ")[1]
    assert "explode(items" not in before and "explode(sequence" not in before
