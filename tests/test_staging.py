import hashlib
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tideglass.functions.keys import EVENT_HASH, channel_key
from tideglass.operators import quality
from tideglass.operators.marts import (
    attribution_daily, date_span, date_spine, dense_series, dim_channel, purchase_lines,
    purchases_daily, reconcile, shorten_labels, span_of, star, strict_revenue, zero_fill,
)
from tideglass.operators.staging import dedup, newest_first, stage_events, standardise, with_row_key
from tideglass.schemas import FLAT_EVENT, RAW_EVENT, STAGED_EVENT
from tideglass.sources.events import flatten_events

AT = datetime(2020, 12, 1, 10, 0, 0, 5)


def flat_row(at=AT, name="Purchase", user="u1", source="google", medium="cpc", campaign="sale",
             device="mobile", session=7, item="h", price=10.0, quantity=2):
    return (at.date() if at else None, at, name, user, "NL", "UT", device, source, medium,
            campaign, "/a", None, session, item, "Hat", "Wear", price, quantity)


def flat(spark, *rows):
    return spark.createDataFrame(list(rows), FLAT_EVENT)


def key_of(*parts):
    return hashlib.md5("|".join(parts).encode()).hexdigest()


def test_columns_cleaning_and_key(spark):
    staged = stage_events(flat(spark, flat_row(source="", medium=None, campaign="")))
    assert staged.schema.simpleString() == STAGED_EVENT.simpleString()
    row = staged.first()
    assert (row.event_name, row.source, row.medium, row.campaign) == ("purchase",) + (None,) * 3
    assert row.row_key == key_of("2020-12-01 10:00:00.000005", "purchase", "u1", "7", "h")


def test_nulls_enter_the_key_as_empty_text(spark):
    rows = stage_events(flat(
        spark, flat_row(session=None, item=None), flat_row(session=None, item="")
    )).collect()
    assert len(rows) == 1
    assert rows[0].row_key == key_of("2020-12-01 10:00:00.000005", "purchase", "u1", "", "")


def test_pipe_inside_a_part_can_merge_keys(spark):
    # kept on purpose: stored keys have always been made this way
    rows = stage_events(flat(spark, flat_row(name="a|b", user="c"), flat_row(name="a", user="b|c")))
    assert rows.count() == 1


def test_copies_collapse_and_microseconds_do_not(spark):
    later = AT.replace(microsecond=6)
    staged = stage_events(flat(
        spark, flat_row(), flat_row(), flat_row(name="PURCHASE"), flat_row(price=12.0),
        flat_row(at=later),
    ))
    assert staged.count() == 2
    # the survivor of a tie is fixed: smallest price
    assert {r.price for r in staged.collect()} == {10.0}


def test_survivor_does_not_depend_on_row_order(spark):
    rows = [flat_row(price=float(p), quantity=q) for p in (5, 3, 4) for q in (2, 1)]
    first = stage_events(flat(spark, *rows)).collect()
    again = stage_events(flat(spark, *reversed(rows)).repartition(5)).collect()
    assert first == again and (first[0].price, first[0].quantity) == (3.0, 1)


def test_restricting_names_first_gives_the_same_rows(spark):
    rows = [flat_row(), flat_row(), flat_row(name="view"), flat_row(price=9.0), flat_row(item="m")]
    whole = stage_events(flat(spark, *rows)).where("event_name = 'purchase'")
    assert sorted(whole.collect()) == sorted(stage_events(flat(spark, *rows), ["purchase"]).collect())


def test_hot_key_is_cut_before_the_shuffle(spark):
    rows = [flat_row()] * 50 + [flat_row(item=f"i{i}") for i in range(100)]
    staged = stage_events(flat(spark, *rows).repartition(4))
    assert staged.count() == 101
    plan = staged._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_key_columns_are_a_parameter(spark):
    typed = standardise(flat(spark, flat_row(), flat_row(price=12.0)))
    keyed = with_row_key(typed, ["event_dt", "user_pseudo_id", "price"])
    assert dedup(keyed, ["row_key"], newest_first(keyed)).count() == 2


def test_quality_checks(spark):
    staged = stage_events(flat(
        spark, flat_row(), flat_row(user=None, item="m", device=None),
        flat_row(item="x", device="fridge"), flat_row(item="y", device="(unknown)", price=None),
    ))
    nulls = {r.column_name: r.failures for r in quality.check_not_null(staged).collect()}
    assert nulls == {"event_dt": 0, "event_ts": 0, "event_name": 0, "user_pseudo_id": 1, "row_key": 0}
    assert quality.check_unique(staged).count() == 0
    assert quality.check_unique(staged.unionByName(staged)).count() == 4
    assert [tuple(r) for r in quality.check_accepted(staged).collect()] == [("fridge", 1)]
    assert tuple(quality.check_row_key(staged).first()) == (4, 0)
    broken = staged.withColumn("row_key", F.when(F.col("item_id") != "m", F.col("row_key")))
    assert quality.check_row_key(broken).first().mismatches == 1
    lines = {r.layer: (r.n_rows, r.n_incomplete) for r in
             quality.check_purchase_lines(staged, purchase_lines(staged)).collect()}
    assert lines == {"staging": (4, 1), "lines": (3, 0)}


@pytest.fixture
def lines(spark):
    return purchase_lines(stage_events(flat(
        spark,
        flat_row(), flat_row(item="m", price=0.1, quantity=3),          # one order, two lines
        flat_row(session=None, price=1.0), flat_row(session=None, item="m", price=1.0),
        flat_row(source="", medium=None, price=5.0, item="z"),
        flat_row(at=datetime(2020, 12, 4, 9, 0), price=7.0, quantity=1),
        flat_row(name="view"), flat_row(item="n", price=None), flat_row(item="o", quantity=None),
    )))


def test_daily_facts(lines):
    rows = {r.date: r for r in purchases_daily(lines).collect()}
    first = rows[date(2020, 12, 1)]
    # an order without a session is an order; lines of one moment and session are one order
    assert (float(first.revenue), first.orders) == (34.3, 2)
    assert first.aov == 34.3 / 2
    assert rows[date(2020, 12, 4)].orders == 1
    channels = {(r.date.day, r.source, r.medium): float(r.revenue)
                for r in attribution_daily(lines).collect()}
    assert channels == {(1, "google", "cpc"): 24.3, (1, None, None): 10.0, (4, "google", "cpc"): 7.0}


def test_star_is_null_safe(spark, lines):
    facts = attribution_daily(lines)
    channels = dim_channel(facts)
    assert channels.count() == 2 and channels.select("channel_key").distinct().count() == 2
    joined = star(facts, date_spine(spark, date(2020, 12, 1), date(2020, 12, 4)), channels)
    assert joined.count() == facts.count()


def test_channel_key_keeps_shifted_and_missing_parts_apart(spark):
    rows = [("a|b", "c", None), ("a", "b|c", None), ("", None, None), (None, "", None), (None,) * 3]
    df = spark.createDataFrame(rows, "source string, medium string, campaign string")
    assert df.select(channel_key()).distinct().count() == len(rows)


def test_spine_zero_fill_and_span(spark, lines):
    spine = date_spine(spark, date(2020, 11, 30), date(2020, 12, 5))
    filled = zero_fill(purchases_daily(lines), spine, ["revenue", "orders"]).orderBy("date").collect()
    assert [float(r.revenue) for r in filled] == [0, 34.3, 0, 0, 7, 0]
    assert tuple(date_span(spine).first()) == (date(2020, 11, 30), date(2020, 12, 5))
    with pytest.raises(RuntimeError):
        span_of(spine.where("false"))


def test_dense_series_fills_both_ends_for_every_key(spark, lines):
    series = dense_series(attribution_daily(lines), ["revenue", "orders"],
                          date(2020, 11, 30), date(2020, 12, 5), ["source"])
    rows = {(r.source, r.date.isoformat()): (float(r.revenue), r.orders) for r in series.collect()}
    assert len(rows) == 12
    assert rows["google", "2020-12-04"] == (7.0, 1)
    assert rows[None, "2020-12-01"] == (10.0, 1)
    assert sum(v[0] for v in rows.values()) == 41.3


def test_reconciliation(spark):
    staged_raw = standardise(flat(spark, flat_row(), flat_row(), flat_row(price=11.0)))
    mart = purchases_daily(purchase_lines(stage_events(flat(spark, flat_row(), flat_row()))))
    row = reconcile(mart, strict_revenue(staged_raw), 0.01).first()
    assert tuple(row) == (20.0, 42.0, -22.0, False)
    assert reconcile(mart, mart, 0.0).first().within_tolerance


def test_labels(spark):
    df = spark.createDataFrame([("redacted",), ("google",), (None,)], "source string")
    labels = {r.source: r.source_label for r in shorten_labels(df, {"redacted": "Private"}).collect()}
    assert labels == {"redacted": "Private", "google": "google", None: None}


def test_dealt_events_are_staged_without_another_shuffle(spark):
    """Rows of items used to be shuffled once more, each with its key and all columns."""
    item = [("h", "Hat", "Wear", 10.0, 2), ("m", "Mug", "Home", None, 1), ("|x", "X", "X", 3.0, 1)]

    def event(at, name="Purchase", user="u1", session=7, items=item, source="google"):
        params = None if session is None else [("ga_session_id", (None, session))]
        return ("20201201", at, name, user, ("NL", "UT"), ("mobile",), (source, "cpc", "sale"), params, items)

    rows = [event(1), event(1), event(1, name="PURCHASE", source="bing"), event(2), event(None), event(None),
            event(1, user="a|5", session=None, items=[("x", "Hat", "Wear", 9.0, 2)]),
            event(1, user="a", session=5), event(1, user=None, session=None), event(1, user="", session=None),
            event(3, name="a|b", user="c"), event(3, name="a", user="b|c"), event(4, items=None), event(5, items=[])]
    raw = spark.createDataFrame(rows, RAW_EVENT).repartition(3)
    for names in (None, ["purchase"]):
        plain = stage_events(flatten_events(raw), names)
        dealt = stage_events(flatten_events(raw, deal_by=[EVENT_HASH]), names)
        assert dealt.schema == plain.schema
        assert sorted(map(str, dealt.collect())) == sorted(map(str, plain.collect()))
        plan = dealt._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
        assert plan[:plan.index("explode(items")].count("Exchange") == 0
    by_line = flatten_events(raw, deal_by=["event_dt", "user_pseudo_id", "ga_session_id"])
    assert by_line.schema == flatten_events(raw).schema
    assert strict_revenue(standardise(by_line)).collect() \
        == strict_revenue(standardise(flatten_events(raw))).collect()
