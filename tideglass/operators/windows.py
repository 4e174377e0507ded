"""Sums of daily facts over insight windows, current and previous side by side.

Two ways to the same rows:

* ``sums_for_windows``: a handful of windows known as dates. One scan, one aggregate with a
  conditional sum per window.
* ``sums_for_anchors``: every anchor of a span, four windows each. A join of facts to windows by
  date range would meet each fact with every Total window after it, so its cost grows with the
  square of the calendar. Here each key gets one running total over its days, and any window sum
  is the difference of two of its values.

The expressions are SQL text: there are dozens of like ones per query, and a text is parsed in one
call where the same tree of Column objects takes hundreds.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, functions as F

from tideglass.operators.marts import daily_totals, spread_by
from tideglass.operators.periods import PERIODS, Window, bounds
from tideglass.schemas import MONEY_TOTAL

LABELS = (
    "insight_date", "insight_type", "window_start", "window_end", "prev_start", "prev_end",
)


def _exact(facts: DataFrame, measure: str) -> str:
    """Money given as DOUBLE is added as DECIMAL; counts and decimals are exact as they are."""
    kind = facts.schema[measure].dataType.typeName()
    return f"cast({measure} as {MONEY_TOTAL.simpleString()})" if kind in ("double", "float") \
        else measure


def _day(value: date) -> str:
    return f"date'{value}'"


def _both(measures: Sequence[str]) -> list[str]:
    return [f"{m}_{side}" for m in measures for side in ("cur", "prev")]


def sums_for_windows(
    facts: DataFrame, windows: Sequence[Window], measures: Sequence[str], keys: Sequence[str] = ()
) -> DataFrame:
    """Per key and window ``<measure>_cur``, ``<measure>_prev`` and the row counts ``n_cur``,
    ``n_prev``. Without keys every window has a row, also one that no fact falls into."""
    first = min(w.prev_start for w in windows)
    last = max(w.window_end for w in windows)
    values = {m: _exact(facts, m) for m in measures} | {"n": "1L"}
    aggregates, rows = [], []
    for i, w in enumerate(windows):
        sides = {"cur": (w.window_start, w.window_end), "prev": (w.prev_start, w.prev_end)}
        aggregates += [
            f"coalesce(sum(case when date between {_day(start)} and {_day(end)} then {value} end), 0)"
            f" as {m}_{side}_{i}"
            for m, value in values.items() for side, (start, end) in sides.items()
        ]
        kind = "cast(null as string)" if w.insight_type is None else f"'{w.insight_type}'"
        labels = [kind if c == "insight_type" else _day(getattr(w, c)) for c in LABELS]
        cells = [f"{label} as {c}" for c, label in zip(LABELS, labels)] \
            + [f"{c}_{i} as {c}" for c in _both(values)]
        rows.append(f"struct({', '.join(cells)})")
    # The span of all windows reaches the scan; the conditions inside the sums would not.
    sums = facts.where(f"date between {_day(first)} and {_day(last)}").groupBy(*keys).agg(
        *[F.expr(a) for a in aggregates]
    )
    return sums.select(*keys, F.expr(f"explode(array({', '.join(rows)})) as r")) \
        .select(*keys, "r.*")


def sums_for_anchors(
    facts: DataFrame,
    first: date,
    last: date,
    min_date: date,
    month: str,
    measures: Sequence[str],
    keys: Sequence[str] = (),
) -> DataFrame:
    """The columns of ``sums_for_windows`` for the four windows of every date ``first``..``last``.

    A key has a row for each window that one of its facts falls into, now or in the window
    before; without keys every anchor has its four rows.
    """
    names, start = [*measures, "n"], _day(min_date)
    exact = facts.where(f"date <= {_day(last)}").selectExpr(
        "date", *keys, *[f"{_exact(facts, m)} as {m}" for m in measures], "1L as n"
    )
    if not keys:
        # A row without value on the first anchor lets the series reach every anchor.
        kinds = exact.schema
        exact = exact.unionByName(exact.sparkSession.range(1).selectExpr(
            f"{_day(first)} as date",
            *[f"cast(0 as {kinds[m].dataType.simpleString()}) as {m}" for m in names],
        ))
    daily = spread_by(daily_totals(exact, names, keys), keys)
    kind = {m: daily.schema[m].dataType.simpleString() for m in names}

    # The Total window starts at min_date; its previous window reaches as far back as the anchor
    # lies ahead. A fact d days before min_date therefore enters it d - 1 days after min_date:
    # such a fact is placed a second time, mirrored at min_date, for that running total only.
    roles = ("all", "total", "before")
    own, mirrored = [], []
    for m in names:
        zero = f"cast(0 as {kind[m]})"
        own += [f"{m} as {m}_all", f"if(date >= {start}, {m}, {zero}) as {m}_total",
                f"{zero} as {m}_before"]
        mirrored += [f"{zero} as {m}_all", f"{zero} as {m}_total", f"{m} as {m}_before"]
    placed = f"struct(date as day, {', '.join(own)})"
    placed_again = (
        f"struct(date_add({start}, datediff({start}, date) - 1) as day, {', '.join(mirrored)})"
    )
    points = daily.select(*keys, F.expr(
        f"explode(if(date < {start}, array({placed}, {placed_again}), array({placed}))) as p"
    )).select(*keys, "p.*").where(f"day <= {_day(last)}")

    # Running totals per key, then one row per day: each row stands until the next one, and of
    # several rows of one day the last. Days more than the longest look-back before the first
    # anchor are not spelled out.
    back = {"rolling30": (30,), "calendar": (28, 29, 30, 31)}[month]
    by_day = f"{'partition by ' + ', '.join(keys) if keys else ''} order by day"
    running = points.selectExpr(
        *keys, "day",
        *[f"sum({m}_{role}) over ({by_day} rows unbounded preceding) as {m}_{role}"
          for m in names for role in roles],
        f"coalesce(date_sub(lead(day) over ({by_day}), 1), {_day(last)}) as until",
    )
    reach_from = f"greatest(day, date_sub({_day(first)}, {2 * max(back)}))"
    dense = running.where(f"until >= {reach_from}").withColumn(
        "day", F.expr(f"explode(sequence({reach_from}, until))")
    )

    # On the dense series a running total k days ago is a lag by k rows.
    offsets = sorted({1, 2, 7, 14} | set(back) | {2 * b for b in back})
    looked = dense.selectExpr(
        *keys, "day", *[f"{m}_{role}" for m in names for role in roles],
        *[f"coalesce(lag({m}_all, {k}) over ({by_day}), 0) as {m}_ago_{k}"
          for m in names for k in offsets],
    ).where(f"day >= {_day(first)}")

    def sides(m: str, period: str) -> tuple[str, str]:
        """Current and previous sum of measure ``m``."""
        if period == "Total":
            return f"{m}_total", f"{m}_before"
        if period == "Month" and month == "calendar":
            one, two = (
                "case datediff(day, add_months(day, -1)) "
                + " ".join(f"when {b} then {m}_ago_{times * b}" for b in back) + " end"
                for times in (1, 2)
            )
        else:
            days = {"Day": 1, "Week": 7, "Month": 30}[period]
            one, two = f"{m}_ago_{days}", f"{m}_ago_{2 * days}"
        return f"{m}_all - {one}", f"{one} - {two}"

    # One type for all four periods: a difference of decimals is a digit wider.
    total_kind = {m: running.schema[f"{m}_all"].dataType.simpleString() for m in names}

    def row(period: str):
        made = F.struct(
            F.lit(period).alias("insight_type"),
            bounds(F.col("day"), period, min_date, month).alias("w"),
            *[F.expr(f"cast({value} as {total_kind[m]}) as {m}_{side}")
              for m in names for side, value in zip(("cur", "prev"), sides(m, period))],
        )
        # Most channels rest in most short windows: such rows are not even built.
        in_either = " + ".join(f"({value})" for value in sides("n", period))
        return F.when(F.expr(f"{in_either} > 0"), made) if keys else made

    rows = looked.select(
        *keys, F.col("day").alias("insight_date"),
        F.explode(F.array(*[row(p) for p in PERIODS])).alias("r"),
    ).where("r is not null")
    return rows.select(
        *keys, "insight_date", "r.insight_type", "r.w.*", *[f"r.{c}" for c in _both(names)]
    )
