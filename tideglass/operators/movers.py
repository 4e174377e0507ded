"""Channel movers: score the change of each channel between two windows, keep the top (J3, A4,
A5, K4, K5, F4, F5, W2, W7, T1, P8, P9).

One operator serves both presets. Current and previous sums come from one aggregate over the
facts, not from two scans and a full join.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tideglass.config import MoverRules
from tideglass.functions.scalars import ratio
from tideglass.operators.periods import Window
from tideglass.operators.ranking import rank_rows
from tideglass.operators.windows import LABELS, sums_for_anchors, sums_for_windows
from tideglass.schemas import CHANNEL, MOVER

NONE_LABEL = "(none)"


def _per_channel(sums: DataFrame, rules: MoverRules) -> DataFrame:
    """Channels that have facts in either window.

    With ``null_safe`` a channel is one row. Without, a channel with a NULL part is two rows, one
    for each window, because NULL equals nothing: that is what joining the two windows on the
    channel parts gives.
    """
    cur, prev = F.col("revenue_cur"), F.col("revenue_prev")
    in_cur, in_prev = F.col("n_cur") > 0, F.col("n_prev") > 0
    pair = F.struct(cur.alias("cur"), prev.alias("prev"))
    if rules.null_safe:
        pairs = F.array(pair)
    else:
        nothing = F.lit(0).cast(sums.schema["revenue_cur"].dataType)
        split = F.array(
            F.when(in_cur, F.struct(cur.alias("cur"), nothing.alias("prev"))),
            F.when(in_prev, F.struct(nothing.alias("cur"), prev.alias("prev"))),
        )
        any_null = F.col(CHANNEL[0]).isNull()
        for part in CHANNEL[1:]:
            any_null = any_null | F.col(part).isNull()
        pairs = F.when(any_null, F.filter(split, lambda p: p.isNotNull())) \
            .otherwise(F.array(pair))
    return sums.where(in_cur | in_prev).withColumn("p", F.explode(pairs)).select(
        *LABELS, *CHANNEL, F.col("p.cur").alias("_cur"), F.col("p.prev").alias("_prev")
    )


def score(sums: DataFrame, rules: MoverRules) -> DataFrame:
    """Change, rate of change and impact score per channel and window; rows under the smallest
    current revenue are dropped."""
    cur, prev = F.col("_cur").cast("double"), F.col("_prev").cast("double")
    delta = (F.col("_cur") - F.col("_prev")).cast("double")
    rate = F.abs(ratio(delta, prev))
    if rules.missing_rate is not None:
        rate = F.coalesce(rate, F.lit(float(rules.missing_rate)))
    scored = _per_channel(sums, rules).select(
        *LABELS, *CHANNEL,
        cur.alias("revenue_cur"), prev.alias("revenue_prev"),
        delta.alias("delta_abs"), ratio(delta, prev).alias("delta_pct"),
        (F.abs(delta) * F.lit(rules.size_weight) + rate * F.lit(rules.rate_weight))
        .alias("impact_score"),
    )
    if rules.min_revenue is not None:
        scored = scored.where(F.col("revenue_cur") >= F.lit(float(rules.min_revenue)))
    return scored


def impact_order() -> list[Column]:
    """Highest score first, rows without a score last; ties by size, then by channel name."""
    return [
        F.desc_nulls_last("impact_score"), F.desc_nulls_last("revenue_cur"),
        F.desc_nulls_last("revenue_prev"),
        *[F.asc_nulls_last(c) for c in CHANNEL],
    ]


def top(scored: DataFrame, k: int) -> DataFrame:
    """The ``k`` first rows of each window with their rank. The rank filter is planned as a limit
    per window before the exchange, so each task sends at most ``k`` rows of a window."""
    ranked = W.partitionBy("insight_date", "insight_type", "window_start", "window_end") \
        .orderBy(*impact_order())
    return scored.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k)


def movers(attribution: DataFrame, windows: Sequence[Window], rules: MoverRules) -> DataFrame:
    """Ranked movers of a handful of windows, in one scan."""
    sums = sums_for_windows(attribution, windows, ["revenue"], CHANNEL)
    return top(score(sums, rules), rules.top_k)


def mover_history(
    attribution: DataFrame, first: date, last: date, min_date: date, month: str, rules: MoverRules
) -> DataFrame:
    """Ranked movers of all four windows of every anchor, in one pass over the channel series."""
    sums = sums_for_anchors(attribution, first, last, min_date, month, ["revenue"], CHANNEL)
    return top(score(sums, rules), rules.top_k)


def rank_movers(scored: DataFrame, k: int | None = None) -> DataFrame:
    """Competition rank by impact within a window, of all channels or up to rank ``k``: equal
    scores share a rank, and all rows of a shared rank are listed. The channels of one window are
    ranked by many tasks. Windows of one date without a period are told apart by their bounds."""
    ranked = rank_rows(scored, list(LABELS), "impact_score", "impact_rank", spread=CHANNEL)
    return ranked if k is None else ranked.where(F.col("impact_rank") <= k)


def mover_struct() -> Column:
    """A mover as it is stored: no NULL or blank channel part, no NULL amount or score; a missing
    rate of change stays NULL."""
    def named(part: str) -> Column:
        return F.coalesce(F.nullif(F.col(part), F.lit("")), F.lit(NONE_LABEL)).alias(part)

    def amount(name: str) -> Column:
        return F.coalesce(name, F.lit(0.0)).alias(name)

    cells = {c: named(c) for c in CHANNEL}
    cells |= {c: amount(c) for c in ("revenue_cur", "revenue_prev", "impact_score")}
    return F.struct(*[cells.get(f.name, F.col(f.name)) for f in MOVER.fields])


def collect_movers(ranked: DataFrame) -> DataFrame:
    """One row per window with its movers in rank order. ``top`` has left at most ``k`` of them."""
    by_rank = F.sort_array(F.collect_list(F.struct("rank", mover_struct().alias("m"))))
    return ranked.groupBy("insight_date", "insight_type", "window_start", "window_end").agg(
        F.transform(by_rank, lambda r: r["m"]).alias("top_movers")
    )
