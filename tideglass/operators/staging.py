"""Flat events to the staging layer: types, cleaning, row key, de-duplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tideglass.functions.keys import EVENT_HASH, row_key
from tideglass.functions.scalars import blank_to_null
from tideglass.schemas import CHANNEL, FLAT_EVENT, STAGED_EVENT


def standardise(flat: DataFrame) -> DataFrame:
    """The eighteen columns with their types, lower-case event names, blank channel parts NULL; and
    EVENT_HASH, if the flat table has it."""
    cleaned = {"event_name": F.lower("event_name")}
    cleaned |= {c: blank_to_null(F.col(c)) for c in CHANNEL}
    typed = {
        f.name: cleaned.get(f.name, F.col(f.name)).cast(f.dataType) for f in FLAT_EVENT.fields
    }
    typed["event_ts"] = typed.pop("event_timestamp")
    return flat.select(*[
        typed[name].alias(name) for name in STAGED_EVENT.fieldNames() if name != "row_key"
    ], *[c for c in flat.columns if c == EVENT_HASH])


def with_row_key(staged: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Adds ``row_key``; the columns it is made of are a parameter."""
    key = row_key(staged) if columns is None else row_key(staged, tuple(columns))
    return staged.withColumn("row_key", key)


def dedup(df: DataFrame, key: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row per ``key`` in ``order``.

    The rank filter is planned as a per-key limit on both sides of the exchange, so each task
    sends at most one row per key: a key with very many copies does not load one task.
    """
    first = Window.partitionBy(*key).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(first)).where("_rank = 1").drop("_rank")


def newest_first(df: DataFrame) -> list[Column]:
    """``event_ts`` descending, then every other column. The timestamp is part of the row key,
    so by itself it leaves all copies tied; the other columns make the survivor reproducible."""
    rest = [c for c in df.columns if c not in ("event_ts", "row_key", EVENT_HASH)]
    return [F.desc_nulls_last("event_ts"), *[F.asc_nulls_last(c) for c in rest]]


def stage_events(flat: DataFrame, event_names: Sequence[str] | None = None) -> DataFrame:
    """The staging layer: one row per row key.

    ``event_names`` (lower case) restricts it to some kinds of event. The name is part of the row
    key, so copies share it and the restriction may come first: only those events are sorted and
    shuffled, and the filter moves on below the flattening.

    A flat table dealt by EVENT_HASH is not shuffled again: rows of a row key share the hash. Copies
    of one event are then in one task from the dealing on, and none is left out before it.
    """
    typed = standardise(flat)
    if event_names is not None:
        typed = typed.where(F.col("event_name").isin(*event_names))
    keyed = with_row_key(typed)
    key = [c for c in (EVENT_HASH, "row_key") if c in keyed.columns]
    return dedup(keyed, key, newest_first(keyed)).select(*STAGED_EVENT.fieldNames())
