"""Row and channel keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tideglass.functions.scalars import ntz_text
from tideglass.schemas import CHANNEL

EVENT_HASH = "event_hash"
ROW_KEY_COLUMNS = ("event_ts", "event_name", "user_pseudo_id", "ga_session_id", "item_id")


def fingerprint(*parts: Column) -> Column:
    """md5 of the parts as text, joined with a pipe; NULL counts as ''.

    ``concat_ws`` skips NULLs, so each part is coalesced first. NULL and '' give the same key,
    and so do two rows whose parts differ only in where a pipe stands: stored keys rely on it.
    """
    return F.md5(F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]))


def row_key(df: DataFrame, columns: tuple[str, ...] = ROW_KEY_COLUMNS) -> Column:
    """Fingerprint over ``columns`` of ``df``; timestamps enter with six decimals."""
    kinds = dict(df.dtypes)
    return fingerprint(*[
        ntz_text(F.col(c)) if kinds[c].startswith("timestamp") else F.col(c) for c in columns
    ])


def event_hash(df: DataFrame, ts: str = "event_ts") -> Column:
    """A 64-bit hash that rows of one row key share and that needs no item: of the first four of
    the key's parts as they stand between its pipes, so that it follows from the key even where a
    pipe inside a part merges two keys."""
    parts = [ntz_text(F.col(ts)), F.lower("event_name"), F.col("user_pseudo_id"), F.col("ga_session_id")]
    text = F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts], F.lit(""))
    return F.xxhash64(F.substring_index(text, "|", len(parts)))


def channel_key() -> Column:
    """Key of (source, medium, campaign) that keeps NULL, '' and shifted parts apart, so that an
    ordinary equi-join on it is null-safe."""
    def marked(part: Column) -> Column:
        return F.coalesce(
            F.concat(F.length(part).cast("string"), F.lit(":"), part), F.lit("-")
        )

    return F.md5(F.concat_ws("|", *[marked(F.col(c)) for c in CHANNEL]))
