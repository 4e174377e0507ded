"""Quality rules with thresholds from mergeable quantile sketches (operator 3).

1. One pass over the texts gives a slim row of counts a document, which is staged.
2. Per language and source, and for each metric, the values are counted in logarithmic buckets
   (relative error ``ALPHA``). Such sketches merge by adding counts, so that they are built by
   one partial aggregation, and a language's or the whole corpus' sketch is the sum of its parts.
3. From the quartiles come fences, ``SPREAD`` times the quartile distance outside, which take the
   place of fixed cutoffs. Where the quartiles coincide, as for a ratio that most documents have
   at 0, the width is the distance to the group's outer percentile instead, and at most a bound a
   metric: what is rare in a group is out, what one document in a hundred has is its habit. The
   bound is for junk of more than a hundredth, whose own value would else be the width. The slim
   rows are joined with the fences and judged.

A junk share of up to a quarter of a group does not move its quartiles to the junk's side, and no
fixed share is cut. The sketches are of the documents that pass the base rules.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tideglass.llm import texts
from tideglass.sources.workspace import stage

WINDOW = 8
SYMBOLS = b"#*$%&|<>"
ALPHA = 0.01
GAMMA = (1 + ALPHA) / (1 - ALPHA)
SMALLEST = 1e-4          # smaller values share the bucket of zero
ZERO_BUCKET = -100_000
SPREAD = 3.0
GROUP_ROWS = 100         # smaller groups are judged by their language, or else by the corpus
#: Per metric: numerator, denominator, most of a width where the quartiles coincide (with
#: ``floors`` the least of any width), whether low values fail too.
METRICS = {
    "symbols": ("n_symbols", "n_words", 0.05, False),
    "dup_lines": ("n_dup_lines", "n_lines", 0.2, False),
    "repeats": ("n_repeat_words", "n_words", 0.1, False),
    "word_length": ("word_chars", "n_words", 0.75, True),
}
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")

_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[list(SYMBOLS)] = True


def _per_text(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.zeros(len(flags) + 1, dtype=np.int64)
    np.cumsum(flags, out=total[1:])
    return total[bounds[1:]] - total[bounds[:-1]]


def _repeated(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Words of each text that lie in a run of WINDOW words which the text has twice or more."""
    runs = texts.window_hashes(hashes, WINDOW)
    at = np.flatnonzero(texts.windows_inside(bounds, WINDOW)) if len(runs) else runs.astype(int)
    owner = np.searchsorted(bounds, at, "right").astype(np.uint64)
    key = texts.mix(runs[at] + texts.mix(owner))
    _, which, count = np.unique(key, return_inverse=True, return_counts=True)
    twice = at[count[which] > 1]
    cover = np.zeros(len(hashes) + 1, dtype=np.int64)
    cover[twice] += 1
    cover[twice + WINDOW] -= 1  # in bounds: a run ends within its text; starts are distinct
    return _per_text(np.cumsum(cover[:-1]) > 0, bounds)


def _lines(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lines with a word of each text, and how many of them equal an earlier one."""
    raw, n, dup = data.tobytes(), [], []
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        lines = [x for x in raw[a:b].split(b"\n") if x.strip()]
        n.append(len(lines))
        dup.append(len(lines) - len(set(lines)))
    return np.array(n, dtype=np.int64), np.array(dup, dtype=np.int64)


def count_text(column: pa.Array) -> dict[str, np.ndarray]:
    """The counts of every text of an Arrow column; NULL and empty texts count 0 everywhere."""
    data, bounds = texts.utf8(column)
    hashes, word_bounds = texts.words(data, bounds)
    n_lines, n_dup = _lines(data, bounds)
    letter = ~texts._SPACE[data] & ((data & 0xC0) != 0x80)  # first bytes of code points in words
    return {
        "n_words": np.diff(word_bounds), "word_chars": _per_text(letter, bounds),
        "n_symbols": _per_text(_SYMBOL[data], bounds), "n_dup_lines": n_dup,
        "n_repeat_words": _repeated(hashes, word_bounds), "n_lines": n_lines,
    }


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in texts.slices(batches, 3):
        counts = count_text(part.column(3))
        yield pa.RecordBatch.from_arrays(
            [*(part.column(i) for i in range(3)),
             *(pa.array(counts[c], pa.int64()) for c in COUNTS)],
            ["doc_id", "lang", "source", *COUNTS])


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """One slim row a document: doc_id, lang, source, the COUNTS and ``base_failed``."""
    slim = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(lang_col).cast("string").alias("lang"),
        F.col(source_col).cast("string").alias("source"), F.col(text_col).alias("text"))
    schema = "doc_id long, lang string, source string, " + ", ".join(f"{c} long" for c in COUNTS)
    return slim.mapInArrow(_count_batches, schema).withColumn(
        "base_failed", (F.col("n_words") < 20)
        | (100 * F.col("n_repeat_words") > 30 * F.col("n_words")))


def metric(name: str) -> Column:
    over, under, _, _ = METRICS[name]
    return F.when(F.col(under) > 0, F.col(over) / F.col(under)).otherwise(0.0)


def bucket(value: Column) -> Column:
    return F.when(value <= SMALLEST, ZERO_BUCKET).otherwise(
        F.ceil(F.log(value) / F.log(F.lit(GAMMA)))).cast("long")


def sketch(measured: DataFrame) -> DataFrame:
    """(lang, source, metric, bucket, n) of the documents that pass the base rules."""
    values = F.explode(F.array(*[
        F.struct(F.lit(m).alias("metric"), bucket(metric(m)).alias("bucket")) for m in METRICS]))
    return (
        measured.where(~F.col("base_failed")).select("lang", "source", values.alias("v"))
        .groupBy("lang", "source", "v.metric", "v.bucket").agg(F.count("*").alias("n"))
    )


def fences(sketches: DataFrame, keys: list[str], floors: bool = False) -> DataFrame:
    """Merges the sketches by ``keys``; a row for each: rows, and low and high of each metric."""
    merged = sketches.groupBy(*keys, "metric", "bucket").agg(F.sum("n").alias("n"))
    group = Window.partitionBy(*keys, "metric")
    value = F.when(F.col("bucket") == ZERO_BUCKET, 0.0).otherwise(
        2 * F.pow(F.lit(GAMMA), F.col("bucket")) / (F.lit(GAMMA) + 1))
    ranked = merged.withColumn("upto", F.sum("n").over(group.orderBy("bucket"))) \
        .withColumn("rows", F.sum("n").over(group)).withColumn("value", value)

    def first(reached: Column) -> Column:
        return F.min(F.when(reached, F.col("value")))

    upto, rows = F.col("upto"), F.col("rows")
    quartiles = ranked.groupBy(*keys, "metric").agg(
        F.max("rows").alias("rows"), first(upto >= 0.25 * rows).alias("q1"),
        first(upto >= 0.75 * rows).alias("q3"), first(100 * upto > rows).alias("p1"),
        first(100 * upto >= 99 * rows).alias("p99"))
    bound = F.element_at(
        F.create_map(*[x for m, v in METRICS.items() for x in (F.lit(m), F.lit(v[2]))]),
        F.col("metric"))
    apart, error = F.col("q3") - F.col("q1"), F.lit(2 * ALPHA) * F.col("q3")

    def wide(tail: Column) -> Column:
        width = F.greatest(apart, bound) if floors else F.when(apart > error, apart).otherwise(
            F.greatest(error, F.least(bound, tail)))
        return F.lit(SPREAD) * width

    return quartiles.withColumn("low", F.col("q1") - wide(F.col("q1") - F.col("p1"))).withColumn(
        "high", F.col("q3") + wide(F.col("p99") - F.col("q3"))
    ).groupBy(*keys).agg(
        F.max("rows").alias("rows"),
        *[F.max(F.when(F.col("metric") == m, F.col(c))).alias(f"{m}_{c}")
          for m in METRICS for c in ("low", "high")])


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  lang_col: str = "lang", source_col: str = "source",
                  floors: bool = False) -> DataFrame:
    """Counts and verdict of every document: doc_id, COUNTS, ``base_failed``, ``kept``.

    ``kept`` is false for base failures and for documents with a metric outside the fences of
    their language and source. A group of fewer than GROUP_ROWS sketched rows takes the fences of
    its language, a small language those of the corpus. NULL language or source is a value like
    any other. NULL and empty texts have no words and fail the base rule. Repeated rows are judged
    and returned each. An empty table gives no rows. Other columns of ``docs`` play no part.
    ``floors`` gives the older verdicts, whose widths have a constant floor a metric.
    """
    measured = stage(measure(docs, id_col, text_col, lang_col, source_col), "quality")
    sketches = stage(sketch(measured), "quality-sketch")

    limits = [f"{m}_{c}" for m in METRICS for c in ("low", "high")]
    by_source = fences(sketches, ["lang", "source"], floors)
    by_lang = fences(sketches, ["lang"], floors)
    overall = fences(sketches, [], floors)

    def renamed(df: DataFrame, tag: str) -> DataFrame:
        return df.select(*[F.col(c).alias(f"{tag}_{c}") for c in df.columns])

    chosen = (
        renamed(by_source, "s")
        .join(renamed(by_lang, "l"), F.col("s_lang").eqNullSafe(F.col("l_lang")))
        .join(renamed(overall, "a"), F.lit(True))  # one row: the fences of the whole corpus
        .select("s_lang", "s_source", *[
            F.when(F.col("s_rows") >= GROUP_ROWS, F.col(f"s_{c}"))
            .when(F.col("l_rows") >= GROUP_ROWS, F.col(f"l_{c}"))
            .otherwise(F.col(f"a_{c}")).alias(c) for c in limits])
    )
    inside = F.lit(True)
    for m, (_, _, _, low_too) in METRICS.items():
        inside = inside & (metric(m) <= F.col(f"{m}_high"))
        if low_too:
            inside = inside & (metric(m) >= F.col(f"{m}_low"))
    return (
        measured.join(
            stage(chosen, "quality-fences"),
            F.col("lang").eqNullSafe(F.col("s_lang"))
            & F.col("source").eqNullSafe(F.col("s_source")), "left")
        .withColumn("kept", ~F.col("base_failed") & F.coalesce(inside, F.lit(False)))
        .select("doc_id", *COUNTS, "base_failed", "kept")
    )
