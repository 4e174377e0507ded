"""Small tables with the awkward rows that every operator must bear."""

from pyspark.sql import types as T

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()),
    # names that operators use inside, of other types
    T.StructField("size", T.StringType()), T.StructField("hash", T.BinaryType()),
    T.StructField("word", T.IntegerType()), T.StructField("part", T.StringType()),
])


def docs(spark, rows):
    """Documents from (doc_id, text[, lang[, source]]), with extra columns of clashing names."""
    full = []
    for r in rows:
        r = (*r, *[None] * (4 - len(r)))
        full.append((*r, len(r[1] or ""), "x", b"y", 3, "z"))
    return spark.createDataFrame(full, DOCS)


AWKWARD = [
    (1, None, "en", "a"), (2, "", "en", None), (3, "one", None, "a"), (None, "no id here", None, None),
    (4, "same words again " * 30, "en", "a"), (5, "same words again " * 30, "en", "a"),
    (5, "same words again " * 30, "en", "a"), (6, "\t\n \x0b\f\r", "fr", "b"),
    (7, "é" * 10 + " \U0001f600 ß x\n\né", "de", "b"),
    (8, " ".join(f"w{i}" for i in range(40_000)), "en", "b"), (9, "x" * 1_500_000, "en", "b"),
]
