import zlib

import numpy as np

from tests.llm.helpers import AWKWARD, docs
from tideglass.llm import langid, texts
from tideglass.llm.langid import cut_windows, identify


def spell(rng, syllables, n):
    return " ".join("".join(rng.choice(syllables, rng.integers(1, 4))) for _ in range(n))


SYLLABLES = {"xx": ["ka", "to", "mi", "re"], "yy": ["sch", "ung", "ein", "ö"],
             "zz": ["ção", "ñ", "ez", "ll"]}


def corpus(n=240):
    rng = np.random.default_rng(2)
    names = list(SYLLABLES)
    return [(i, spell(rng, SYLLABLES[names[i % 3]], int(rng.integers(3, 200))), names[i % 3], "s")
            for i in range(n)]


def test_held_out_accuracy_and_fields(spark):
    rows = corpus()
    got = {r.doc_id: r for r in identify(docs(spark, rows)).collect()}
    assert len(got) == len(rows)
    right = 0
    for i, _, lang, _ in rows:
        assert got[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2)
        assert 0 <= got[i].score <= 1
        right += got[i].held_out and got[i].lang_pred == lang
    assert right >= 0.95 * sum(r.held_out for r in got.values())


def test_held_out_labels_and_ids_do_not_matter(spark):
    """Wrong labels on held-out documents change nothing."""
    rows = corpus()
    wrong = [(i, t, "xx" if zlib.crc32(str(i).encode()) % 4 == 2 else lang, s)
             for i, t, lang, s in rows]
    assert sorted(identify(docs(spark, rows)).collect()) \
        == sorted(identify(docs(spark, wrong)).collect())


def test_awkward_rows(spark):
    rows = AWKWARD + [(50, "123 456 ... !!", "xx", "s"), (51, "→ … €", "xx", "s")] + \
        [(1000 + r[0], *r[1:]) for r in corpus(60)]
    got = identify(docs(spark, rows)).collect()
    assert len(got) == len(rows)
    by_id = {r.doc_id: r for r in got}
    for i in (1, 2, 6, 50, 51):
        assert (by_id[i].lang_pred, by_id[i].score) == ("und", 0.0)
    assert by_id[None].held_out is False
    assert by_id[9].lang_pred != "und"


def test_without_labels_or_rows(spark):
    assert identify(docs(spark, [])).count() == 0
    assert [r.lang_pred for r in identify(docs(spark, [(1, "text", None)])).collect()] == ["und"]


def test_tables_give_what_the_filters_give():
    """Looking sums up by byte pairs is the convolution that was trained."""
    rng = np.random.default_rng(0)
    windows = rng.integers(0, 256, (5, langid.WINDOW)).astype(np.uint8)
    p = {"emb": rng.normal(size=(256, langid.EMBEDDING)), "bias": rng.normal(size=48),
         "out": rng.normal(size=(48, 2)), "out_bias": np.zeros(2)}
    p |= {f"w{w}": rng.normal(size=(w * langid.EMBEDDING, langid.FILTERS)) for w in langid.WIDTHS}
    want = np.maximum(np.concatenate([
        (langid._columns(p["emb"][windows], w) @ p[f"w{w}"]).max(axis=1) for w in langid.WIDTHS
    ], axis=1) + p["bias"], 0)
    assert np.allclose(langid._tables(p, ["a", "b"]).pooled(windows), want)


def test_windows_cover_every_byte():
    import pyarrow as pa
    column = pa.array(["a" * 1000, None, "", "é" * 128 + "b", "c" * 256])
    data, bounds = texts.utf8(column)
    windows, length, owner = cut_windows(data, bounds)
    assert owner.tolist() == [0] * 4 + [3] * 2 + [4]
    assert b"".join(w[:n].tobytes() for w, n in zip(windows, length)) == data.tobytes()
