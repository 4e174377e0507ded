import gc
import weakref

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken

from tests.llm.helpers import AWKWARD, docs
from tests.llm.test_tokenfiles import ODD
from tideglass.llm import bpe, chunks

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def reference():
    with open(RANKS, "rb") as f:
        return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, special_tokens={},
                                 mergeable_ranks=bpe.read_ranks(f.read()))


def test_ids_and_round_trip(spark, tmp_path, monkeypatch, reference):
    monkeypatch.setattr(bpe, "CHUNK_BYTES", 20_000)
    rows = AWKWARD + ODD + [(200 + i, f"mot{i} été " * (i % 60), "fr", "s") for i in range(300)]
    folder = str(tmp_path / "docs")
    docs(spark, rows).drop("hash").repartition(3).write.parquet(folder)
    encoded = bpe.encode(spark.read.parquet(folder), RANKS, public_tokenizers.PATTERN, parts=7)
    got = bpe.decode(encoded, RANKS).collect()
    assert sorted((r.doc_id or -1, bytes(r.decoded).decode()) for r in got) \
        == sorted((r[0] or -1, r[1] or "") for r in rows)
    for r in got:
        ids = np.frombuffer(bytes(r.ids), "<u4").tolist()
        assert ids == reference.encode_ordinary(bytes(r.decoded).decode())


def test_a_table_that_changes_between_readings_is_an_error():
    words = bpe._Words(public_tokenizers.PATTERN)
    words.add([1, 2], pa.array(["a b", "c"]))
    other = bpe._Words(public_tokenizers.PATTERN)
    other.add([2, 1], pa.array(["c", "a b"]))
    chunk = bpe._Reassembly(words.rows(0, 3, False).to_pylist()[0])
    with pytest.raises(ValueError):
        chunk.take(other.rows(0, 3, True).to_pylist()[0])
    with pytest.raises(ValueError):
        list(chunk.documents())


def test_a_chunk_is_freed_without_the_garbage_collector():
    gc.disable()
    try:
        words = bpe._Words(public_tokenizers.PATTERN)
        words.add([1], pa.array(["a b"]))
        assert words.rows(0, 3, True).num_rows
        gone = weakref.ref(words)
        del words
        assert gone() is None
    finally:
        gc.enable()


def test_decoding_by_the_token_table(spark, reference):
    ids = reference.encode_ordinary("naïve \u00a0 text\n\n") * 3
    given = spark.createDataFrame(
        [(1, np.array(ids, "<u4").tobytes()), (2, b""), (None, None), (2, b"\x05\0\0\0")],
        "doc_id long, ids binary")
    got = {(r.doc_id, r.ids): bytes(r.decoded) for r in bpe.decode(given, RANKS).collect()}
    assert got == {(1, np.array(ids, "<u4").tobytes()): reference.decode_bytes(ids), (2, b""): b"",
                   (None, None): b"", (2, b"\x05\0\0\0"): reference.decode_bytes([5])}
    with pytest.raises(Exception, match="an id without a token"):
        bpe.decode(spark.createDataFrame([(1, b"\xff\xff\xff\x7f")], "doc_id long, ids binary"),
                   RANKS).collect()


def test_parts_follow_the_text_and_small_memory_of_words(spark, tmp_path, monkeypatch, reference):
    monkeypatch.setattr(bpe, "PART_BYTES", 100)
    monkeypatch.setattr(bpe, "CHUNK_BYTES", 2_000)
    rows = [(i, f"w{i} w{i % 7} straße {i % 3}" * (i % 9), "de", "s") for i in range(400)]
    folder = str(tmp_path / "docs")
    docs(spark, rows).drop("hash").write.parquet(folder)
    got = bpe.encode(spark.read.parquet(folder), RANKS, public_tokenizers.PATTERN).collect()
    assert {r.doc_id: np.frombuffer(bytes(r.ids), "<u4").tolist() for r in got} \
        == {r[0]: reference.encode_ordinary(r[1]) for r in rows} and len(got) == 400


def test_empty_table(spark):
    assert bpe.encode(docs(spark, []), RANKS, public_tokenizers.PATTERN).count() == 0


def test_packing():
    for values in ([], [0], [3, 2 ** 32 - 1, 70_000]):
        assert chunks.unpack(chunks.pack(np.array(values, dtype=np.uint32))).tolist() == values
    for words in ([], [b""], [b"a\n", b"", "é ".encode() * 300]):
        assert chunks.unpack_words(chunks.pack_words(words)) == words
    renamed, order = chunks.by_frequency(np.array([2, 2, 1, 2, 1, 0]), 4)
    assert renamed.tolist() == [0, 0, 1, 0, 1, 2] and order.tolist() == [2, 1, 0, 3]
