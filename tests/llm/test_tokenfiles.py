import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.errors import PythonException
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests.llm.helpers import AWKWARD, docs
from tideglass.llm import texts, tokenfiles
from tideglass.llm.pieces import spans, split
from tideglass.llm.tokenfiles import read_document, read_token_files, write_token_files

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = [
    (100, "  two  spaces\n \n and\t tabs   x ", "en", "s"), (101, "it's 'tis we'll   x　 y", "", ""),
    (102, "\n\n a   b\u0085 c  é́ d", "", ""), (103, "<|endoftext|> as text", "", ""),
    (104, " lead and trail ", "", ""), (105, "a \x1c b \x1f c", "", ""), (106, "日本語 テキスト 123 ４５", "", ""),
]


@pytest.fixture(scope="module")
def reference():
    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return lambda text: t.encode(text or "", add_special_tokens=False).ids + [0]


def order(row):
    return (row[0] is not None, row[0] or 0, row[1] is not None, (row[1] or "").encode())


def test_round_trip(spark, tmp_path, monkeypatch, reference):
    monkeypatch.setattr(tokenfiles, "BLOCK_BYTES", 3000)
    rows = AWKWARD + ODD + [(200 + i, f"word {i} " * (i % 50), "en", "s") for i in range(300)]
    folder = str(tmp_path / "files")
    write_token_files(docs(spark, rows).repartition(3), folder, PATH)
    start, want = 0, []
    for doc_id, text, *_ in sorted(rows, key=order):
        ids = reference(text)
        want.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    got = sorted(map(tuple, read_token_files(spark, folder).collect()), key=lambda r: r[1])
    assert got == want
    assert [x.tolist() for x in read_document(spark, folder, 103)] == [reference("<|endoftext|> as text")]
    assert len(read_document(spark, folder, 5)) == 2 and read_document(spark, folder, 12345) == []
    data = spark.read.parquet(f"{folder}/data")
    assert data.count() > 3 and data.select("dictionary").distinct().count() == 1


def test_blocks_of_another_dictionary_are_refused(spark, tmp_path):
    folder = str(tmp_path / "one")
    write_token_files(docs(spark, [(1, "a b"), (2, "c")]), folder, PATH)
    other = str(tmp_path / "two")
    spark.read.parquet(f"{folder}/dictionary").write.parquet(f"{other}/dictionary")
    spark.read.parquet(f"{folder}/index").write.parquet(f"{other}/index")
    spark.read.parquet(f"{folder}/data").withColumn("dictionary", F.lit("x")).write.parquet(f"{other}/data")
    with pytest.raises(PythonException):
        read_token_files(spark, other).collect()


def test_empty_table(spark, tmp_path):
    write_token_files(docs(spark, []), str(tmp_path / "none"), PATH)
    assert read_token_files(spark, str(tmp_path / "none")).count() == 0


def test_pieces_have_the_pre_tokens_of_the_text():
    import random

    import regex
    r, pattern = random.Random(2), regex.compile(public_tokenizers.PATTERN)
    alphabet = ["a", "B", "é", "1", "'s", "'", ".", " ", " ", "  ", "\n", "\t", " ", "　", "᠎", "\x1c"]
    for _ in range(6_000):
        text = "".join(r.choices(alphabet, k=r.randint(0, 9)))
        given = ["x ", text, "", " y"]  # of neighbours, nothing may stick
        data, bounds = texts.utf8(pa.array(given))
        starts, ends, ranges = spans(data, bounds)
        raw = data.tobytes()
        for k, t in enumerate(given):
            pieces = [raw[a:b].decode() for a, b in zip(starts[ranges[k]:ranges[k + 1]],
                                                        ends[ranges[k]:ranges[k + 1]])]
            assert "".join(pieces) == t
            assert [w for p in pieces for w in pattern.findall(p)] == pattern.findall(t), repr(t)
        first, *rest = split(text)
        assert [w for p in (first, *(" " + x for x in rest)) for w in pattern.findall(p)] \
            == pattern.findall(text), repr(text)


def test_ids_equal_the_library_whatever_white_space():
    """Slices of hundreds of texts, each kind of Unicode white space at start, middle and end."""
    import random

    reference = Tokenizer.from_file(PATH)
    reference.encode_special_tokens = True
    with open(PATH, "rb") as f:
        encoder = tokenfiles.Encoder(f.read())
    white = [chr(c) for c in range(0x3100) if chr(c).isspace()] + ["\u180e", "\u200b", "\ufeff", "  "]
    r = random.Random(7)
    given = [f"{a}{w}{b}" for w in white for a in ("", " ", "x", " s") for b in ("", " ", "y", " Read more")]
    letters = [*white, "a", "B", "é", "1", "'s", ".", "-", "\x7f", "日"]
    given += ["".join(r.choices(letters, k=r.randint(0, 8))) for _ in range(6000)]
    for first in range(0, len(given), 400):
        part = given[first:first + 400]
        ids, bounds = encoder.encode(pa.array(part))
        for k, text in enumerate(part):
            assert ids[bounds[k]:bounds[k + 1]].tolist() == reference.encode(
                text, add_special_tokens=False).ids, repr(text)
