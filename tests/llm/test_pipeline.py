import collections
import hashlib
import re

import numpy as np
import public_tokenizers
import pytest
import tiktoken

import corpus_pipeline
from tests.llm.helpers import DOCS
from tests.llm.test_langid import corpus
from tests.llm.test_mixing import level_targets
from tideglass.llm import bpe

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """The rows after each stage, over labelled texts, near copies, secrets and junk."""
    rows = [(i, t + f" closing words of number {i}", lang, f"s{i % 3}") for i, t, lang, _ in corpus(150)]
    long = [r for r in rows if len(r[1].split()) > 80][:10]
    rows += [(1000 + k, r[1] + " one more", r[2], r[3]) for k, r in enumerate(long)]   # near
    rows += [(1100 + k, r[1], r[2], "s0") for k, r in enumerate(long)]                 # exact
    rows += [(1200 + k, f"{r[1]} token = {hashlib.sha1(str(k).encode()).hexdigest()} end",
              r[2], r[3]) for k, r in enumerate(rows[100:120])]
    rows += [(1300, None, "xx", "s0"), (1301, "", None, None), (1302, "1 2 3 !!", "xx", "s1")]
    rows += [rows[5], rows[5]]
    folder = str(tmp_path_factory.mktemp("sf"))
    spark.createDataFrame([(*r, len(r[1] or "")) for r in rows], DOCS[:5]) \
        .write.parquet(f"{folder}/documents.parquet")
    docs, out = spark.read.parquet(f"{folder}/documents.parquet"), []
    for k, (name, step) in enumerate(corpus_pipeline.STAGES):
        step(spark, docs, folder).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
        out.append(docs.collect())
        if k < 4:
            assert docs.columns == COLUMNS
    return rows, out, sorted(map(tuple, corpus_pipeline.run(spark, folder).collect()))


def test_language_stage_drops_what_has_none(stages):
    rows, out, _ = stages
    assert collections.Counter(r.doc_id for r in out[0]) \
        == collections.Counter(r[0] for r in rows if r[0] not in (1300, 1301, 1302))


def test_near_copies_go_and_others_stay(stages):
    rows, out, _ = stages
    ids = collections.Counter(r.doc_id for r in out[1])
    assert all(n == 1 for n in ids.values())
    assert not [i for i in ids if 1000 <= i < 1200] and set(range(100)) <= ids.keys()


def test_secrets_are_masked_and_nothing_else(stages):
    _, out, _ = stages
    before = {r.doc_id: r.text for r in out[1]}
    for r in out[2]:
        want = re.sub(r"token = [0-9a-f]{40}", "[secret]", before[r.doc_id])
        assert r.text == want and r.n_chars == len(want)
    assert len(out[2]) == len(out[1])


def test_mix_meets_its_targets(stages):
    _, out, _ = stages
    sizes, taken, largest = collections.Counter(), collections.Counter(), collections.Counter()
    for r in out[2]:
        n = len(r.text.split())
        sizes[r.source] += n
        largest[r.source] = max(largest[r.source], n)
    for r in out[3]:
        taken[r.source] += len(r.text.split())
    for source, target in level_targets(sizes).items():
        assert abs(taken[source] - target) <= largest[source]
    assert max(collections.Counter(r.doc_id for r in out[3]).values()) <= 2


def test_ids_are_those_of_the_texts(stages):
    _, out, ran = stages
    with open(public_tokenizers.path(corpus_pipeline.RANKS), "rb") as f:
        encoding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, special_tokens={},
                                     mergeable_ranks=bpe.read_ranks(f.read()))
    want = []
    for r in out[3]:
        ids = encoding.encode_ordinary(r.text)
        want.append((r.doc_id, np.array(ids, "<u4").tobytes(), len(ids),
                     hashlib.sha256(r.text.encode()).hexdigest()))
    got = sorted((r.doc_id, bytes(r.ids), r.n_tokens, r.decoded_sha256) for r in out[4])
    assert got == sorted(want)
    assert [(a, bytes(b), c, d) for a, b, c, d in ran] == got
