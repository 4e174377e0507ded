import collections
import math
import re

import numpy as np
import pyarrow as pa
import pytest

from tests.llm.helpers import AWKWARD, docs
from tideglass.llm import backoff
from tideglass.llm.backoff import score_documents


def brute(rows, order):
    words = [re.findall(r"[^\x20\x09-\x0D]+", r[1] or "") for r in rows]
    own = [collections.Counter(tuple(w[i:i + k]) for k in range(1, order + 1)
                               for i in range(len(w) - k + 1)) for w in words]
    every = sum(own, collections.Counter())
    total = sum(map(len, words))
    out = []
    for r, w, mine in zip(rows, words, own):
        def count(g):
            return every[g] - mine[g]

        def share(i, k):
            if k == 1:
                return max(count((w[i],)), 0.4) / max(total - len(w), 1)
            g = tuple(w[i - k + 1:i + 1])
            return count(g) / count(g[:-1]) if count(g) else 0.4 * share(i, k - 1)

        units = sum(math.floor(math.log10(share(i, min(order, i + 1))) * 10 ** 6 + 0.5)
                    for i in range(len(w)))
        out.append((r[0] if r[0] is not None else -1, len(w), units))
    return sorted(out)


@pytest.mark.parametrize("order", [1, 2, 3])
def test_same_as_counting_by_hand(spark, monkeypatch, order):
    monkeypatch.setattr(backoff, "CHUNK_BYTES", 2000)
    rows = [r for r in AWKWARD if r[0] not in (8, 9)] + [
        (100 + i, " ".join(f"w{i * k % 13}" for k in range(i % 40)), "en", "s") for i in range(120)]
    got = score_documents(docs(spark, rows).repartition(4), order, parts=5).collect()
    assert sorted((r.doc_id if r.doc_id is not None else -1, r.n_words, r.units) for r in got) \
        == brute(rows, order)


def test_trigrams_count_unless_told_otherwise(spark):
    """Two words of context tell what follows, where one word leaves it open."""
    rows = [(1, "a b c", "en", "s"), (2, "x b d", "en", "s"), (3, "a b c", "en", "s")]
    scores = {r.doc_id: r.units for r in score_documents(docs(spark, rows)).collect()}
    assert sorted((i, 3, u) for i, u in scores.items()) == brute(rows, 3) != brute(rows, 2)


def test_long_texts_and_empty_tables(spark):
    got = {r.doc_id: r for r in score_documents(docs(spark, AWKWARD)).collect()}
    assert got[8].n_words == 40_000 and got[9].n_words == 1 and got[1].units == 0
    assert score_documents(docs(spark, [])).count() == 0


def test_blocks_hold_quotients_and_chunks_are_not_stored(spark, monkeypatch):
    """Chunks were written, and blocks held whole hashes, whose remainder their part tells."""
    assert not hasattr(backoff, "stage")
    rows = [(i, f"a{i} b{i % 7} c{i % 3}", "en", "s") for i in range(60)]
    batch = pa.RecordBatch.from_pydict({"doc_id": [r[0] for r in rows], "text": [r[1] for r in rows]})
    monkeypatch.setattr(backoff.TaskContext, "get", lambda: type("T", (), {"partitionId": lambda self: 0})())
    whole = next(backoff._cut(iter([batch]))).to_pylist()[0]
    grams = backoff._Chunk(whole["words"], whole["payload"], whole["lengths"], 3).grams
    sent = [b.to_pylist()[0] for b in backoff._explode(3, 5)(iter([batch]))]
    assert sorted(g for b in sent for g in (backoff._unpack_sorted(b["grams"]) * 5 + b["part"]).tolist()) \
        == [g for g in grams.tolist() if g]
    assert {b["check"] for b in sent} == {whole["check"]}


def test_a_table_that_reads_differently_is_an_error(spark):
    def random_text(batches):
        import uuid
        for b in batches:
            yield pa.RecordBatch.from_pydict({"doc_id": b.column(0), "text": [uuid.uuid4().hex] * b.num_rows})

    unsteady = spark.range(20).mapInArrow(random_text, "doc_id long, text string")
    with pytest.raises(Exception, match="another order"):
        score_documents(unsteady).collect()


def test_ngrams_are_numbered_without_sorting_their_hashes(monkeypatch):
    """Hashes of every order were sorted once for the chunk, once for each document's own counts and
    once more for all orders; that was most of the CPU time."""
    rows = [[f"w{i * k % 7}" for k in range(i % 30)] for i in range(80)] + [[], ["w1"], ["solo"] * 9]
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(len(rows))), "text": [" ".join(r) for r in rows]})
    monkeypatch.setattr(backoff.TaskContext, "get", lambda: type("T", (), {"partitionId": lambda self: 0})())
    monkeypatch.setattr(np, "unique", lambda *a, **k: pytest.fail("hashes are sorted"))
    row = next(backoff._cut(iter([batch]))).to_pylist()[0]
    chunk = backoff._Chunk(row["words"], row["payload"], row["lengths"], 3)
    for k in range(3):
        ends = [[tuple(r[i - k:i + 1]) if i >= k else None for i in range(len(r))] for r in rows]
        flat = [g for r in ends for g in r]
        every = collections.Counter(flat)
        assert [(n, o) for g, n, o in zip(flat, chunk.counts[chunk.where[k]].tolist(), chunk.own(k).tolist())
                if g] == [(every[g], r.count(g)) for r in ends for g in r if g]
        assert len({(g, w) for g, w in zip(flat, chunk.where[k].tolist()) if g}) == len(set(flat) - {None})
    assert (np.diff(chunk.grams.astype(object)) > 0).all() and sorted(chunk.numbers) == list(range(len(chunk.grams)))


@pytest.mark.parametrize("limit", [50, 1 << 63])
def test_keys_with_and_without_room_for_the_place(limit):
    keys = np.random.default_rng(1).integers(0, 50, 3000, dtype=np.uint64)
    at, first = backoff._grouped(keys, limit)
    assert at.tolist() == sorted(range(3000), key=lambda i: (keys[i], i)) and first.sum() == 50
    assert backoff._grouped(keys[:0], 0)[0].tolist() == backoff._ascending(keys[:0]).tolist() == []


def test_hashes_alike_in_their_high_bits_are_in_order():
    r = np.random.default_rng(2)
    values = (r.integers(0, 400, 3000, dtype=np.uint64) << np.uint64(55)) + r.integers(0, 4000, 3000, dtype=np.uint64)
    at = backoff._ascending(values)
    assert values[at].tolist() == sorted(values.tolist()) and sorted(at.tolist()) == list(range(3000))
