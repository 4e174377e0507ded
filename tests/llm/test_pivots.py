import math

import numpy as np
import pytest

from tideglass.llm import pivots
from tideglass.llm.pivots import Shard, filled, nearest, permutations

KIND = "vec_id long, embedding array<float>, score string, row int, shard binary"


def table(spark, rows):
    rows = [(i, v and [x if x is None else float(x) for x in v], "s", 1, b"b") for i, v in rows]
    return spark.createDataFrame(rows, KIND)


def dot(a, b):
    total = 0.0
    for x, y in zip(a, b):  # sum() compensates for rounding
        total += x * y
    return total


def brute(rows, k=20, every=20):
    """Every usable row against every other, products summed in order in double precision."""
    usable = [(i, [float(np.float32(x)) for x in v]) for i, v in rows
              if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    out = []
    for q, (qid, qv) in enumerate(usable):
        if qid % every == 0:
            scored = sorted((-dot(qv, v), i, n)
                            for n, (i, v) in enumerate(usable) if n != q)
            out += [(qid, r, i, -s) for r, (s, i, _) in enumerate(scored[:k], 1)]
    return sorted(out)


def got(df):
    return sorted(tuple(r) for r in df.collect())


def test_footrule_from_postings():
    rng = np.random.default_rng(1)
    n, k = 200, 8
    perms = np.array([rng.permutation(20)[:k] for _ in range(n)], np.uint8)
    shard = Shard(np.arange(n), np.arange(n), rng.normal(size=(n, 4)), perms)
    for q in range(0, n, 17):
        common = np.zeros(n, int)
        for place, pivot in enumerate(perms[q]):
            held, worth = shard.lists[pivot]
            common[held] += np.minimum(worth, k - place)
        for v in range(n):
            def place(perm, p):
                return list(perm).index(p) if p in perm else k
            both = set(perms[q]) | set(perms[v])
            footrule = sum(abs(place(perms[q], p) - place(perms[v], p)) for p in both)
            assert k * (k + 1) - 2 * common[v] == footrule


def test_odd_rows_and_ties_equal_brute_force(spark):
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=6).tolist()) for i in range(150)]
    rows += [(200 + i, [1.0, 0, 0, 0, 0, 0]) for i in range(30)]      # ties
    rows += [(40, [3.0] * 6), (40, [3.0] * 6), (41, [5.0, 5.0])]      # repeated ids, a short vector
    rows += [(60, None), (61, []), (80, [0.0] * 6), (100, [1.0, None]), (120, [float("nan")] * 6),
             (140, [float("inf"), 1.0]), (None, [1.0] * 6)]
    found = got(nearest(table(spark, rows)))
    assert found == brute(rows)
    assert got(nearest(table(spark, rows), "vec_id = 40", k=3)) == [
        r for r in brute(rows) if r[0] == 40 and r[1] <= 3]


def test_few_rows_and_none(spark):
    one = nearest(table(spark, [(0, [1.0]), (1, [2.0]), (2, [-3.0])]))
    assert got(one) == [(0, 1, 1, 2.0), (0, 2, 2, -3.0)]
    for rows in ([], [(0, [1.0])], [(1, [1.0]), (2, [1.0])]):
        empty = nearest(table(spark, rows))
        assert empty.columns == ["query_id", "rank", "vec_id", "score"] and got(empty) == []


@pytest.mark.parametrize("spread", [0.0, 0.4])
def test_recall_of_the_index(spark, monkeypatch, spread):
    """Without the floor that ranks small shards whole, over several shards and blocks, with
    lengths alike and different: 0.9 or more of the true neighbours, every score exact."""
    monkeypatch.setattr(pivots, "SHARD_ROWS", 1500)
    monkeypatch.setattr(pivots, "QUERY_ROWS", 64)
    rng = np.random.default_rng(3)
    held = rng.normal(size=(4000, 64))
    held /= np.linalg.norm(held, axis=1)[:, None]
    held *= np.exp(spread * rng.normal(size=(4000, 1)))
    held = held.astype(np.float32).astype(float)
    rows = list(enumerate(held.tolist()))
    found = nearest(table(spark, rows), least=0).collect()
    queries = np.arange(0, 4000, 20)
    scores = held[queries] @ held.T
    scores[np.arange(len(queries)), queries] = -np.inf
    true = {(int(q), int(v)) for q, s in zip(queries, scores) for v in np.argsort(-s)[:20]}
    assert len(found) == 20 * len(queries)
    assert len(true & {(r.query_id, r.vec_id) for r in found}) / len(true) >= 0.9
    for r in found[::50]:
        assert r.score == dot(rows[r.query_id][1], rows[r.vec_id][1])


def test_pivots_of_repeated_vectors():
    vectors = np.ones((5, 3))
    assert permutations(filled(vectors, 2.0), filled(vectors[:1], 2.0), 1).tolist() == [[0]] * 5


def test_recall_on_the_given_table(spark):
    rows = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    held = {r.vec_id: np.array(r.embedding) for r in rows.collect()}
    ids = np.array(sorted(held))
    vectors = np.array([held[i] for i in ids])
    found = {(r.query_id, r.vec_id) for r in nearest(rows, least=0).collect()}
    true = set()
    for q in np.flatnonzero(ids % 20 == 0):
        score = vectors @ vectors[q]
        score[q] = -np.inf
        true |= {(int(ids[q]), int(ids[v])) for v in np.argsort(-score)[:20]}
    assert len(found & true) / len(true) >= 0.9
