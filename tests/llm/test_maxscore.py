import numpy as np

from tideglass.llm import maxscore
from tideglass.llm.maxscore import Shard, top_k
from tideglass.llm.queries import op1_maxscore

SCHEMA = "vec_id long, vec array<long>, id string, score string, rank int"


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", 1) for r in rows], SCHEMA)


def brute(vectors, queries, k):
    def clean(rows):
        return [(i, v) for i, v in rows if i is not None and v is not None and None not in v]

    asked, found = {}, []
    for i, v in clean(queries):
        asked[i] = min(asked.get(i, v), v)
    for q, qv in asked.items():
        scores = sorted((-sum(a * b for a, b in zip(qv, v)), i)
                        for i, v in clean(vectors) if i != q)
        found += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scores[:k])]
    return sorted(found)


def test_rows_of_one_id_are_all_candidates(spark):
    got = top_k(table(spark, [(0, [1]), (5, [9]), (5, [2]), (6, [9])]), table(spark, [(0, [1])]), 5)
    assert sorted(map(tuple, got.collect())) == [(0, 1, 5, 9), (0, 2, 6, 9), (0, 3, 5, 2)]


def test_query_leaves_out_components_that_are_no_numbers(spark, tmp_path):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [0.5, 0.25]), (1, [nan, 1.0]), (2, [inf, 1.0]), (3, [-inf, 1.0]), (4, None),
            (5, [None, 1.0]), (50, [-0.001, 1.0]), (7, [0.5])]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>").write.parquet(
        f"{tmp_path}/embeddings.parquet")
    got = sorted(map(tuple, op1_maxscore(spark, str(tmp_path)).collect()))
    assert got == [(0, 1, 7, 128 * 128), (0, 2, 50, -128 + 64 * 256),
                   (50, 1, 0, -128 + 64 * 256), (50, 2, 7, -128)]


def test_same_as_brute_force_over_several_cells(spark, monkeypatch):
    monkeypatch.setattr(maxscore, "SHARD_ROWS", 70)
    monkeypatch.setattr(maxscore, "QUERY_ROWS", 9)
    rng = np.random.default_rng(1)
    sparse = rng.integers(-9, 10, (400, 12)) * (rng.random((400, 12)) < 0.4)
    rows = [(i, v) for i, v in enumerate(sparse.tolist())]
    rows += [(1000 + i, rows[0][1]) for i in range(30)]              # ties
    rows += [(7, [1] * 12), (7, [1] * 12)]                           # one id, several rows
    rows += [(None, [1]), (2000, None), (2001, [None, 1]), (2002, []), (2003, [5])]
    queries = rows[::10]
    got = top_k(table(spark, rows), table(spark, queries), 5)
    assert sorted(map(tuple, got.collect())) == brute(rows, queries, 5)


def test_few_candidates_and_empty_tables(spark):
    rows = [(1, [1, 2]), (2, [-3, 0]), (3, [0, 0])]
    got = top_k(table(spark, rows), table(spark, rows[:1]), 5)
    assert sorted(map(tuple, got.collect())) == [(1, 1, 3, 0), (1, 2, 2, -3)]
    assert top_k(table(spark, []), table(spark, rows), 5).count() == 0
    assert top_k(table(spark, rows), table(spark, []), 5).count() == 0
    assert top_k(table(spark, rows[:1]), table(spark, rows[:1]), 5).count() == 0


def test_weak_lists_are_only_probed():
    """With one strong dimension, a candidate of the weak one alone never enters."""
    weights = np.zeros((1000, 2), dtype=np.int64)
    weights[:50, 0] = 100
    weights[50:, 1] = 1
    shard, looked_up = Shard(np.arange(1000), weights), []

    class Spy:
        def __getitem__(self, d):
            looked_up.append(int(d))
            return weights.T[d]

    shard.columns = Spy()
    ids, scores = shard.top(-1, np.array([1, 1]), 5)
    assert ids.tolist() == [0, 1, 2, 3, 4] and scores.tolist() == [100] * 5
    assert looked_up == [0, 1]
