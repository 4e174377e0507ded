import collections
import random
import re

import numpy as np
import pyarrow as pa

from tests.llm.helpers import AWKWARD, docs
from tideglass.llm import neardup, texts
from tideglass.llm.components import components
from tideglass.llm.neardup import drop_near_duplicates, near_duplicates


def weights(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = min(5, len(w))
    return collections.Counter(tuple(w[i:i + n]) for i in range(len(w) - n + 1)) if n else {}


def prob_jaccard(x, y):
    if all(w == 1 for s in (x, y) for w in s.values()):
        return len(set(x) & set(y)) / len(set(x) | set(y))
    every = set(x) | set(y)
    return sum(1 / sum(max(x.get(j, 0) / x[i], y.get(j, 0) / y[i]) for j in every)
               for i in set(x) & set(y))


def brute_classes(rows):
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    sets = [weights(r[1]) for r in rows]
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and (
                    rows[i][1] == rows[j][1] or prob_jaccard(sets[i], sets[j]) >= 0.8):
                root[find(i)] = find(j)
    groups = collections.defaultdict(list)
    for i, r in enumerate(rows):
        groups[find(i)].append(r[0])
    return sorted(sorted(g) for g in groups.values())


def corpus():
    r = random.Random(8)

    def words(n):
        return [f"w{r.randrange(4000)}" for _ in range(n)]

    rows, i = [], 0
    for _ in range(25):
        base = words(r.choice([6, 30, 120, 400]))
        for _ in range(r.choice([1, 2, 5, 12])):
            copy = list(base)
            for _ in range(r.choice([0, 1, 2, 4, 10])):
                copy[r.randrange(len(copy))] = f"x{r.randrange(10 ** 6)}"
            rows.append((i, " ".join(copy), "en", "s"))
            i += 1
    chain = words(200)  # each near the next, the ends far apart
    for k in range(8):
        chain = chain[4:] + words(4)
        rows.append((i + k, " ".join(chain), "en", "s"))
    shared = words(60)  # documents that share a passage are not near
    rows += [(i + 100 + k, " ".join(words(80) + shared + words(80)), "en", "s") for k in range(20)]
    loop = words(9)     # weights matter
    rows += [(i + 200 + k, " ".join(loop * (k + 1) + words(5)), "en", "s") for k in range(5)]
    return rows


def test_classes_are_those_of_all_pairs(spark):
    rows = corpus()
    got = collections.defaultdict(list)
    found = near_duplicates(docs(spark, rows)).collect()
    for r in found:
        got[r.class_id].append(r.doc_id)
    assert sorted(sorted(g) for g in got.values()) == brute_classes(rows)
    assert all(min(g) == c for c, g in got.items())
    assert sorted(r.doc_id for r in found if r.kept) == sorted(got)


def test_a_large_group_of_copies_and_strays(spark, monkeypatch):
    """A bucket in several components is searched in blocks, without losing a link."""
    monkeypatch.setattr(neardup, "HUBS", 1)
    monkeypatch.setattr(neardup, "LEFT_ROWS", 4)
    monkeypatch.setattr(neardup, "RIGHT_ROWS", 16)
    r = random.Random(3)
    base = [f"w{k}" for k in range(150)]
    rows = []
    for i in range(120):
        copy = list(base)
        for _ in range(3):
            copy[r.randrange(150)] = f"x{r.randrange(10 ** 6)}"
        rows.append((i, " ".join(copy), "en", "s"))
    rows += [(1000 + i, rows[0][1], "en", "s") for i in range(300)]
    got = collections.defaultdict(list)
    for x in near_duplicates(docs(spark, rows)).collect():
        got[x.class_id].append(x.doc_id)
    assert sorted(sorted(d for d in g if d < 1000) for g in got.values()) \
        == brute_classes(rows[:120])
    assert next(len([d for d in g if d >= 1000]) for g in got.values() if 0 in g) == 300


def test_awkward_rows(spark):
    rows = AWKWARD + [(60, "", None, None), (61, "one", None, None), (62, "a b", "x", "y"),
                      (62, "c d e f g h i", "x", "y")]
    got = near_duplicates(docs(spark, rows)).collect()
    assert len(got) == len(rows) - 1  # one row is there twice
    by_id = {r.doc_id: r for r in got}
    assert by_id[2].class_id == 2 and by_id[60].class_id == 60  # no words: alone
    assert by_id[61].class_id == 3 and not by_id[61].kept
    assert by_id[5].class_id == 4 and by_id[1].kept and by_id[None].kept
    assert sorted(r.kept for r in got if r.doc_id == 62) == [False, True] or \
        sum(r.kept for r in got if r.doc_id == 62) == 2
    left = drop_near_duplicates(docs(spark, rows)).collect()
    assert len(left) == sum(r.kept for r in got)
    assert near_duplicates(docs(spark, [])).count() == 0


def test_registers_agree_as_often_as_the_similarity_says():
    r = random.Random(5)
    errors = []
    for _ in range(60):
        base = [f"w{r.randrange(10 ** 5)}" for _ in range(r.choice([20, 200]))] * r.choice([1, 2])
        other = list(base)
        for _ in range(r.choice([1, 3, 8])):
            other[r.randrange(len(other))] = f"x{r.randrange(10 ** 6)}"
        pair = [" ".join(base), " ".join(other)]
        parts = neardup.shingles(*texts.words(*texts.utf8(pa.array(pair))))
        one, two = neardup.prob_min_hash(*parts, 2)
        errors.append((one == two).mean() - prob_jaccard(*map(weights, pair)))
    assert abs(np.mean(errors)) < 0.02 and np.max(np.abs(errors)) < 0.2


def test_components_of_paths_stars_and_rings(spark):
    edges = [(k, k + 1) for k in range(30)] + [(100, 101 + k) for k in range(40)] \
        + [(200 + k, 200 + (k + 1) % 9) for k in range(9)] + [(300, 300)]
    got = dict(map(tuple, components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert got == {**{k: 0 for k in range(31)}, **{100 + k: 100 for k in range(41)},
                   **{200 + k: 200 for k in range(9)}}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
