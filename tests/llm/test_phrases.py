import random
import re
from collections import Counter

import numpy as np
import pytest

from tests.llm.helpers import AWKWARD, docs
from tideglass.llm import phrases, texts
from tideglass.llm.chunks import pack
from tideglass.llm.phrases import collocations, count_phrases, tokens

UPPER = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def pieces(text):
    for piece in re.split(r"[.,;:!?\x0a-\x0d]", (text or "").translate(UPPER)):
        yield re.findall(r"[^\x20\x09]+", piece)


def brute_counts(rows):
    counts = Counter()
    for row in rows:
        text, lang = row[1], (row[2] if len(row) > 2 else None) or "und"
        for words in pieces(text):
            for k in range(1, 5):
                counts.update((lang, tuple(words[i:i + k])) for i in range(len(words) - k + 1))
    return counts


def brute(rows, threshold, most=2000):
    f = {p: n for p, n in brute_counts(rows).items() if n >= threshold}
    total = Counter()
    for (lang, p), n in brute_counts(rows).items():
        total[lang] += n * (len(p) == 1)
    found = {}
    for (lang, p), a in f.items():
        if len(p) == 1:
            continue
        parents = [n for (x, q), n in f.items() if x == lang and len(q) > len(p) and any(
            q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1))]
        if any(100 * n >= 80 * a for n in parents):
            continue
        score, k = min((2_000_000 * a // (f[lang, p[:k]] + f[lang, p[k:]]), k)
                       for k in range(1, len(p)))
        found.setdefault(lang, []).append(
            (-score, -a, " ".join(p).encode(), a, f[lang, p[:k]], f[lang, p[k:]]))
    return sorted((lang, rank, phrase.decode(), a, l, r, total[lang], -s)
                  for lang, held in found.items()
                  for rank, (s, _, phrase, a, l, r) in enumerate(sorted(held)[:most], 1))


def corpus(seed, n=400):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(40)] + ["É", "naïve", "a b", "X", "x"]
    fixed = ["new york city hall", "machine learning", "per se", "Out of the blue"]
    rows = []
    for i in range(n):
        words = [rng.choice(fixed) if rng.random() < 0.15
                 else rng.choice(vocabulary[:3 + int(42 * rng.random() ** 2)])
                 for _ in range(rng.randrange(60))]
        text = "".join(w + rng.choice([" ", " ", " ", "  ", "\t", ", ", ".\n", "!?"]) for w in words)
        rows.append((i, text, rng.choice(["en", "en", "de", None])))
    return rows


def test_tokens():
    given = ["One two,three four.. FIVE\x0bsix", "", "é É \t x", "same", "same"]
    import pyarrow as pa
    words, text, begins = tokens(*texts.utf8(pa.array([*given, None])))
    want = [(w, t, k == 0) for t, x in enumerate(given) for p in pieces(x) for k, w in enumerate(p)]
    assert list(zip(words.to_pylist(), text.tolist(), begins.tolist())) == want
    assert len(tokens(np.zeros(0, np.uint8), np.array([0]))[0]) == 0


@pytest.mark.parametrize("shards, chunk_bytes, parts", [(2, 3000, 3), (3, 2000, 4)])
def test_counts_equal_brute_force(spark, shards, chunk_bytes, parts):
    rows = corpus(shards)
    found = count_phrases(docs(spark, rows).repartition(parts), 12, shards, chunk_bytes=chunk_bytes).collect()
    want = {(lang, " ".join(p)): n for (lang, p), n in brute_counts(rows).items() if n >= 12}
    assert {(r["lang"], r["phrase"]): r["n"] for r in found} == want and len(found) == len(want)
    for r in found:
        words = r["phrase"].split(" ")
        assert r["heads"] == [want[r["lang"], " ".join(words[:k + 1])] for k in range(len(words))]
        assert r["tails"] == [want[r["lang"], " ".join(words[-k - 1:])] for k in range(len(words))]


def test_collocations_equal_brute_force(spark):
    rows = corpus(9)
    found = collocations(docs(spark, rows).repartition(3), most=25, threshold=10, chunk_bytes=4000)
    assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, found.collect())) == brute(rows, 10, 25)


def test_awkward_and_repeated_rows(spark):
    rows = AWKWARD + [(9, "tie one. tie two. tie one. tie two", "x")] * 40
    found = sorted(map(tuple, collocations(docs(spark, rows), threshold=30).collect()))
    assert found == brute(rows, 30)
    assert [r[2] for r in found if r[0] == "x"] == ["tie one", "tie two"]


def test_nothing_frequent(spark):
    for rows in ([], [(1, None), (2, ""), (3, "one two")], [(1, "a . b ! c\nd; " * 50)]):
        assert collocations(docs(spark, rows)).collect() == []


@pytest.mark.parametrize("spread", [1, 1 << 20, 1 << 59])
def test_pairs_are_put_in_order(spread):
    rng = np.random.default_rng(3)
    left, right = (rng.integers(0, 9, 500) * spread + (9 << 53) * (spread < 1 << 50) for _ in range(2))
    order = phrases._order(left, right)
    want = np.lexsort((right, left))
    assert (left[order] == left[want]).all() and (right[order] == right[want]).all()
    assert len(phrases._order(left[:0], right[:0])) == 0 and len(phrases._order(left[:1], right[:1])) == 1


def test_a_chunk_is_read_without_sorting_its_places(monkeypatch):
    """What is told of a chunk is sorted; its places, which are many more, are looked up."""
    sequence, sorted_sizes = phrases._Sequence(pack(np.array([0, 1, 2, 3, 1, 2, 0, 2, 1] * 50))), []
    for name in ("unique", "argsort", "sort"):
        monkeypatch.setattr(np, name, lambda x, *a, f=getattr(np, name), **k: (
            sorted_sizes.append(len(x)), f(x, *a, **k))[1])
    sequence.begin(np.array([2, 1]), np.array([70, 90]), np.array([0, 1]))
    at, code = sequence.pairs()
    assert [(sequence.ids[c // 2], sequence.ids[c % 2]) for c in code[:3]] == [(90, 70)] * 2 + [(70, 90)]
    sequence.lengthen(*map(np.array, ([70, 90, 5], [90, 70, 70], [8, 7, 6], [3, 2, 1])))
    assert sequence.ids.tolist() == [7, 8] and sequence.steps.tolist() == [2, 3]
    assert sequence.local[:9].tolist() == [-1, 0, -1, -1, 0, -1, -1, 1, -1]
    assert max(sorted_sizes) <= 3
