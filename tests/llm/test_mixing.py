import collections
import re

from tests.llm.helpers import AWKWARD, docs
from tideglass.llm.mixing import mix_sources


def level_targets(sizes, weights=(5, 2, 1), share=1.5, most=2.0):
    """Deals, caps and deals the excess again until no source is above its limit."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, open_, target = share * sum(sizes.values()), set(names), dict.fromkeys(names, 0.0)
    while open_:
        each = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if each * weight[s] >= most * sizes[s]}
        if not full:
            return target | {s: each * weight[s] for s in open_}
        for s in full:
            target[s] = most * sizes[s]
            left -= target[s]
        open_ -= full
    return target


def test_targets_and_taken_words(spark):
    rows = AWKWARD + [(100 + i, "w " * (1 + i * 7 % 90), None, f"s{i % 5}") for i in range(600)]
    got = mix_sources(docs(spark, rows)).collect()
    assert len(got) == len(rows)
    by_source = collections.defaultdict(list)
    sizes = collections.Counter()
    for _, text, _, source in rows:
        sizes[source] += len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    for r in got:
        assert r.taken == r.copies * r["size"] and r.copies <= 2
        by_source[r.source].append(r)
    want = level_targets(sizes)
    for source, found in by_source.items():
        assert found[0].source_size == sizes[source]
        assert abs(found[0].target - want[source]) < 1e-6
        largest = max(r["size"] for r in found)
        assert abs(sum(r.taken for r in found) - want[source]) <= largest


def test_reruns_and_row_order_do_not_matter(spark):
    rows = [(i, "a b c " * (i % 9), None, "hot" if i % 3 else "b") for i in range(300)]
    one = sorted(mix_sources(docs(spark, rows)).collect())
    assert one == sorted(mix_sources(docs(spark, rows[::-1]).repartition(5)).collect())


def test_empty_table_and_no_words(spark):
    assert mix_sources(docs(spark, [])).count() == 0
    assert [r.taken for r in mix_sources(docs(spark, [(1, None), (2, "")])).collect()] == [0, 0]
