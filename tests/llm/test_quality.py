import collections
import re

from tests.llm.helpers import AWKWARD, docs
from tideglass.llm.quality import quality_rules


def brute(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    runs = [tuple(w[i:i + 8]) for i in range(len(w) - 7)]
    seen = collections.Counter(runs)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    repeated = {i + k for i, run in enumerate(runs) if seen[run] > 1 for k in range(8)}
    return (len(w), sum(map(len, w)), sum(text.count(c) for c in "#*$%&|<>"),
            len(lines) - len(set(lines)), len(repeated))


def test_counts_are_those_of_a_brute_force_pass(spark):
    rows = AWKWARD + [(20, "a b\nc <d>\na b\n\n \n", "en", "a"),
                      (21, "1 2 3 4 5 6 7 8 9 1 2 3 4 5 6 7 8 x", "en", "a")]
    got = quality_rules(docs(spark, rows)).collect()
    want = sorted(((r[0] or -1), *brute(r[1])) for r in rows)
    assert sorted((r.doc_id or -1, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines,
                   r.n_repeat_words) for r in got) == want
    for r in got:
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
        assert not (r.base_failed and r.kept)


def test_fences_follow_the_group(spark):
    """A rate of symbols that is ordinary in one source is an outlier in another."""
    def text(i, sign):
        return " ".join(f"word{i * 40 + k}{sign if k % 2 else ''}" for k in range(40))

    rows = [(i, text(i, ""), "en", "prose") for i in range(150)]
    rows += [(1000 + i, text(1000 + i, "$"), "en", "prices") for i in range(150)]
    rows += [(5000, text(5000, "$"), "en", "prose")]
    kept = {r.doc_id: r.kept for r in quality_rules(docs(spark, rows)).collect()}
    assert not kept.pop(5000)
    assert all(kept.values())


def test_rare_repeats_fall_outside_a_clean_group(spark):
    """A quarter of repeated words, or half of the lines repeated, where no other document has any."""
    def text(i, n=64):
        return "\n".join(" ".join(f"w{i * 64 + 8 * j + k}" for k in range(8))
                         for j in range(n // 8))

    once = [" ".join(f"x{50_000 + 4 * j + k}" for k in range(4)) for j in range(6)]
    rows = [(i, text(100 + i), "en", "prose") for i in range(300)]
    rows += [(5000, text(500, 48) + "\n" + " ".join(text(500, 8).split()) + "\n" + text(501, 8),
              "en", "prose"),
             (5001, "\n".join(x for line in once for x in (line, line)), "en", "prose")]
    got = {r.doc_id: r for r in quality_rules(docs(spark, rows)).collect()}
    repeats, lines = got.pop(5000), got.pop(5001)
    assert (repeats.n_repeat_words, repeats.n_words, repeats.base_failed) == (16, 64, False)
    assert (lines.n_dup_lines, lines.n_lines, lines.base_failed) == (6, 12, False)
    assert not repeats.kept and not lines.kept
    assert all(r.kept for r in got.values())
    old = {r.doc_id: r.kept for r in quality_rules(docs(spark, rows), floors=True).collect()}
    assert all(old.values())  # with floors, both pass


def test_empty_table(spark):
    assert quality_rules(docs(spark, [])).count() == 0
