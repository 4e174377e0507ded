import hashlib
import itertools
import random

import pytest

from tideglass.llm import repair
from tideglass.llm.repair import (
    ASSISTANT, ENDS, KEPT, MADE, START, Costs, close, compose, plan_repairs, repaired_turns, search,
    segment_ways, suffix_bounds, transcript_digests,
)

ALPHABET = "suaoxSUAO"


def all_edits(code, costs, most_inserts):
    """Every audit of ``code`` with at most so many inserts, and its cost, by enumeration."""
    def walk(at, state, cost, audit, inserts):
        if at == len(code) and state in ENDS:
            yield cost, audit
        if inserts:
            yield from walk(at, MADE[state], cost + costs.insert, audit + "I", inserts - 1)
        if at < len(code):
            c = code[at]
            yield from walk(at + 1, state, cost + costs.delete, audit + "D", inserts)
            if c != "x":
                stay = cost + costs.truncated * c.isupper()
                yield from walk(at + 1, MADE[state], stay + costs.rerole, audit + "R", inserts)
                if (state, c.lower()) in KEPT:
                    yield from walk(at + 1, KEPT[state, c.lower()], stay, audit + "K", inserts)
    return walk(0, START, 0, "", most_inserts)


def step_by_step(code, costs=Costs()):
    """The same answer turn by turn, keeping the best of each state."""
    best = {START: (0, "")}

    def better(table, state, answer):
        if state not in table or answer < table[state]:
            table[state] = answer

    def inserted(table):
        for _ in range(3):
            for state, (cost, audit) in list(table.items()):
                better(table, MADE[state], (cost + costs.insert, audit + "I"))
        return table

    for c in code:
        new = {}
        for state, (cost, audit) in inserted(best).items():
            better(new, state, (cost + costs.delete, audit + "D"))
            if c != "x":
                stay = cost + costs.truncated * c.isupper()
                better(new, MADE[state], (stay + costs.rerole, audit + "R"))
                if (state, c.lower()) in KEPT:
                    better(new, KEPT[state, c.lower()], (stay, audit + "K"))
        best = new
    best = inserted(best)
    return min(best[s] for s in ENDS if s in best)


@pytest.mark.parametrize("costs", [Costs(), Costs(3, 7, 2, 1), Costs(1, 1, 1, 1)])
def test_search_equals_enumeration(costs):
    for n in range(4):
        for code in map("".join, itertools.product(ALPHABET, repeat=n)):
            assert search(code, costs) == min(all_edits(code, costs, 5)), code


def test_search_equals_table_and_bounds_hold():
    rng = random.Random(3)
    for costs in (Costs(), Costs(3, 7, 2, 1)):
        for alphabet in (ALPHABET, "ua", "aaau", "SUA"):
            for _ in range(60):
                code = "".join(rng.choice(alphabet) for _ in range(rng.randrange(4, 25)))
                assert search(code, costs) == step_by_step(code, costs)
                assert suffix_bounds(code, costs)[0] <= search(code, costs)[0]
                assert len(suffix_bounds(code, costs)) == len(code) + 1


def test_segments_compose_exactly():
    rng = random.Random(4)
    for costs in (Costs(), Costs(3, 7, 2, 1)):
        for _ in range(40):
            parts = ["".join(rng.choice(ALPHABET) for _ in range(rng.randrange(1, 8)))
                     for _ in range(4)]
            ways = segment_ways(parts[0], costs)
            for part in parts[1:]:
                ways = compose(ways, segment_ways(part, costs))
            assert close(ways, costs) == step_by_step("".join(parts), costs)


def expected(rows):
    """The whole operator for one conversation of (turn, role, text)."""
    rows = [(t, " " if r is None else r, " " if x is None else x) for t, r, x in rows]
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).digest()))
    seen, code, counts = set(), "", dict(blank=0, duplicate=0, truncated=0)
    for turn, role, text in rows:
        core, c = text.rstrip(repair.SPACE), role[:1] if role[:1] in tuple("sua") else "o"
        if not core:
            counts["blank"] += 1
            c = "x"
        elif (role, text) in seen:
            counts["duplicate"] += 1
            c = "x"
        elif core[-1] not in ".!?":
            counts["truncated"] += 1
            c = c.upper()
        seen.add((role, text))
        code += c
    initials = [r[1][:1] for r in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    turns = {t for t, *_ in rows if t is not None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    cost, audit = step_by_step(code)
    out, state, rest = [], START, list(rows)
    for edit in audit:
        _, role, text = rest.pop(0) if edit != "I" else (0, "", "")
        if edit == "K":
            state = KEPT[state, role[0]]
        elif edit in "RI":
            state = MADE[state]
            role = "assistant" if state == ASSISTANT else "user"
        if edit != "D":
            out.append(f"{role}:{text}")
    return (gaps, *counts.values(), illegal, cost, audit), out


def given(spark, rows):
    kind = "conv_id long, turn long, role string, text string, place string, audit int, conv binary"
    return spark.createDataFrame([(*r, "p", 1, b"c") for r in rows], kind)


def test_operator_on_odd_and_long_conversations(spark):
    rng = random.Random(5)
    roles = ["system", "user", "assistant", "tool", "", None, "assistant", "user"]
    texts = ["Yes.", "No!", "why?  \n", "cut off", "", None, " \t", "é…", "end. "]
    rows = [(1, None, "user", "A."), (1, None, "user", "A."), (1, None, None, None),
            (None, 0, "user", "Hi."), (None, 1, "assistant", "Ho."), (2, 5, "user", "x" * 300_000 + "."),
            (2, 9, "assistant", "B."), (3, 0, "user", ""), (4, 0, "assistant", "only")]
    for conv, n in ((10, 31), (11, 32), (12, 33), (13, 1500)):
        rows += [(conv, rng.randrange(n), rng.choice(roles), rng.choice(texts) if rng.random() < .3
                  else f"text {rng.random()}.") for _ in range(n)]
    table = given(spark, rows)
    repairs = plan_repairs(table).cache()
    got = {r[0]: tuple(r)[1:] for r in repairs.collect()}
    told = {r[0]: r[1] for r in transcript_digests(repaired_turns(table, repairs)).collect()}
    assert got.keys() == {r[0] for r in rows} and repairs.count() == len(got)
    for conv in got:
        result, lines = expected([r[1:] for r in rows if r[0] == conv])
        assert got[conv] == result, conv
        want = hashlib.sha256("\n".join(lines).encode()).hexdigest() if lines else None
        assert told.get(conv) == want


def test_inserts_are_put_in(spark):
    cheap = Costs(rerole=3, delete=7, insert=2, truncated=1)
    table = given(spark, [(1, 0, "user", "A."), (1, 1, "user", "B."), (1, 2, "system", "C.")])
    repairs = plan_repairs(table, cheap)
    row = repairs.first()
    assert (row["cost"], row["audit"]) == search("uus", cheap)
    lines = [tuple(r) for r in repaired_turns(table, repairs).select("role", "text").collect()]
    assert [r[0][0] for r in lines] in (list("ua" * k) for k in range(1, 4))
    assert ("assistant", "") in lines


def test_empty_table(spark):
    table = given(spark, [])
    repairs = plan_repairs(table)
    assert repairs.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal",
                               "cost", "audit"]
    assert repairs.collect() == [] and repaired_turns(table, repairs).collect() == []
