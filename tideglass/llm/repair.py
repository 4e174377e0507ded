"""Conversation structure repair by depth-first branch-and-bound (operator 13).

A conversation is a sequence of turns, some of them faulty. The cheapest edits are wanted that give
the roles ``(s?(ua)+)?`` (initials of system, user, assistant); among equally cheap edits the least
sequence of initials: (K)eep, (R)erole, (D)elete, (I)nsert.

The search keeps its open nodes on an explicit stack. A node is (turns read, last role, cost,
audit); it is left out when its cost and the least cost of the turns to come (the suffix bound)
cannot beat the incumbent (cost, audit), or when its place (turns read, last role) was reached at
least as well before (the dominance table). The stack runs empty: the incumbent is proved best.

Turns are numbered over all tasks (``number_rows``) and cut into segments of ``SEGMENT`` turns.
A conversation of one segment is one search. A longer one is searched segment by segment, for every
role before and after it, and the segments' tables are composed by groups of ``FAN_IN``, level by
level. That is exact: an audit of a segment ends with the edit of a turn, so no audit of it begins
another, and the better of two at one place stays the better whatever follows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from tideglass.operators.ranking import number_rows
from tideglass.sources.workspace import stage

SEGMENT = 32
FAN_IN = 32
SPACE = " \t\n\x0b\x0c\r"

START, SYSTEM, USER, ASSISTANT = range(4)
STATES = (START, SYSTEM, USER, ASSISTANT)
ENDS = frozenset({START, ASSISTANT})
KEPT = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER,
        (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
MADE = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
ROLE = {USER: "user", ASSISTANT: "assistant"}
LEGAL = frozenset({"su", "ua", "au"})
MUST_GO = "x"

Answer = tuple[int, str]


@dataclass(frozen=True)
class Costs:
    """What an edit costs; all more than 0. A truncated turn that stays costs its own on top."""
    rerole: int = 1
    delete: int = 2
    insert: int = 5
    truncated: int = 5


def suffix_bounds(code: str, costs: Costs) -> list[int]:
    """The least that the turns from each place on can cost, whatever surrounds them: each turn its
    cheapest edit, or two neighbours that cannot both be kept the cheapest edit between them."""
    def least(c: str) -> int:
        stay = (0 if c.lower() in "sua" else costs.rerole) + (costs.truncated if c.isupper() else 0)
        return costs.delete if c == MUST_GO else min(stay, costs.delete)

    edit = min(costs.rerole, costs.delete, costs.insert)
    bounds = [0, 0]
    for at in range(len(code) - 1, -1, -1):
        clash = at + 1 < len(code) and code[at:at + 2].lower() not in LEGAL
        bounds.append(max(least(code[at]) + bounds[-1], edit * clash + bounds[-2]))
    return bounds[:0:-1]


@lru_cache(maxsize=1 << 14)
def search(code: str, costs: Costs, start: int = START, goals: frozenset[int] = ENDS,
           closed: bool = True) -> Answer | None:
    """The least (cost, audit) from ``start`` to one of ``goals`` over the turns of ``code``, None
    if there is no way. A turn is the initial of its role (o: another), in upper case if it is
    truncated, or x if it must go. Turns may be inserted at the end only if ``closed``."""
    bounds, best = suffix_bounds(code, costs), None
    reached: list[dict[int, Answer]] = [{} for _ in range(len(code) + 1)]
    stack: list[tuple[int, int, int, str]] = [(0, start, 0, "")]
    while stack:
        at, state, cost, audit = stack.pop()
        least = cost + bounds[at]
        if best is not None and (least, audit) > (best[0], best[1][:len(audit)]):
            continue
        if state in reached[at] and reached[at][state] <= (cost, audit):
            continue
        reached[at][state] = (cost, audit)
        if at == len(code) and state in goals and (best is None or (cost, audit) < best):
            best = cost, audit
        steps = []
        if at < len(code):
            c = code[at]
            steps.append((cost + costs.delete, "D", at + 1, state))
            if c != MUST_GO:
                stay = cost + (costs.truncated if c.isupper() else 0)
                steps.append((stay + costs.rerole, "R", at + 1, MADE[state]))
                if (state, c.lower()) in KEPT:
                    steps.append((stay, "K", at + 1, KEPT[state, c.lower()]))
        if at < len(code) or closed:
            steps.append((cost + costs.insert, "I", at, MADE[state]))
        # The most promising step is taken first, so it goes on top of the stack.
        steps.sort(key=lambda s: (s[0] + bounds[s[2]], s[1]), reverse=True)
        stack += [(to, new, price, audit + edit) for price, edit, to, new in steps]
    return best


Way = tuple[int, int, int, str]  # (state before, state after, cost, audit)


@lru_cache(maxsize=1 << 12)
def segment_ways(code: str, costs: Costs) -> tuple[Way, ...]:
    """The best way over a segment from every state to every state."""
    found = ((a, b, search(code, costs, a, frozenset({b}), False)) for a in STATES for b in STATES)
    return tuple((a, b, *answer) for a, b, answer in found if answer)


def compose(left: tuple[Way, ...], right: tuple[Way, ...]) -> tuple[Way, ...]:
    best: dict[tuple[int, int], Answer] = {}
    for a, mid, cost, audit in left:
        for b, to, more, rest in right:
            if b == mid:
                answer = cost + more, audit + rest
                if (a, to) not in best or answer < best[a, to]:
                    best[a, to] = answer
    return tuple((a, b, *answer) for (a, b), answer in best.items())


def close(ways: tuple[Way, ...], costs: Costs) -> Answer:
    """The best way from nothing to a whole conversation."""
    missing = {START: 0, SYSTEM: 2, USER: 1, ASSISTANT: 0}
    return min((cost + costs.insert * missing[b], audit + "I" * missing[b])
               for a, b, cost, audit in ways if a == START)


def illegal_pairs(initials: str) -> int:
    return sum(initials[k:k + 2] not in LEGAL for k in range(len(initials) - 1))


_SUMS = ["blank", "duplicate", "truncated", "illegal"]


def _segment_type(id_type: T.DataType) -> T.StructType:
    return T.StructType([
        T.StructField("conv", id_type), T.StructField("segment", T.LongType()),
        *[T.StructField(c, T.LongType()) for c in _SUMS],
        T.StructField("first", T.StringType()), T.StructField("last", T.StringType()),
        T.StructField("cost", T.LongType()), T.StructField("audit", T.StringType()),
        T.StructField("ways", T.ArrayType(T.StructType([
            T.StructField("a", T.IntegerType()), T.StructField("b", T.IntegerType()),
            T.StructField("cost", T.LongType()), T.StructField("audit", T.StringType())]))),
    ])


def _told(ways: tuple[Way, ...]) -> list[dict[str, Any]]:
    return [dict(zip(("a", "b", "cost", "audit"), w)) for w in ways]


def _ways(told: list[dict[str, Any]]) -> tuple[Way, ...]:
    return tuple((w["a"], w["b"], w["cost"], w["audit"]) for w in told)


_WAYS = pa.list_(pa.struct(
    [("a", pa.int32()), ("b", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())]))
_SEGMENT = pa.schema([
    ("segment", pa.int64()), *[(c, pa.int64()) for c in _SUMS], ("first", pa.string()),
    ("last", pa.string()), ("cost", pa.int64()), ("audit", pa.string()), ("ways", _WAYS)])


def _solve(costs: Costs):
    """Each segment searched: whole conversations for good, others from state to state."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.select(batch.schema.names[1:]).to_pylist():
                code, initials = row.pop("code"), row.pop("initials")
                row |= {"illegal": illegal_pairs(initials), "first": initials[0],
                        "last": initials[-1], "cost": None, "audit": None, "ways": None}
                if row["segment"] == 0 and len(code) < SEGMENT:
                    row["cost"], row["audit"] = search(code, costs)
                else:
                    row["ways"] = _told(segment_ways(code, costs))
                out.append(row)
            rest = pa.RecordBatch.from_pylist(out, _SEGMENT)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *rest.columns], ["conv", *_SEGMENT.names])

    return run


def _compose(costs: Costs, last: bool):
    """Neighbouring segments of a conversation as one; after the last round, closed."""
    def run(table: pa.Table) -> pa.Table:
        rows = sorted(table.drop_columns("conv").to_pylist(), key=lambda r: r["segment"])
        whole = rows[0]
        ways = _ways(whole["ways"])
        for row in rows[1:]:
            whole |= {c: whole[c] + row[c] for c in _SUMS}
            whole["illegal"] += illegal_pairs(whole["last"] + row["first"])
            whole["last"] = row["last"]
            ways = compose(ways, _ways(row["ways"]))
        whole["segment"] //= FAN_IN
        if last:
            whole["cost"], whole["audit"] = close(ways, costs)
        whole["ways"] = None if last else _told(ways)
        rest = pa.Table.from_pylist([whole], _SEGMENT)
        return pa.table([table.column("conv")[:1], *rest.columns], ["conv", *_SEGMENT.names])

    return run


def _turns(conversations: DataFrame, id_col: str, turn_col: str, role_col: str,
           text_col: str) -> DataFrame:
    """conv, turn, role, text without other columns; a NULL role or text is one space."""
    return conversations.select(
        F.col(id_col).alias("conv"), F.col(turn_col).alias("turn"),
        F.coalesce(F.col(role_col).cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col(text_col).cast("string"), F.lit(" ")).alias("text"))


def _order(digest: Column) -> list[Column]:
    return [F.asc_nulls_first("turn"), F.asc("role"), digest.asc()]


def plan_repairs(
    conversations: DataFrame, costs: Costs = Costs(), id_col: str = "conv_id",
    turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
) -> DataFrame:
    """One row a conversation: the id, gaps, blank, duplicate, truncated, illegal, cost, audit.

    Turns go by ``turn`` (NULL first), then role, then the MD5 of the text; other columns play no
    part. The first fault of a turn counts: blank (nothing but white space), duplicate (role and
    text were there before in the conversation), truncated (the last character that is no white
    space is none of ``.!?``). Blank and duplicate turns must go. ``illegal`` counts neighbours
    whose initials are not su, ua or au; ``gaps`` the turns missing between the least and the
    greatest number. A NULL id is a conversation; a NULL role or text counts as one space; a
    conversation of NULL turns has no gaps. An empty table gives no rows.
    """
    turns = _turns(conversations, id_col, turn_col, role_col, text_col)
    core = F.rtrim(F.col("text"), F.lit(SPACE))
    initial = F.substring("role", 1, 1)
    rows = turns.select(
        "conv", "turn", "role", F.unhex(F.md5("text")).alias("digest"),
        F.when(initial.isin("s", "u", "a"), initial).otherwise(F.lit("o")).alias("initial"),
        (core == "").alias("is_blank"), (~F.substring(core, -1, 1).isin(".", "!", "?")).alias("open"))
    placed = number_rows(rows, ["conv"], _order(F.col("digest")))

    # A text's first place in its conversation; places are unique, so no join key is hot.
    firsts = placed.where("not is_blank").groupBy("conv", "role", "digest").agg(
        F.min("place").alias("_place")).select(F.col("conv").alias("_conv"), "_place")
    judged = placed.join(
        firsts, placed["conv"].eqNullSafe(firsts["_conv"]) & (F.col("place") == F.col("_place")),
        "left",
    ).select(
        "conv", "place", "turn", "initial", F.col("is_blank").alias("blank"),
        (~F.col("is_blank") & F.col("_place").isNull()).alias("duplicate"),
        (~F.col("is_blank") & F.col("_place").isNotNull() & F.col("open")).alias("truncated"))
    code = F.when(F.col("blank") | F.col("duplicate"), F.lit(MUST_GO)).when(
        F.col("truncated"), F.upper("initial")).otherwise(F.col("initial"))
    turns_of = F.array_sort(F.collect_list(F.struct("place", "initial", code.alias("code"))))
    segments = judged.groupBy(
        "conv", F.floor((F.col("place") - 1) / F.lit(SEGMENT)).alias("segment")
    ).agg(
        *[F.sum(F.col(c).cast("long")).alias(c) for c in _SUMS[:3]], turns_of.alias("t"),
    ).select(
        "conv", "segment", *_SUMS[:3], F.array_join("t.initial", "").alias("initials"),
        F.array_join("t.code", "").alias("code"))

    kind = _segment_type(turns.schema["conv"].dataType)
    solved = stage(segments.mapInArrow(_solve(costs), kind), "repairs")
    done = solved.where("audit is not null")
    longest = solved.agg(F.max("segment")).first()[0]
    if longest is not None and solved.where("audit is null").limit(1).count():
        rest = solved.where("audit is null")
        while True:  # as many rounds as the longest conversation has powers of FAN_IN segments
            longest //= FAN_IN
            key = F.floor(F.col("segment") / F.lit(FAN_IN)).alias("_group")
            rest = rest.groupBy("conv", key).applyInArrow(_compose(costs, longest == 0), kind)
            if longest == 0:
                break
        done = done.unionByName(rest)

    spans = judged.groupBy("conv").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0))
        .cast("long").alias("gaps")).select(F.col("conv").alias("_conv"), "gaps")
    return done.join(spans, done["conv"].eqNullSafe(spans["_conv"])).select(
        F.col("conv").alias(id_col), "gaps", *_SUMS, "cost", "audit")


def _apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows by conversation, each led by its audit: the turns that come of it, in order. ``state``
    and the place in the audit are carried from batch to batch."""
    audit, at, state, place = "", 0, START, 0
    for batch in batches:
        names, conv, out = batch.schema.names, [], {"place": [], "role": [], "text": []}
        columns = {c: batch.column(c).to_pylist() for c in names if c != "conv"}

        def put(row: int, role: str, text: str) -> None:
            nonlocal place
            conv.append(row)
            for column, value in zip(out.values(), (place, role, text)):
                column.append(value)
            place += 1

        for row in range(batch.num_rows):
            if columns["audit"][row] is not None:
                audit, at, state, place = columns["audit"][row], 0, START, 0
            else:
                edit, role = audit[at], columns["role"][row]
                at += 1
                if edit in "KR":
                    state = MADE[state] if edit == "R" else KEPT[state, role[0]]
                    put(row, role if edit == "K" else ROLE[state], columns["text"][row])
            while at < len(audit) and audit[at] == "I":
                at, state = at + 1, MADE[state]
                put(row, ROLE[state], "")
        yield pa.RecordBatch.from_arrays(
            [batch.column("conv").take(pa.array(conv, pa.int64())), pa.array(out["place"], pa.int64()),
             pa.array(out["role"], pa.string()), pa.array(out["text"], pa.string())],
            ["conv", *out])


def repaired_turns(
    conversations: DataFrame, repairs: DataFrame, id_col: str = "conv_id",
    turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
) -> DataFrame:
    """The repaired conversations: conv, place (from 0), role, text. ``repairs`` is what
    ``plan_repairs`` gave for the same rows.

    The turns of a conversation follow each other, in order, in one partition; they stream through
    the task, which holds one batch and one audit. Conversations of which nothing is left give no
    rows.
    """
    turns = _turns(conversations, id_col, turn_col, role_col, text_col)
    none = F.lit(None)
    led = repairs.select(
        F.col(id_col).alias("conv"), "audit", none.cast(turns.schema["turn"].dataType).alias("turn"),
        none.cast("string").alias("role"), none.cast("string").alias("text"))
    both = led.unionByName(turns.withColumn("audit", none.cast("string")))
    kind = T.StructType([
        turns.schema["conv"], T.StructField("place", T.LongType()),
        T.StructField("role", T.StringType()), T.StructField("text", T.StringType())])
    return both.repartition("conv").sortWithinPartitions(
        F.asc("conv"), F.desc_nulls_last("audit"), *_order(F.unhex(F.md5("text")))
    ).select("conv", "audit", "role", "text").mapInArrow(_apply, kind)


def _hash(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import hashlib

    running, current = None, None
    kind: pa.DataType | None = None

    def told() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([current], kind), pa.array([running.hexdigest()])], ["conv", "sha256"])

    for batch in batches:
        kind = batch.schema.field("conv").type
        for conv, place, role, text in zip(*[c.to_pylist() for c in batch.columns]):
            if place == 0:
                if running is not None:
                    yield told()
                running, current = hashlib.sha256(), conv
            else:
                running.update(b"\n")
            running.update(f"{role}:{text}".encode())
    if running is not None:
        yield told()


def transcript_digests(turns: DataFrame) -> DataFrame:
    """conv, sha256 of the lines ``role:text`` of each conversation of ``repaired_turns``. SHA-256
    is sequential, so a conversation is one stream, but only its hash state is held."""
    return turns.mapInArrow(_hash, T.StructType(
        [turns.schema["conv"], T.StructField("sha256", T.StringType())]))


def damage(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text of ``conversations`` with planted faults: by the CRC-32 of
    ``conv_id:turn`` modulo 20, 0 drops a row, 1 empties its text, 2 removes ``.!?`` from it, 3
    repeats it, 4 makes its role user. A NULL counts as one space in the number, role and text."""
    def told(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(told("conv_id"), F.lit(":"), told("turn")).cast("binary")) % 20
    rows = conversations.select("conv_id", "turn", told("role").alias("role"),
                                told("text").alias("text"), kind.alias("kind"))
    text = F.when(F.col("kind") == 1, F.lit("")).when(
        F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    copies = F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.where("kind != 0").select(
        "conv_id", "turn",
        F.when(F.col("kind") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        text.alias("text"), F.explode(copies).alias("_copy")).drop("_copy")
