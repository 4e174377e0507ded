"""Secret scans by grammar inference (operator 7).

Three patterns give the base spans. Their values are labelled credentials: from a bounded sample
of SAMPLE distinct values a kind, the driver infers a probabilistic automaton a kind by merging
the statistically compatible states of their prefix tree (Hoeffding bound). Every other run
of credential characters that mixes letters and digits, what base spans leave of a run included,
is a candidate from the least length of a labelled value on; it is a secret of kind
``format`` if the best automaton gives it MIN_GAIN bits a character more than a chain of symbol
pairs counted over all candidates of the corpus.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tideglass.llm import texts
from tideglass.llm.mixing import id_hash

KINDS = ("assign", "access", "hex", "format")
SAMPLE = 400
ALPHA = 0.05
SMOOTHING = 0.02
MIN_GAIN = 0.75
SYMBOLS = "dalAL+/_.=-"  # digit, a-f, g-z, A-F, G-Z, and six signs as they are
END = "$"

# Fixed patterns and least lengths of the base scan.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # a maximal run, so the same as dropping short runs
ASSIGN_VALUE, ACCESS_LENGTH = 6, 20

#: A maximal run with a digit.
CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/_.=-])[A-Za-z+/_.=-]*+[0-9][A-Za-z0-9+/_.=-]*+")
_DIGIT, _LETTER = re.compile("[0-9]"), re.compile("[A-Za-z]")
_CLASS = str.maketrans({
    **dict.fromkeys("0123456789", "d"), **dict.fromkeys("abcdef", "a"),
    **dict.fromkeys("ghijklmnopqrstuvwxyz", "l"), **dict.fromkeys("ABCDEF", "A"),
    **dict.fromkeys("GHIJKLMNOPQRSTUVWXYZ", "L")})


def base_spans(text: str) -> list[tuple[int, int, int, str]]:
    """(start, kind number, end, value) of the three patterns, in order."""
    found = [(m.start(), 0, m.end(), m[2]) for m in ASSIGN.finditer(text)
             if len(m[2]) >= ASSIGN_VALUE]
    found += [(m.start(), 1, m.end(), m[0]) for m in ACCESS.finditer(text)
              if m.end() - m.start() >= ACCESS_LENGTH]
    found += [(m.start(), 2, m.end(), m[0]) for m in HEX.finditer(text)]
    return sorted(found)


def _rest(text: str, base: list[tuple[int, int, int, str]]) -> Iterator[tuple[int, int]]:
    """(start, end) of what the base spans leave of each run with a digit."""
    cover: list[list[int]] = []
    for a, _, b, _ in base:
        if cover and a <= cover[-1][1]:
            cover[-1][1] = max(cover[-1][1], b)
        else:
            cover.append([a, b])
    k = 0
    for m in CANDIDATE.finditer(text):
        at, end = m.span()
        while k < len(cover) and cover[k][0] < end:
            if cover[k][1] > at:
                yield at, cover[k][0]
                at = cover[k][1]
            if at > end:
                break  # the span goes on behind this run
            k += 1
        yield at, end


def candidates(text: str, base: list[tuple[int, int, int, str]]) -> Iterator[tuple[int, int, str]]:
    """(start, end, symbol classes) of the runs, or parts of runs, outside all base spans."""
    for a, b in _rest(text, base):
        run = text[a:b] if b - a >= ASSIGN_VALUE else ""
        if _DIGIT.search(run) and _LETTER.search(run):
            yield a, b, run.translate(_CLASS)


@dataclass
class State:
    count: int = 0
    ends: int = 0
    next: dict[str, State] = field(default_factory=dict)

    def share(self, symbol: str) -> float:
        if symbol == END:
            return self.ends / self.count
        return self.next[symbol].passed / self.count if symbol in self.next else 0.0


@dataclass
class Edge:
    passed: int
    to: State


def prefix_tree(values: Iterable[str]) -> State:
    root = State()
    for value in values:
        state = root
        state.count += 1
        for symbol in value:
            edge = state.next.setdefault(symbol, Edge(0, State()))
            edge.passed += 1
            state = edge.to
            state.count += 1
        state.ends += 1
    return root


def _compatible(one: State, two: State) -> bool:
    """Whether no share of the two states, or of the states both lead to, differs significantly."""
    todo = [(one, two)]
    while todo:
        a, b = todo.pop()
        if not a.count or not b.count:
            continue
        bound = math.sqrt(0.5 * math.log(2 / ALPHA)) * (a.count ** -0.5 + b.count ** -0.5)
        if bound >= 1:
            continue  # too few strings for any difference, here and further on
        for symbol in {END, *a.next, *b.next}:
            if abs(a.share(symbol) - b.share(symbol)) > bound:
                return False
        todo += [(a.next[s].to, b.next[s].to) for s in a.next if s in b.next]
    return True


def _fold(into: State, tree: State) -> None:
    todo = [(into, tree)]
    while todo:
        a, b = todo.pop()
        a.count += b.count
        a.ends += b.ends
        for symbol, edge in b.next.items():
            if symbol in a.next:
                a.next[symbol].passed += edge.passed
                todo.append((a.next[symbol].to, edge.to))
            else:
                a.next[symbol] = edge


def infer(values: Iterable[str]) -> State:
    """The automaton of the values: states reachable from merged ones are tried in order of their
    number of strings; each is merged with the first compatible state or kept."""
    root = prefix_tree(sorted(values))
    kept = [root]
    while True:
        known = {id(s) for s in kept}
        border = [(-e.to.count, k, symbol, e) for k, s in enumerate(kept)
                  for symbol, e in s.next.items() if id(e.to) not in known]
        if not border:
            return root
        _, _, _, edge = min(border, key=lambda x: x[:3])
        tree = edge.to
        for state in kept:
            if _compatible(state, tree):
                edge.to = state
                _fold(state, tree)
                break
        else:
            kept.append(tree)


def bits(root: State, value: str) -> float:
    """log2 of the likelihood of a string; unseen steps have a share of SMOOTHING."""
    state, total, floor = root, 0.0, SMOOTHING / (len(SYMBOLS) + 1)
    for symbol in value + END:
        share = state.share(symbol) if state is not None and state.count else 0.0
        total += math.log2((1 - SMOOTHING) * share + floor)
        if symbol != END and state is not None:
            edge = state.next.get(symbol)
            state = edge.to if edge else None
    return total


@dataclass
class Grammar:
    """The automata by kind, and bits of each pair of neighbouring symbols in the background."""

    automata: dict[str, State]
    background: dict[str, float]

    def gain(self, value: str) -> float:
        """Bits a character by which the best automaton beats the background."""
        if not self.automata:
            return -math.inf
        unseen = -math.log2(len(SYMBOLS) + 1)
        chain = "^" + value + END
        base = sum(self.background.get(chain[k:k + 2], unseen) for k in range(len(chain) - 1))
        return (max(bits(a, value) for a in self.automata.values()) - base) / len(value)


def all_spans(text: str, grammar: Grammar) -> list[tuple[int, int, int]]:
    """(start, kind number, end), ordered by start and then kind."""
    base = base_spans(text)
    extra = [(a, 3, b) for a, b, value in candidates(text, base)
             if grammar.gain(value) >= MIN_GAIN]
    return sorted([x[:3] for x in base] + extra)


def _learn_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (kind, value, n): each base value with its kind; under kind "pair", how often two
    symbols stand side by side in the candidates of a slice."""
    for part in texts.slices(batches, 0):
        rows, pairs = Counter(), Counter()
        for text in part.column(0).to_pylist():
            if not text:
                continue
            base = base_spans(text)
            rows.update((KINDS[k], value.translate(_CLASS)) for _, k, _, value in base)
            for _, _, value in candidates(text, base):
                chain = "^" + value + END
                pairs.update(chain[k:k + 2] for k in range(len(chain) - 1))
        rows.update({("pair", p): n for p, n in pairs.items()})
        yield pa.RecordBatch.from_arrays(
            [pa.array([k for k, _ in rows], pa.string()), pa.array([v for _, v in rows], pa.string()),
             pa.array(list(rows.values()), pa.int64())], ["kind", "value", "n"])


def learn(docs: DataFrame, text_col: str = "text") -> Grammar:
    """The grammar of a corpus. Pairs are counted over all candidates (some 140 kinds of pairs);
    at most SAMPLE distinct values a kind, those whose hash is lowest, reach the driver."""
    seen = docs.select(F.col(text_col).alias("text")).mapInArrow(
        _learn_batches, "kind string, value string, n long"
    ).groupBy("kind", "value").agg(F.sum("n").alias("n"))
    lowest = Window.partitionBy("kind").orderBy(id_hash(F.col("value")), "value")
    rows = seen.withColumn("rank", F.row_number().over(lowest)) \
        .where(F.col("rank") <= SAMPLE).collect()
    automata = {
        kind: infer([r.value for r in rows if r.kind == kind])
        for kind in KINDS if any(r.kind == kind for r in rows)}
    pairs = {r.value: r.n for r in rows if r.kind == "pair"}
    after = Counter()
    for pair, n in pairs.items():
        after[pair[0]] += n
    return Grammar(automata, {
        p: math.log2((1 - SMOOTHING) * n / after[p[0]] + SMOOTHING / (len(SYMBOLS) + 1))
        for p, n in pairs.items()})


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 grammar: Grammar | None = None) -> DataFrame:
    """One row a document: doc_id and ``spans``, an array of (kind, start, end) in code points.

    ``grammar`` is learnt from ``docs`` unless given. NULL and empty texts have no spans.
    Repeated rows are scanned each. Spans of different kinds may overlap; a ``format`` span
    overlaps no other. Other columns of ``docs`` play no part.
    """
    shared = docs.sparkSession.sparkContext.broadcast(grammar or learn(docs, text_col))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind_type = pa.list_(pa.struct(
            [("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        for part in texts.slices(batches, 1):
            found = [[{"kind": KINDS[k], "start": a, "end": b}
                      for a, k, b in all_spans(text, shared.value)] if text else []
                     for text in part.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(found, kind_type)], ["doc_id", "spans"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")) \
        .mapInArrow(run, "doc_id long, spans array<struct<kind:string,start:long,end:long>>")


def mask(text: str | None, spans: list[tuple[int, int, int]]) -> str | None:
    """The text with every span, or run of overlapping spans, replaced by one ``[secret]``."""
    if not text or not spans:
        return text
    out, at = [], 0
    for start, _, end in spans:
        if start >= at:
            out += [text[at:start], "[secret]"]
        at = max(at, end)
    return "".join(out) + text[at:]


def mask_secrets(docs: DataFrame, text_col: str = "text",
                 grammar: Grammar | None = None) -> DataFrame:
    """``docs`` with the secrets of ``text_col`` masked; every row and column is kept."""
    shared = docs.sparkSession.sparkContext.broadcast(grammar or learn(docs, text_col))
    position = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in texts.slices(batches, position):
            masked = [mask(t, all_spans(t, shared.value)) if t else t
                      for t in part.column(position).to_pylist()]
            yield part.set_column(position, part.schema.field(position),
                                  pa.array(masked, part.schema.field(position).type))

    return docs.mapInArrow(run, docs.schema)
