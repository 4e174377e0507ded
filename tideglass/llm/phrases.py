"""Phrase collocation mining by dynamic itemset counting (operator 12).

The corpus is dealt into ``SHARDS`` shards of chunks, and the shards are scanned in a cycle. All words
are counted from the first scan on. A longer phrase becomes active after the scan in which both its
subphrases (all but the last word, all but the first) have reached the threshold, and is counted for
one full cycle from there: every shard once, so its count is exact. Lengths are counted side by side;
a phrase below the threshold at the end of its cycle is dropped. No phrase that reaches the threshold
is missed, as its subphrases occur at least as often.

- A *chunk* is a run of consecutive texts as numbers of its own words, 0 between pieces.
- A phrase that has reached the threshold gets a 64-bit number. A longer phrase is the pair of the
  numbers of its subphrases, so that counting and joining know pairs of numbers, not texts.
- Pairs are dealt by hash into *parts*, whose number follows the number of words. A scan of a shard
  takes, length by length, the phrases that the chunk is known to hold, and sends each distinct
  active pair once a chunk, with its count, as one compressed block a part.
- A part adds the blocks of a scan to its state: pairs in their cycle, and phrases that have reached
  the threshold. Joined with what a chunk has sent, the state tells the chunk what it holds.

What is kept between scans are written tables. The driver holds counts of rows only. Pairs are told
apart by their two numbers; hashes only deal them to parts and find them.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tideglass.llm import texts
from tideglass.llm.chunks import pack, unpack
from tideglass.sources.workspace import fresh_folder, remove_folder

SHARDS = 2
CHUNK_BYTES = 12_000_000
LENGTHS = 4
THRESHOLD = 30
PART_WORDS = 3_000_000  # of the corpus, for each part; about a third as many pairs are in a cycle

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32
_WORD, _SPACE, _BREAK = 0, 1, 2
_CLASS = np.zeros(256, dtype=np.uint8)
_CLASS[[0x20, 0x09]] = _SPACE
_CLASS[[*b".,;:!?", 0x0A, 0x0B, 0x0C, 0x0D]] = _BREAK


def tokens(data: np.ndarray, bounds: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The words of texts, the text of each, and which of them begin a piece."""
    kind = _CLASS[data]
    inside = np.zeros(len(data) + 2, dtype=bool)
    inside[1:-1] = kind == _WORD
    first = np.zeros(len(data) + 1, dtype=bool)
    first[bounds] = True
    starts = np.flatnonzero(inside[1:] & (~inside[:-1] | first))
    ends = np.flatnonzero(inside[:-1] & (~inside[1:] | first))
    offsets = np.zeros(len(starts) + 1, dtype=np.int64)
    np.cumsum(ends - starts, out=offsets[1:])
    letters = _LOWER[data[inside[1:-1]]]
    words = pa.LargeStringArray.from_buffers(
        len(starts), pa.py_buffer(offsets), pa.py_buffer(letters))
    text = np.searchsorted(bounds, starts, "right") - 1
    breaks = np.cumsum(kind == _BREAK)[starts] if len(starts) else starts
    begins = np.ones(len(starts), dtype=bool)
    begins[1:] = (np.diff(text) != 0) | (np.diff(breaks) != 0)
    return words, text, begins


def _cut(chunk_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = TaskContext.get().partitionId() << 32
        langs: dict[str, int] = {}
        held: list[tuple[pa.Array, np.ndarray, np.ndarray]] = []
        size = 0

        def row() -> pa.RecordBatch:
            words = pa.chunked_array([h[0] for h in held]).combine_chunks()
            words = words.chunk(0) if isinstance(words, pa.ChunkedArray) else words
            lang, begins = (np.concatenate([h[k] for h in held]) for k in (1, 2))
            coded = words.dictionary_encode()
            both = np.asarray(coded.indices).astype(np.int64) * len(langs) + lang
            if len(coded.dictionary) * len(langs) <= len(both):  # few enough for a count each
                times = np.bincount(both)
                known = np.flatnonzero(times)
                number, times = (np.cumsum(times > 0) - 1)[both], times[known]
            else:
                known, number, times = np.unique(both, return_inverse=True, return_counts=True)
            sequence = np.zeros(len(number) + int(begins.sum()), dtype=np.uint32)
            sequence[np.arange(len(number)) + np.cumsum(begins)] = number + 1
            names = pa.array(list(langs), pa.string())
            vocabulary = pa.StructArray.from_arrays(
                [pa.array(np.arange(1, len(known) + 1)), names.take(pa.array(known % len(langs))),
                 coded.dictionary.take(pa.array(known // len(langs))).cast(pa.string()),
                 pa.array(times.astype(np.int64))], ["no", "lang", "word", "n"])
            return pa.RecordBatch.from_arrays(
                [pa.array([chunk], pa.int64()), pa.array([pack(sequence)], pa.binary()),
                 pa.ListArray.from_arrays(pa.array([0, len(known)], pa.int32()), vocabulary)],
                ["chunk", "payload", "words"])

        for part in texts.slices(batches, 0, min(chunk_bytes, texts.SLICE_BYTES)):
            data, bounds = texts.utf8(part.column(0))
            words, text, begins = tokens(data, bounds)
            codes = np.array([langs.setdefault(x, len(langs)) for x in part.column(1).to_pylist()])
            held.append((words, codes[text] if len(text) else text, begins))
            size += len(data) + 8 * part.num_rows
            if size >= chunk_bytes:
                if sum(map(len, (h[0] for h in held))):
                    yield row()
                held, size, chunk, langs = [], 0, chunk + 1, {}
        if sum(map(len, (h[0] for h in held))):
            yield row()

    return run


class _Sequence:
    """The phrases of a chunk by the place of their first word, length by length.

    ``ids`` (ascending) and ``steps`` are of the phrases of the length that the chunk is known to
    hold; ``local`` has the index in them of the phrase at each place, -1 for none.
    """

    def __init__(self, payload: bytes) -> None:
        self.numbers = unpack(payload).astype(np.int64)
        self.ids = self.steps = self.local = np.zeros(0, np.int64)

    def begin(self, number: np.ndarray, ids: np.ndarray, steps: np.ndarray) -> None:
        """Puts in the ids of the words that have reached the threshold, and when they did."""
        table = np.full(int(self.numbers.max(initial=0)) + 1, -1, dtype=np.int64)
        by_id = np.argsort(ids)
        table[number[by_id]] = np.arange(len(number))
        self.ids, self.steps, self.local = ids[by_id], steps[by_id], table[self.numbers]

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """Places where phrases of the next length can be: (place, pair code)."""
        at = np.flatnonzero((self.local[:-1] >= 0) & (self.local[1:] >= 0))
        return at, self.local[at] * len(self.ids) + self.local[at + 1]

    def lengthen(self, left: np.ndarray, right: np.ndarray, ids: np.ndarray,
                 steps: np.ndarray) -> None:
        """From phrases of one length to those of the next that have reached the threshold."""
        at, code = self.pairs()
        size, local = len(self.ids), np.full(len(self.local), -1, dtype=np.int64)
        here = told = np.zeros(0, np.int64)
        if size:
            sides = [np.minimum(np.searchsorted(self.ids, x), size - 1) for x in (left, right)]
            here = np.flatnonzero((self.ids[sides[0]] == left) & (self.ids[sides[1]] == right))
            here = here[np.argsort(ids[here])]
            told = sides[0][here] * size + sides[1][here]
        order = np.argsort(told)
        if len(told) and len(at):
            where = np.minimum(np.searchsorted(told[order], code), len(told) - 1)
            hit = told[order][where] == code
            local[at[hit]] = order[where[hit]]
        self.ids, self.steps, self.local = ids[here], steps[here], local


_PAIR = ["left", "right"]


def _pack(values: np.ndarray) -> bytes:
    """64-bit numbers as compressed byte planes; those of small numbers are mostly zero."""
    planes = np.ascontiguousarray(values.astype("<i8")).view(np.uint8).reshape(-1, 8).T
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def _unpack(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    return np.ascontiguousarray(planes.reshape(8, -1).T).view("<i8").ravel()


def _columns(table: pa.Table, names: list[str]) -> list[np.ndarray]:
    """The numbers of packed columns, all rows' one after the other."""
    return [np.concatenate([np.zeros(0, np.int64), *map(_unpack, table[c].to_pylist())]) for c in names]


def _row(packed: dict[str, np.ndarray], **plain: int) -> dict[str, object]:
    return plain | {c: _pack(v) for c, v in packed.items()}


def _spread(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return texts.mix(left.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + right.astype(np.uint64))


_SENT = "part int, chunk long, left binary, right binary, start binary, n binary"
_STATE = ("part int, fresh long, left binary, right binary, start binary, n binary, step binary, "
          "id binary")
_KNOWN = "chunk long, length int, left binary, right binary, id binary, step binary"
_BINARY = {c: pa.binary() for c in ("left", "right", "start", "n", "step", "id")}
_ARROW = {"part": pa.int32(), "chunk": pa.int64(), "fresh": pa.int64(), "length": pa.int32()} | _BINARY


def _table(rows: list[dict[str, object]], kind: str) -> pa.Table:
    names = [c.split()[0] for c in kind.split(", ")]
    return pa.Table.from_pylist(rows, pa.schema([(c, _ARROW[c]) for c in names]))


def _order(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The order by ``left``, then ``right``. The fields of phrase numbers (scan and length, part,
    number in the part) seldom need all their bits; where those of both sides fit one number, that
    is sorted, which takes half the time."""
    code, used = np.zeros(len(left), np.int64), 0
    for side in (right, left) if len(left) else ():
        for low, width in ((0, 33), (33, 20), (53, 11)):
            field = (side >> low) & ((1 << width) - 1)
            least = int(field.min())
            bits = (int(field.max()) - least).bit_length()
            if used + bits > 63:
                return np.lexsort((right, left))
            code |= (field - least) << used
            used += bits
    return np.argsort(code)


def _scan(length: int, step: int, shards: int, parts: int):
    """A chunk and what is known of it: the active pairs of ``length``, a block for each part."""
    def run(chunks: pa.Table, known: pa.Table) -> pa.Table:
        out: list[dict[str, object]] = []
        if chunks.num_rows and known.num_rows:
            held, level = _Sequence(chunks["payload"][0].as_py()), np.asarray(known["length"])
            for k in range(1, length):
                left, right, ids, steps = _columns(
                    known.filter(pa.array(level == k)), [*_PAIR, "id", "step"])
                if k == 1:
                    held.begin(left, ids, steps)
                else:
                    held.lengthen(left, right, ids, steps)
            pair, times = np.unique(held.pairs()[1], return_counts=True)
            left, right = pair // max(len(held.ids), 1), pair % max(len(held.ids), 1)
            start = np.maximum(held.steps[left], held.steps[right]) + 1
            active = (start <= step) & (step < start + shards)
            cells = {"left": held.ids[left[active]], "right": held.ids[right[active]],
                     "start": start[active], "n": times[active]}
            part = (_spread(cells["left"], cells["right"]) % np.uint64(parts)).astype(
                np.uint16 if parts <= 1 << 16 else np.int64)  # few values sort faster as short ones
            order = np.argsort(part, kind="stable")
            cuts = np.searchsorted(part[order], np.arange(parts + 1))
            for p in np.flatnonzero(np.diff(cuts)).tolist():
                at = order[cuts[p]:cuts[p + 1]]
                out.append(_row({c: v[at] for c, v in cells.items()}, part=p,
                                chunk=chunks["chunk"][0].as_py()))
        return _table(out, _SENT)

    return run


def _settle(length: int, step: int, shards: int, threshold: int):
    """A part's state and the blocks of a scan: the state after it. ``fresh`` phrases are new at
    the threshold; pairs whose cycle has ended below it are gone."""
    def run(state: pa.Table, sent: pa.Table) -> pa.Table:
        if not state.num_rows + sent.num_rows:
            return _table([], _STATE)
        part = (state if state.num_rows else sent)["part"][0].as_py()
        names = [*_PAIR, "start", "n"]
        new = _columns(sent, names)
        none = np.full(len(new[0]), -1, dtype=np.int64)
        left, right, start, n, when, ids = map(np.concatenate, zip(
            _columns(state, [*names, "step", "id"]), [*new, none, none]))
        order = _order(left, right)
        left, right = left[order], right[order]
        first = np.ones(len(left), dtype=bool)
        first[1:] = (left[1:] != left[:-1]) | (right[1:] != right[:-1])
        at = np.flatnonzero(first)
        n = np.add.reduceat(n[order], at)
        start, when, ids = (np.maximum.reduceat(x[order], at) for x in (start, when, ids))
        fresh = (when < 0) & (n >= threshold)
        # A number no other phrase has: of scan and length, of part, in the part.
        base = ((step * 8 + length) << 53) + (part << 33)
        ids[fresh], when[fresh] = base + np.arange(int(fresh.sum())), step
        stays = (when >= 0) | (start + shards - 1 > step)
        cells = {"left": left[at], "right": right[at], "start": start, "n": n, "step": when, "id": ids}
        return _table([_row({c: v[stays] for c, v in cells.items()}, part=part,
                            fresh=int(fresh.sum()))], _STATE)

    return run


def _tell(length: int, before: int):
    """A part's state and what chunks have sent: what each chunk holds of the phrases that were at
    the threshold before this scan."""
    def run(state: pa.Table, sent: pa.Table) -> pa.Table:
        out: list[dict[str, object]] = []
        if state.num_rows and sent.num_rows:
            left, right, ids, when = _columns(state, [*_PAIR, "id", "step"])
            there = (when >= 0) & (when < before)
            hashes = _spread(left[there], right[there])
            order = np.argsort(hashes)
            hashes = hashes[order]
            left, right, ids, when = (x[there][order] for x in (left, right, ids, when))
            # One, unless phrases share a hash; then all that share it are compared.
            alike = int(np.unique(hashes, return_counts=True)[1].max(initial=0))
            for row in range(sent.num_rows if len(hashes) else 0):
                a, b = _columns(sent.slice(row, 1), _PAIR)
                own = _spread(a, b)
                place = np.searchsorted(hashes, own)
                for k in range(alike):
                    at = np.minimum(place + k, len(hashes) - 1)
                    hit = at[(left[at] == a) & (right[at] == b)]
                    if len(hit):
                        out.append(_row({"left": left[hit], "right": right[hit], "id": ids[hit],
                                         "step": when[hit]}, length=length,
                                        chunk=sent["chunk"][row].as_py()))
        return _table(out, _KNOWN)

    return run


def _tell_words(rows: pa.Table) -> pa.Table:
    """The words of a chunk that have reached the threshold, as one block."""
    number, ids, when = (np.asarray(rows[c]).astype(np.int64) for c in ("no", "id", "step"))
    return _table([_row({"left": number, "right": np.zeros(len(number), np.int64), "id": ids,
                         "step": when}, length=1, chunk=rows["chunk"][0].as_py())], _KNOWN)


def _phrases(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """States as rows: the phrases at the threshold."""
    for batch in batches:
        for row in range(batch.num_rows):
            cells = _columns(pa.Table.from_batches([batch.slice(row, 1)]), [*_PAIR, "id", "n", "step"])
            yield pa.RecordBatch.from_arrays(
                [pa.array(c[cells[-1] >= 0]) for c in cells[:-1]], [*_PAIR, "id", "n"])


class _Tables:
    """Written tables of one run. ``keep`` replaces a table of a name and deletes the one before,
    which no later step reads; ``drop_all`` deletes what is left but the named ones."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark, self.folders = spark, {}

    def keep(self, name: str, df: DataFrame) -> DataFrame:
        folder = fresh_folder(self.spark, "phrases")
        df.write.parquet(folder)
        old, self.folders[name] = self.folders.get(name), folder
        if old:
            remove_folder(self.spark, old)
        return self.spark.read.schema(df.schema).parquet(folder)

    def drop_all(self, but: str) -> None:
        for name, folder in self.folders.items():
            if name != but:
                remove_folder(self.spark, folder)


def count_phrases(
    documents: DataFrame, threshold: int = THRESHOLD, shards: int = SHARDS, lengths: int = LENGTHS,
    text_col: str = "text", lang_col: str = "lang", chunk_bytes: int = CHUNK_BYTES,
) -> DataFrame:
    """Every phrase of 1 to ``lengths`` words that occurs ``threshold`` times or more in its
    language, with its exact count: id, length, lang, phrase, n, left and right (ids of its
    subphrases), heads and tails (counts of its first 1, 2, ... and last 1, 2, ... words, the last
    entry its own), total (all words of the language, in whatever phrase).

    A-Z are lower-cased; pieces end at ``.,;:!?`` and line ends, words at spaces and tabs. A NULL
    text is empty, a NULL language ``und``. Repeated rows count as often as they occur; other
    columns play no part. An empty table, or one without frequent words, gives no rows.
    """
    spark = documents.sparkSession
    written = _Tables(spark)
    given = documents.select(
        F.col(text_col).cast("string").alias("text"),
        F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"))
    chunks = written.keep("chunks", given.mapInArrow(
        _cut(chunk_bytes), "chunk long, payload binary, "
        "words array<struct<no:long,lang:string,word:string,n:long>>").withColumn(
        "shard", F.pmod(F.xxhash64("chunk"), F.lit(shards)).cast("int")))
    # Read by itself, as it meets the chunks again in the scans.
    words = spark.read.schema(chunks.schema).parquet(written.folders["chunks"]).select(
        "shard", "chunk", F.inline("words"))

    size = words.agg(F.sum("n")).first()[0] or 0
    parts = max(1, -(-size // PART_WORDS))
    state: dict[int, DataFrame] = {}                # by length
    new: defaultdict[tuple[int, int], int] = defaultdict(int)  # how many, by (length, scan)
    # What chunks have sent and is not settled, by (shard, length) and scan.
    sent: defaultdict[tuple[int, int], dict[int, DataFrame]] = defaultdict(dict)
    none = spark.createDataFrame([], _STATE)

    def settle_words(step: int) -> None:
        """A word's cycle begins with the first scan."""
        counted = words.where(F.col("shard") == step).select("lang", "word", "n")
        for c in ("step", "id"):
            counted = counted.withColumn(c, F.lit(None).cast("long"))
        known = counted.unionByName(state[1]) if 1 in state else counted
        reaches = F.col("step").isNull() & (F.col("n") >= threshold)
        number = F.lit((step * 8 + 1) << 53) + F.monotonically_increasing_id()
        state[1] = written.keep("words", known.groupBy("lang", "word").agg(
            *[f(c).alias(c) for c, f in (("n", F.sum), ("step", F.max), ("id", F.max))]
        ).withColumn("id", F.when(reaches, number).otherwise(F.col("id"))).withColumn(
            "step", F.when(reaches, F.lit(step).cast("long")).otherwise(F.col("step"))))
        new[1, step] = state[1].where(F.col("step") == step).count()

    settled: defaultdict[tuple[int, int], list[DataFrame]] = defaultdict(list)

    def tell(length: int, step: int, held: DataFrame) -> DataFrame:
        return state[length].groupBy("part").cogroup(
            held.select("part", "chunk", *_PAIR).groupBy("part")).applyInArrow(
            _tell(length, step), _KNOWN)

    def known(shard: int, length: int, step: int) -> DataFrame:
        """What each chunk of the shard holds of the phrases at the threshold before this scan.

        What was sent a cycle ago or earlier is settled: its pairs have ended their cycles, and
        what it told of them stands from then on. So do all words after the first cycle.
        """
        if length == 1:
            if not settled[shard, 1]:
                table = state[1].where(F.col("step") < step).drop("n")
                told = written.keep(f"words of {shard}", words.where(F.col("shard") == shard).join(
                    table, ["lang", "word"]).select("chunk", "no", "id", "step").groupBy(
                    "chunk").applyInArrow(_tell_words, _KNOWN))
                if step < shards:
                    return told
                settled[shard, 1].append(told)
            return settled[shard, 1][0]
        for at in sorted(s for s in sent[shard, length] if s < step):
            settled[shard, length].append(written.keep(
                f"settled {shard} {length} {at}", tell(length, step, sent[shard, length].pop(at))))
        tables = list(settled[shard, length])
        if step in sent[shard, length]:
            tables.append(written.keep(f"known {length}", tell(length, step, sent[shard, length][step])))
        return reduce(DataFrame.unionByName, tables)

    def live(length: int, step: int) -> bool:
        """Whether a phrase of ``length`` may be in its cycle at this scan."""
        return any(new[length - 1, s] for s in range(step - shards, step))

    step = 0
    while step < shards or any(live(k, s) for k in range(2, lengths + 1)
                               for s in range(step, step + shards)):
        shard, counted = step % shards, {}
        active = [k for k in range(2, lengths + 1) if live(k, step)]
        told: list[DataFrame] = []
        for length in range(2, max(active, default=1) + 1):
            if length > 2 and (length - 1 not in state or not (
                    sent[shard, length - 1] or settled[shard, length - 1])):
                break
            told.append(known(shard, length - 1, step))
            if length in active:
                counted[length] = written.keep(f"sent {shard} {length} {step}", chunks.where(
                    F.col("shard") == shard).select("chunk", "payload").groupBy("chunk").cogroup(
                    reduce(DataFrame.unionByName, told).groupBy("chunk")).applyInArrow(
                    _scan(length, step, shards, parts), _SENT))
                sent[shard, length][step] = counted[length]
        if step < shards:
            settle_words(step)
        for length, blocks in counted.items():
            state[length] = written.keep(f"state {length}", state.get(length, none).groupBy(
                "part").cogroup(blocks.groupBy("part")).applyInArrow(
                _settle(length, step, shards, threshold), _STATE))
            new[length, step] = state[length].agg(F.sum("fresh")).first()[0] or 0
        step += 1

    total = words.groupBy("lang").agg(F.sum("n").alias("total"))
    heads = F.array(F.col("n"))
    named = {1: state[1].where("step is not null").select(
        "id", F.lit(1).alias("length"), "lang", F.col("word").alias("phrase"), "n",
        *[F.lit(None).cast("long").alias(c) for c in _PAIR], heads.alias("heads"),
        heads.alias("tails"), F.col("word").alias("last"))}
    for length in range(2, lengths + 1):
        if length not in state:
            break
        first = named[length - 1].select(F.col("id").alias("left"), "lang", "phrase", "heads")
        rest = named[length - 1].select(F.col("id").alias("right"), "tails", "last")
        named[length] = state[length].mapInArrow(
            _phrases, "left long, right long, id long, n long").join(first, "left").join(
            rest, "right").select(
            "id", F.lit(length).alias("length"), "lang",
            F.concat_ws(" ", "phrase", "last").alias("phrase"), "n", *_PAIR,
            F.concat("heads", F.array("n")).alias("heads"),
            F.concat("tails", F.array("n")).alias("tails"), "last")
    result = written.keep("result", reduce(DataFrame.unionByName, named.values()).drop("last").join(
        total, "lang"))
    written.drop_all(but="result")
    return result


def collocations(
    documents: DataFrame, most: int = 2000, threshold: int = THRESHOLD, cover: int = 80,
    shards: int = SHARDS, lengths: int = LENGTHS, text_col: str = "text", lang_col: str = "lang",
    chunk_bytes: int = CHUNK_BYTES,
) -> DataFrame:
    """The best phrases of two words or more of each language: lang, rank, phrase, a, l, r, n, score.

    ``a``, ``l``, ``r`` are the counts of the phrase and of the two parts at its lowest-scoring cut,
    ``n`` all words of the language, score ``floor(2000000 a / (l + r))``; of equally low cuts the
    first. A phrase is left out if a phrase one word longer holds it and occurs at least ``cover``
    percent as often (one still longer occurs no oftener than the one between). Order: score and a
    descending, phrase by UTF-8 bytes; the first ``most`` of a language. Edge cases as in
    ``count_phrases``.
    """
    counted = count_phrases(
        documents, threshold, shards, lengths, text_col, lang_col, chunk_bytes)
    longer = counted.where("length > 2").select(F.explode(F.array(*_PAIR)).alias("id"), "n") \
        .groupBy("id").agg(F.max("n").alias("longest"))
    big = "decimal(38,0)"
    cuts = F.expr(f"""
        transform(sequence(1, length - 1), k -> named_struct(
            'score', (cast(2000000 as decimal(7,0)) * cast(n as decimal(19,0)))
                     div (cast(heads[k - 1] as decimal(19,0)) + cast(tails[length - k - 1] as decimal(19,0))),
            'k', k, 'l', heads[k - 1], 'r', tails[length - k - 1]))""")
    covered = F.lit(100).cast(big) * F.col("longest").cast("decimal(19,0)") \
        >= F.lit(cover).cast(big) * F.col("n").cast("decimal(19,0)")
    scored = counted.where("length > 1").join(longer, "id", "left").where(
        F.col("longest").isNull() | ~covered
    ).select("lang", "phrase", F.col("n").alias("a"), "total", F.array_min(cuts).alias("cut")).select(
        "lang", "phrase", "a", "cut.l", "cut.r", F.col("total").alias("n"),
        F.col("cut.score").cast("long").alias("score"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(
        F.desc("score"), F.desc("a"), F.asc("phrase")))
    return scored.withColumn("rank", place.cast("long")).where(F.col("rank") <= most) \
        .select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
