"""Stupid-backoff language-model scores of a corpus against itself (operator 2).

The n-grams of a document are scored with the counts of all other documents: the document's own
occurrences are taken off, as otherwise every n-gram would be known. The relations are blocked:

1. Texts become chunks (see ``chunks``) of word sequences. They are made again for step 4 when the
   table is read again, which costs less disk than storing them; both sides carry a digest of the
   chunk, so a table that does not give the same rows in the same order again is an error.
2. Each chunk explodes its n-grams of all orders into distinct 64-bit hashes with counts and deals
   them by hash into parts: the partitions of the count table.
3. A part adds up the counts of all chunks and joins the sums back to every chunk's n-grams.
4. A chunk looks up its occurrences and sums the scores of each document.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from tideglass.llm import texts
from tideglass.llm.chunks import CHUNK_BYTES, by_frequency, pack, unpack

ORDER = 3
ALPHA = 0.4
UNIT = 1_000_000  # scores are summed as whole millionths of log10, so in any order alike


def _pack_sorted(values: np.ndarray) -> bytes:
    """Ascending 64-bit numbers, as byte planes of their differences, compressed."""
    steps = np.diff(values, prepend=np.uint64(0))
    planes = np.ascontiguousarray(steps.astype("<u8")).view(np.uint8).reshape(-1, 8).T
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def _unpack_sorted(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    steps = np.ascontiguousarray(planes.reshape(8, -1).T).view("<u8").ravel()
    return np.cumsum(steps, dtype=np.uint64)


_CHUNK = ("chunk long, check long, part int, words binary, payload binary, doc_ids array<long>, "
          "lengths array<int>")
_OTHER_ROWS = "the table gave other rows, or another order, when read again"


def _check(*held: bytes) -> int:
    """What a chunk holds, as a number: the two readings of a table must agree in it."""
    digest = hashlib.blake2b(digest_size=8)
    for data in held:
        digest.update(len(data).to_bytes(8, "little") + data)
    return int.from_bytes(digest.digest(), "little", signed=True)


def _numbered(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct numbers as they first come, and the place of each value among them."""
    found = pa.array(values).dictionary_encode()
    return found.dictionary.to_numpy(), found.indices.to_numpy()


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    n = sum(len(texts.word_spans(*texts.utf8(part.column(0)))[0]) for part in texts.slices(batches, 0))
    yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], ["n"])


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    chunk = TaskContext.get().partitionId() << 32
    ids, lengths, hashes, size = [], [], [], 0

    def row() -> pa.RecordBatch:
        words, numbers = _numbered(np.concatenate(hashes))
        renamed, order = by_frequency(numbers, len(words))
        known, payload, sizes = words[order].astype("<u8").tobytes(), pack(renamed), np.concatenate(lengths)
        check = _check(known, payload, sizes.astype("<i8").tobytes(), repr(ids).encode())
        return pa.RecordBatch.from_arrays(
            [pa.array([chunk], pa.int64()), pa.array([check], pa.int64()), pa.array([-1], pa.int32()),
             pa.array([known], pa.binary()), pa.array([payload], pa.binary()),
             pa.array([ids], pa.list_(pa.int64())), pa.array([sizes], pa.list_(pa.int32()))],
            ["chunk", "check", "part", "words", "payload", "doc_ids", "lengths"])

    for part in texts.slices(batches, 1):
        data, bounds = texts.utf8(part.column(1))
        found, word_bounds = texts.words(data, bounds)
        ids += part.column(0).to_pylist()
        lengths.append(np.diff(word_bounds))
        hashes.append(found)
        size += len(data) + 8 * part.num_rows
        if size >= CHUNK_BYTES:
            yield row()
            ids, lengths, hashes, size, chunk = [], [], [], 0, chunk + 1
    if ids:
        yield row()


def _grouped(keys: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """(places in the order of keys below ``limit``, those of a key ascending, which of them are the
    first of a key). Key and place are sorted as one number, which costs a fifth of an argsort."""
    bits = len(keys).bit_length()
    if (limit - 1).bit_length() + bits <= 64:
        both = np.sort(keys << bits | np.arange(len(keys), dtype=np.uint64))
        at, ordered = (both & ((1 << bits) - 1)).astype(np.int64), both >> bits
    else:
        at = np.argsort(keys, kind="stable")
        ordered = keys[at]
    first = np.ones(len(keys), dtype=bool)
    first[1:] = ordered[1:] != ordered[:-1]
    return at, first


def _ascending(values: np.ndarray) -> np.ndarray:
    """The order of any 64-bit numbers: their high bits are sorted together with the place, and what
    is alike in these is put right afterwards."""
    bits = len(values).bit_length()
    both = np.sort(values >> bits << bits | np.arange(len(values), dtype=np.uint64))
    at, high = (both & ((1 << bits) - 1)).astype(np.int64), both >> bits
    alike = np.flatnonzero(high[1:] == high[:-1])
    tied = np.union1d(alike, alike + 1)
    at[tied] = at[tied][np.argsort(values[at[tied]], kind="stable")]
    return at


class _Chunk:
    """The n-grams of a chunk, numbered order by order: an n-gram is the number of all but its last
    word and that of the word, so no hashes are sorted to find which are alike.

    ``where`` has, of each order, the number of the n-gram that ends at each word, and 0 where the
    text has too few words before (``nth`` tells); ``grams`` are the hashes, ascending, and
    ``numbers`` the numbers they belong to.
    """

    def __init__(self, words: bytes, payload: bytes, lengths: list[int], order: int) -> None:
        self.lengths = np.array(lengths, dtype=np.int64)
        self.bounds = np.concatenate([[0], np.cumsum(self.lengths)])
        known = np.frombuffer(words, "<u8")
        word = unpack(payload) if len(known) else np.zeros(0, np.uint32)
        sequence = known[word]
        self.nth = (np.arange(len(word)) - np.repeat(self.bounds[:-1], self.lengths)).astype(np.uint32)
        self.where = np.zeros((order, len(word)), dtype=np.uint32)
        self.ends: list[np.ndarray] = []  # where n-grams end, those of a number together
        hashes, counts, before, upto = [], [], 0, 0
        for k in range(order):
            at = np.flatnonzero(self.nth >= k)
            keys, limit = word[at].astype(np.uint64), len(known)
            if k:
                keys += (self.where[k - 1][at - 1] - np.uint32(before)).astype(np.uint64) * np.uint64(limit)
                limit *= upto - before
            by_key, first = _grouped(keys, limit)
            at = at[by_key]
            self.where[k, at] = upto + np.cumsum(first) - 1
            self.ends.append(at.astype(np.uint32))
            starts = np.flatnonzero(first)
            hashes.append(texts.window_hashes(sequence, k + 1)[at[starts] - k])
            counts.append(np.diff(starts, append=len(at)).astype(np.uint32))
            before, upto = upto, upto + len(starts)
        del word, sequence, at, keys, by_key, first, starts
        self.counts, hashes = np.concatenate(counts), np.concatenate(hashes)
        self.numbers = _ascending(hashes).astype(np.uint32)
        self.grams = hashes[self.numbers]

    def own(self, k: int) -> np.ndarray:
        """How often the n-gram that ends at each word is in the word's text, whose places follow
        each other in ``ends``."""
        at, out = self.ends[k], np.zeros(len(self.nth), dtype=np.int64)
        owner = np.repeat(np.arange(len(self.lengths), dtype=np.uint32), self.lengths)[at]
        gram = self.where[k][at]
        first = np.ones(len(at), dtype=bool)
        first[1:] = (gram[1:] != gram[:-1]) | (owner[1:] != owner[:-1])
        sizes = np.diff(np.flatnonzero(first), append=len(at))
        out[at] = np.repeat(sizes, sizes)
        return out

    def dealt(self, parts: int) -> tuple[np.ndarray, np.ndarray]:
        """(the places of ``grams`` by part, ascending in each, where each part begins and ends)."""
        part = (self.grams % np.uint64(parts)).astype(np.min_scalar_type(parts))  # 16 bits sort by radix
        by_part = np.argsort(part, kind="stable")
        return by_part, np.concatenate([[0], np.cumsum(np.bincount(part, minlength=parts))])


def _explode(order: int, parts: int):
    """Texts to blocks of n-grams. A part is a remainder of the hash, so its blocks hold quotients."""
    def blocks(row: dict) -> Iterator[pa.RecordBatch]:  # lets go of the chunk before the next is cut
        chunk = _Chunk(row["words"], row["payload"], row["lengths"], order)
        by_part, cuts = chunk.dealt(parts)
        grams, count = chunk.grams, chunk.counts[chunk.numbers]
        del chunk
        for p in np.flatnonzero(np.diff(cuts)):
            at = by_part[cuts[p]:cuts[p + 1]]
            yield pa.RecordBatch.from_arrays(
                [pa.array([row["chunk"]], pa.int64()), pa.array([row["check"]], pa.int64()),
                 pa.array([p], pa.int32()),
                 pa.array([_pack_sorted(grams[at] // np.uint64(parts))], pa.binary()),
                 pa.array([pack(count[at])], pa.binary())],
                ["chunk", "check", "part", "grams", "counts"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _cut(batches):
            for k in range(batch.num_rows):
                yield from blocks(batch.slice(k, 1).to_pylist()[0])

    return run


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in the order of parts: a part's counts added up and joined to each of its rows."""
    def done(part: int, rows: list[tuple[int, int, np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        grams, where = np.unique(np.concatenate([r[2] for r in rows]), return_inverse=True)
        total = np.zeros(len(grams), dtype=np.int64)
        np.add.at(total, where, np.concatenate([r[3] for r in rows]))
        at = 0
        for chunk, check, own, _ in rows:
            sums = total[where[at:at + len(own)]]
            at += len(own)
            yield pa.RecordBatch.from_arrays(
                [pa.array([chunk], pa.int64()), pa.array([check], pa.int64()), pa.array([part], pa.int32()),
                 pa.array([_pack_counts(sums)], pa.binary())], ["chunk", "check", "part", "payload"])

    current, rows = None, []
    for batch in batches:
        for k in range(batch.num_rows):
            part = batch.column(2)[k].as_py()
            if part != current and rows:
                yield from done(current, rows)
                rows = []
            current = part
            rows.append((batch.column(0)[k].as_py(), batch.column(1)[k].as_py(),
                         _unpack_sorted(batch.column(3)[k].as_py()),
                         unpack(batch.column(4)[k].as_py()).astype(np.int64)))
    if rows:
        yield from done(current, rows)


def _pack_counts(sums: np.ndarray) -> bytes:
    """Counts below 2 ** 64 as two 32-bit numbers each; the high ones compress to nothing."""
    return pack(np.concatenate([sums & 0xFFFFFFFF, sums >> 32]))


def _unpack_counts(data: bytes) -> np.ndarray:
    low, high = unpack(data).astype(np.int64).reshape(2, -1)
    return low + (high << 32)


def _score(chunk: _Chunk, totals: np.ndarray, corpus_words: int) -> np.ndarray:
    """The score of every document of a chunk, in units."""
    order, n = chunk.where.shape
    owner = np.repeat(np.arange(len(chunk.lengths)), chunk.lengths)
    others = totals[chunk.where[0]] - chunk.own(0)  # counts in all other documents
    rest = np.maximum(corpus_words - chunk.lengths, 1)[owner]
    share = np.maximum(others, ALPHA) / rest  # a word of no other document: ALPHA occurrences
    del owner, rest
    for k in range(1, order):
        context = np.zeros(n)
        context[1:] = others[:-1]
        others, has = totals[chunk.where[k]] - chunk.own(k), chunk.nth >= k
        seen = has & (others > 0)
        share = np.where(seen, others / np.maximum(context, 1), np.where(has, ALPHA * share, share))
    units = np.floor(np.log10(share) * UNIT + 0.5).astype(np.int64)
    total = np.concatenate([[0], np.cumsum(units)])
    return total[chunk.bounds[1:]] - total[chunk.bounds[:-1]]


def _totals(chunk: _Chunk, parts: int, answers: list[bytes]) -> np.ndarray:
    """The counts in all documents, by the numbers of the n-grams."""
    told = np.concatenate([np.zeros(0, np.int64), *map(_unpack_counts, answers)])
    if len(told) != len(chunk.grams):
        raise ValueError(_OTHER_ROWS)
    totals = np.zeros(len(told), dtype=np.int64)
    totals[chunk.numbers[chunk.dealt(parts)[0]]] = told
    return totals


def _assemble(order: int, parts: int, corpus_words: int):
    def done(row: dict, answers: list[bytes]) -> pa.RecordBatch:
        chunk = _Chunk(row["words"], row["payload"], row["lengths"], order)
        units = _score(chunk, _totals(chunk, parts, answers), corpus_words)
        return pa.RecordBatch.from_arrays(
            [pa.array(row["doc_ids"], pa.int64()), pa.array(chunk.lengths), pa.array(units)],
            ["doc_id", "n_words", "units"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, answers = None, []
        for batch in batches:
            for row in (batch.slice(k, 1).to_pylist()[0] for k in range(batch.num_rows)):
                if row["part"] == -1:
                    if current:
                        yield done(current, answers)
                    current, answers = row, []
                elif current is None or row["check"] != current["check"]:
                    raise ValueError(_OTHER_ROWS)
                else:
                    answers.append(row["payload"])
        if current:
            yield done(current, answers)

    return run


def score_documents(docs: DataFrame, order: int = ORDER, id_col: str = "doc_id",
                    text_col: str = "text", parts: int | None = None) -> DataFrame:
    """One row a document: doc_id, n_words, units and log10_score (``units`` / UNIT).

    A word's score is the count of the longest known n-gram that ends at it, in all other
    documents, over the count of its context there, times ALPHA for each order given up; a word
    that no other document has counts ALPHA times. Words of a text's beginning have fewer orders.
    A document's score is the sum of log10 of its words' scores, each rounded to a unit. NULL and
    empty texts have no words and score 0. Every row is a document: repeated rows count in each
    other's scores. An empty table gives no rows. Other columns of ``docs`` play no part.
    ``docs`` is read three times and must give its rows in the same order, as files do; stage what
    comes out of a shuffle. ``parts``, four times the shuffle partitions unless given, is how many ways the count table is
    dealt; a task holds one part of it at a time.
    """
    spark = docs.sparkSession
    if parts is None:
        parts = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    corpus_words = slim.select("text").mapInArrow(_count_words, "n long").agg(F.sum("n")).first()[0] or 0
    counted = slim.mapInArrow(
        _explode(order, parts), "chunk long, check long, part int, grams binary, counts binary"
    ).repartition("part").sortWithinPartitions("part", "chunk").mapInArrow(
        _count, "chunk long, check long, part int, payload binary")
    return slim.mapInArrow(_cut, _CHUNK).unionByName(counted, allowMissingColumns=True) \
        .repartition("chunk").sortWithinPartitions("chunk", "part") \
        .mapInArrow(_assemble(order, parts, corpus_words), "doc_id long, n_words long, units long") \
        .withColumn("log10_score", F.col("units") / UNIT)
