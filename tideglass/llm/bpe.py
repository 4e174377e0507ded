"""Byte-level BPE by a global shuffle of distinct words (operator 10).

1. Texts are cut into pre-tokens; the distinct words of each chunk (see ``chunks``) are dealt by
   hash into parts.
2. Each part encodes each of its distinct words once and answers every chunk. There are more parts
   for more text, and a task has one part at a time in memory.
3. The positions are kept as sequences of word numbers a chunk, made when the table is read again:
   that costs less than storing them. The answers go to their chunk and take the positions of the
   words. Both sides carry a digest of the chunk, so a table that does not give the same rows in
   the same order again, after a lost executor or otherwise, is an error and never a wrong result.

Decoding joins ids with the table of token bytes, which has one row a rank and is broadcast, as its
size is that of the rank file.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from tideglass.llm import texts
from tideglass.llm.chunks import by_frequency, gather, pack, pack_words, unpack, unpack_words
from tideglass.llm.pieces import PieceTable

CHUNK_BYTES = 5_000_000  # of text in a chunk, whose words and ids a task holds at once
SLICE_BYTES = 1_000_000  # of text that is cut into words at once
PART_BYTES = 1_000_000_000  # of text for each part that distinct words are dealt to
REMEMBERED = 200_000  # words of a part that a task remembers the ids of
_CHUNK = ("chunk long, check long, part int, payload binary, ranks binary, doc_ids array<long>, "
          "lengths array<int>")


def read_ranks(definition: bytes) -> dict[bytes, int]:
    """Token bytes and ranks of a file with a base64 token and a rank a line."""
    return {base64.b64decode(token): int(rank)
            for token, rank in (line.split() for line in definition.splitlines() if line)}


def _numbered(pattern: str, number: dict[str, int]):
    """Gives the pre-tokens of pieces their numbers in ``number``, new ones the next. It knows
    nothing of the chunk that it works for, so a chunk is freed when the next one begins."""
    findall = regex.compile(pattern).findall

    def numbers(pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found, size = array("I"), []
        for piece in pieces:
            words = findall(piece)
            found.extend([number.setdefault(w, len(number)) for w in words])
            size.append(len(words))
        return np.frombuffer(found, np.uint32), np.array(size, np.int64)

    return numbers


class _Words:
    """Distinct pre-tokens of a chunk, numbered as they come, and texts as those numbers."""

    def __init__(self, pattern: str) -> None:
        self.number: dict[str, int] = {}
        self.pieces = PieceTable(np.dtype(np.uint32), _numbered(pattern, self.number))
        self.doc_ids: list[int | None] = []
        self.sequences: list[np.ndarray] = []
        self.lengths: list[np.ndarray] = []
        self.bytes = 0

    def add(self, doc_ids: list[int | None], column: pa.Array) -> None:
        sequence, bounds = self.pieces.look_up(column)
        self.sequences.append(sequence)
        self.lengths.append(np.diff(bounds))
        self.doc_ids += doc_ids
        self.bytes += column.nbytes

    def _check(self, sequence: np.ndarray, words: list[bytes]) -> int:
        """What the chunk holds, as a number: the two readings of a table must agree in it."""
        digest = hashlib.blake2b(sequence.tobytes(), digest_size=8)
        digest.update(b"\0".join(words))
        digest.update(repr(self.doc_ids).encode())
        return int.from_bytes(digest.digest(), "little", signed=True)

    def rows(self, chunk: int, parts: int, of_words: bool) -> pa.RecordBatch:
        """Either a row of words for each part, or, as part -1, the sequences of numbers by
        frequency, and the numbers of the words in the order of the parts."""
        sequence, order = by_frequency(np.concatenate(self.sequences), len(self.number))
        words = [w.encode() for w in self.number]
        check = self._check(sequence, words)
        part = np.array([zlib.crc32(w) % parts for w in words], np.int64)
        by_word = np.array(sorted(range(len(words)), key=words.__getitem__), np.int64)
        dealt = by_word[np.argsort(part[by_word], kind="stable")]
        if of_words:
            cuts = np.searchsorted(part[dealt], np.arange(parts + 1))
            out = [(chunk, check, p, pack_words([words[k] for k in dealt[cuts[p]:cuts[p + 1]]]),
                    None, None, None) for p in np.flatnonzero(np.diff(cuts)).tolist()]
        else:
            rank = np.empty(len(order), np.uint32)
            rank[order] = np.arange(len(order), dtype=np.uint32)
            out = [(chunk, check, -1, pack(sequence), pack(rank[dealt]), self.doc_ids,
                    np.concatenate(self.lengths))]
        types = (pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.binary(),
                 pa.list_(pa.int64()), pa.list_(pa.int32()))
        columns = list(zip(*out)) or [[]] * len(types)
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, types)],
            ["chunk", "check", "part", "payload", "ranks", "doc_ids", "lengths"])


def _cut(pattern: str, parts: int, of_words: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, chunk = _Words(pattern), TaskContext.get().partitionId() << 32
        for part in texts.slices(batches, 1, SLICE_BYTES):
            words.add(part.column(0).to_pylist(), part.column(1))
            if words.bytes >= CHUNK_BYTES:
                yield words.rows(chunk, parts, of_words)
                words, chunk = _Words(pattern), chunk + 1
        if words.doc_ids:
            yield words.rows(chunk, parts, of_words)

    return run


_encoders: dict[tuple[str, bytes], tiktoken.Encoding] = {}  # of this worker


def _encoder(pattern: str, definition: bytes) -> tiktoken.Encoding:
    key = pattern, hashlib.sha256(definition).digest()
    if key not in _encoders:
        _encoders[key] = tiktoken.Encoding("ranks", pat_str=pattern, special_tokens={},
                                           mergeable_ranks=read_ranks(definition))
    return _encoders[key]


def _encode(pattern: str, definition):
    """Rows of words become rows of their ids: how many words, how many ids each, and all ids. Rows
    of one part follow each other."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoder(pattern, definition.value).encode_ordinary
        known: dict[bytes, bytes] = {}
        current = None
        for batch in batches:
            for k, part in enumerate(batch.column(2).to_pylist()):
                words = unpack_words(batch.column(3)[k].as_py())
                if part != current or len(known) > REMEMBERED:
                    known, current = {}, part
                for w in words:
                    if w not in known:
                        known[w] = array("I", encode(w.decode())).tobytes()
                ids = [known[w] for w in words]
                sizes = np.fromiter(map(len, ids), np.uint32, len(ids)) // 4
                flat = np.concatenate([np.array([len(ids)], np.uint32), sizes,
                                       np.frombuffer(b"".join(ids), np.uint32)])
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c).slice(k, 1) for c in range(3)),
                     pa.array([pack(flat)], pa.binary())],
                    ["chunk", "check", "part", "payload"])

    return run


class _Reassembly:
    """A chunk's sequences, and the ids of its words as they come in, part by part, in arrays."""

    def __init__(self, row: dict) -> None:
        self.doc_ids, self.lengths, self.check = row["doc_ids"], row["lengths"], row["check"]
        self.sequence, self.ranks = unpack(row["payload"]), unpack(row["ranks"])
        self.ids: list[np.ndarray] = []    # of the words in the order of ``ranks``
        self.sizes: list[np.ndarray] = []
        self.known = 0

    def take(self, row: dict) -> None:
        if row["check"] != self.check:
            raise ValueError("the table gave other rows, or another order, when read again")
        flat = unpack(row["payload"])
        n = int(flat[0])
        self.sizes.append(flat[1:n + 1])
        self.ids.append(flat[n + 1:])
        self.known += n

    def documents(self) -> Iterator[pa.RecordBatch]:
        """Batches of documents whose ids take about SLICE_BYTES, or of one document."""
        if self.known != len(self.ranks):
            raise ValueError("the table gave other rows, or another order, when read again")
        none = [np.zeros(0, np.uint32)]
        flat, dealt = np.concatenate(none + self.ids), np.concatenate(none + self.sizes)
        size, start = np.empty(len(dealt), np.int64), np.empty(len(dealt), np.int64)
        size[self.ranks] = dealt
        start[self.ranks] = np.cumsum(dealt, dtype=np.int64) - dealt
        words = np.concatenate([[0], np.cumsum(self.lengths, dtype=np.int64)])
        upto = np.concatenate([[0], np.cumsum(size[self.sequence])])[words]
        first = 0
        while first < len(self.doc_ids):
            last = max(first + 1, int(np.searchsorted(
                upto, upto[first] + texts.SLICE_BYTES // 4, "right")) - 1)
            ids = gather(flat, start, size, self.sequence[words[first]:words[last]])
            yield pa.RecordBatch.from_arrays(
                [pa.array(self.doc_ids[first:last], pa.int64()),
                 _binary(ids, 4 * (upto[first:last + 1] - upto[first]))], ["doc_id", "ids"])
            first = last


def _binary(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """The bytes of ``values``, cut at ``bounds``, as an Arrow column."""
    return pa.Array.from_buffers(pa.large_binary(), len(bounds) - 1, [
        None, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(values)),
    ]).cast(pa.binary())


def _assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of one chunk follow each other, its sequences first."""
    current = None
    for rows in batches:
        for row in (rows.slice(k, 1).to_pylist()[0] for k in range(rows.num_rows)):
            if row["part"] == -1:
                if current:
                    yield from current.documents()
                current = _Reassembly(row)
            else:
                current.take(row)
    if current:
        yield from current.documents()


def encode(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id",
           text_col: str = "text", parts: int | None = None) -> DataFrame:
    """One row a document: doc_id and ``ids``, the ids as little-endian 32-bit numbers.

    Each match of ``pattern`` is encoded by itself; there are no special tokens. NULL and empty
    texts have no ids. Repeated rows are encoded each. An empty table gives no rows. Other columns
    of ``docs`` play no part. ``docs`` is read twice and must give its rows in the same order, as
    files do; stage what comes out of a shuffle. ``parts`` is how many ways
    distinct words are dealt: unless given, one for each PART_BYTES of text and four times the
    shuffle partitions at least. The driver reads the rank file, whose size is fixed.
    """
    spark = docs.sparkSession
    if parts is None:
        size = docs.agg(F.sum(F.octet_length(text_col).cast("double"))).first()[0] or 0
        parts = max(4 * int(spark.conf.get("spark.sql.shuffle.partitions")), int(size / PART_BYTES))
    with open(ranks_path, "rb") as f:
        definition = spark.sparkContext.broadcast(f.read())
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    words = slim.mapInArrow(_cut(pattern, parts, True), _CHUNK) \
        .select("chunk", "check", "part", "payload")
    answers = words.repartition("part").sortWithinPartitions("part").mapInArrow(
        _encode(pattern, definition), "chunk long, check long, part int, payload binary")
    sequences = slim.mapInArrow(_cut(pattern, parts, False), _CHUNK)
    return sequences.unionByName(answers, allowMissingColumns=True) \
        .repartition("chunk").sortWithinPartitions("chunk", "part") \
        .mapInArrow(_assemble, "doc_id long, ids binary")


def _token_table(ranks: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of all tokens, and by rank where a token's begin and how many they are (0: none)."""
    tokens = list(ranks)
    at, lengths = np.array([ranks[t] for t in tokens]), np.array([len(t) for t in tokens])
    start, size = np.zeros(at.max() + 1, np.int64), np.zeros(at.max() + 1, np.int64)
    start[at], size[at] = np.cumsum(lengths) - lengths, lengths
    return np.frombuffer(b"".join(tokens), np.uint8), start, size


def decode(encoded: DataFrame, ranks_path: str) -> DataFrame:
    """``encoded`` (doc_id, ids) with ``decoded``, the bytes that the ids stand for. NULL ids give
    no bytes. Ids without a token are an error."""
    with open(ranks_path, "rb") as f:
        definition = encoded.sparkSession.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flat, start, size = _token_table(read_ranks(definition.value))
        for part in texts.slices(batches, 1):
            column = part.column(1).cast(pa.large_binary()).fill_null(b"")
            bounds = np.concatenate([[0], np.cumsum(
                pc.binary_length(column).to_numpy(zero_copy_only=False))]) // 4
            ids = np.frombuffer(b"".join(column.to_pylist()), "<u4")
            if len(ids) and (ids.max() >= len(size) or not size[ids].all()):
                raise ValueError("an id without a token")
            upto = np.concatenate([[0], np.cumsum(size[ids])])
            decoded = _binary(gather(flat, start, size, ids), upto[bounds])
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), decoded], ["doc_id", "ids", "decoded"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, ids binary, decoded binary")
