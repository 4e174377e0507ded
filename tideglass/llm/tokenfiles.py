"""Token-id files with a shared zstandard dictionary (operator 4).

A file set is a folder of three Parquet tables, so that Spark writes and commits it on any store:

- ``dictionary``: one row, the dictionary's sha256 and bytes. It is trained on the serialised ids
  of a bounded sample: the SAMPLE documents whose id hashes lowest, SAMPLE_BYTES of each at most.
- ``data``: blocks of about BLOCK_BYTES in ascending document order. A block's ``payload`` is a row
  of zstandard frames, one a document, each compressed on its own with the dictionary, which the
  block names by its hash. A frame holds the ids as little-endian integers of ``width`` bytes.
- ``index``: document to part, block, offset and length of its frame, its number of ids, and the
  number of ids of all documents before it. A document is read from its frame alone.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from tokenizers import Tokenizer

from tideglass.llm import texts
from tideglass.llm.mixing import id_hash
from tideglass.llm.pieces import PieceTable
from tideglass.sources.workspace import stage

END_ID = 0
SAMPLE, SAMPLE_BYTES = 500, 1 << 16
DICTIONARY_BYTES = 1 << 15
LEVEL = 3
BLOCK_BYTES = 1 << 20
KNOWN, KNOWN_BYTES = 2_000_000, 1 << 25  # pieces that a worker remembers, and bytes of their ids


class Encoder:
    """Encodes texts by their pieces, and each distinct piece by the tokenizer once while it is
    remembered (``PieceTable``).

    For byte-level BPE without a normaliser. The strings of special tokens in a text are ordinary
    text.
    """

    def __init__(self, definition: bytes) -> None:
        self.tokenizer = Tokenizer.from_str(definition.decode())
        if self.tokenizer.normalizer is not None:
            raise ValueError("texts cannot be encoded in pieces when they are normalised first")
        self.tokenizer.encode_special_tokens = True
        self.type = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.line_feed = self._ids(["\n"])[0][0]
        self.known = PieceTable(self.type, self._encode)

    def _ids(self, given: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, self.type) for e in
                self.tokenizer.encode_batch_fast(given, add_special_tokens=False)]

    def _encode(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all, number of ids of each). Pieces without white space but a space before a
        character are encoded as lines of one text: a line feed is a pre-token of its own between
        them. Others, such as a lone no-break space, would merge with it and go by themselves."""
        lines = np.array([p.isprintable() and " " not in p[1:] and p != " " for p in pieces], dtype=bool)
        found: list[np.ndarray] = [np.zeros(0, self.type)] * len(pieces)
        plain = np.flatnonzero(lines)
        if len(plain):
            ids = self._ids(["\n".join([pieces[k] for k in plain])])[0]
            parts = np.split(ids, np.flatnonzero(ids == self.line_feed))
            if len(parts) != len(plain):
                raise ValueError("the tokenizer joins a line feed with a neighbouring character")
            for k, part in zip(plain, parts):
                found[k] = part[part != self.line_feed]
        odd = np.flatnonzero(~lines)
        for k, ids in zip(odd, self._ids([pieces[k] for k in odd])):
            found[k] = ids
        return np.concatenate(found), np.array([len(f) for f in found], np.int64)

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of an Arrow column of texts, one after the other, and where each text's begin
        (one more entry for the end). NULL is empty."""
        if len(self.known.hashes) > KNOWN or self.known.flat.nbytes > KNOWN_BYTES:
            self.known = PieceTable(self.type, self._encode)
        return self.known.look_up(column)


_encoders: dict[str, Encoder] = {}


def _encoder(definition: bytes) -> Encoder:
    """The encoder of this worker process, which keeps what it remembers from task to task."""
    key = hashlib.sha256(definition).hexdigest()
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = Encoder(definition)
    return _encoders[key]


def _dictionary(samples: list[bytes]) -> zstandard.ZstdCompressionDict:
    """Trained, or, of samples too few to train on, the samples themselves."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples)
    except (zstandard.ZstdError, ValueError):
        return zstandard.ZstdCompressionDict(
            b"".join(samples)[:DICTIONARY_BYTES].ljust(8, b"\0"),
            dict_type=zstandard.DICT_TYPE_RAWCONTENT)


def train_dictionary(slim: DataFrame, tokenizer) -> bytes:
    """The dictionary for (doc_id, text) rows, as bytes."""
    lowest = stage(slim.select("doc_id", id_hash(F.col("doc_id")).alias("order")).distinct()
                   .orderBy("order", "doc_id").limit(SAMPLE), "token-sample")
    picked = slim.join(lowest.withColumnRenamed("doc_id", "picked"),
                       F.col("doc_id").eqNullSafe(F.col("picked")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer.value)
        for part in texts.slices(batches, 1):
            ids, bounds = encoder.encode(part.column(1))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array([ids[a:b].tobytes()[:SAMPLE_BYTES] for a, b in zip(
                    bounds[:-1].tolist(), bounds[1:].tolist())], pa.binary())], ["order", "ids"])

    rows = picked.select("order", "text").mapInArrow(run, "order long, ids binary") \
        .where("length(ids) >= 8").orderBy("order", "ids").limit(SAMPLE).collect()
    return _dictionary([bytes(r.ids) for r in rows]).as_bytes()


def _compressor_dictionary(data: bytes) -> zstandard.ZstdCompressionDict:
    return zstandard.ZstdCompressionDict(data)  # trained or raw is told by its first bytes


_INDEX = pa.struct([("doc_id", pa.int64()), ("offset", pa.int64()), ("length", pa.int64()),
                    ("n_tokens", pa.int64()), ("before", pa.int64())])


def write_token_files(docs: DataFrame, folder: str, tokenizer_path: str, id_col: str = "doc_id",
                      text_col: str = "text") -> None:
    """Encodes every text and writes the file set at ``folder``, in ascending id order.

    NULL text is empty: the end id alone. NULL ids come first; rows of one id are in the order of
    their texts, NULL first. An empty table gives an empty file set. Other columns play no part.
    The driver reads the tokenizer's definition, whose size does not depend on the data.
    """
    spark = docs.sparkSession
    with open(tokenizer_path, "rb") as f:
        tokenizer = spark.sparkContext.broadcast(f.read())
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    trained = train_dictionary(slim, tokenizer)
    digest = hashlib.sha256(trained).hexdigest()
    spark.createDataFrame([(digest, bytearray(trained))], "hash string, bytes binary") \
        .coalesce(1).write.parquet(f"{folder}/dictionary")
    dictionary = spark.sparkContext.broadcast(trained)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer.value)
        end = np.array([END_ID], encoder.type).tobytes()
        packer = zstandard.ZstdCompressor(
            level=LEVEL, dict_data=_compressor_dictionary(dictionary.value), write_checksum=False)
        part, block = TaskContext.get().partitionId(), 0
        frames: list[bytes] = []
        index: list[tuple] = []
        offset = before = 0

        def written() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([block], pa.int32()), pa.array([digest]),
                 pa.array([encoder.type.itemsize], pa.int32()), pa.array([before], pa.int64()),
                 pa.array([b"".join(frames)], pa.binary()),
                 pa.array([[dict(zip(("doc_id", "offset", "length", "n_tokens", "before"), x))
                            for x in index]], pa.list_(_INDEX))],
                ["part", "block", "dictionary", "width", "n_tokens", "payload", "index"])

        for rows in texts.slices(batches, 1):
            ids, bounds = encoder.encode(rows.column(1))
            for doc_id, a, b in zip(rows.column(0).to_pylist(), bounds[:-1].tolist(),
                                    bounds[1:].tolist()):
                body = ids[a:b].tobytes() + end
                frame, n = packer.compress(body), len(body) // encoder.type.itemsize
                frames.append(frame)
                index.append((doc_id, offset, len(frame), n, before))
                offset, before = offset + len(frame), before + n
                if offset >= BLOCK_BYTES:
                    yield written()
                    frames, index, offset, before, block = [], [], 0, 0, block + 1
        if index:
            yield written()

    schema = ("part int, block int, dictionary string, width int, n_tokens long, payload binary, "
              "index array<struct<doc_id:long,offset:long,length:long,n_tokens:long,before:long>>")
    slim.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text") \
        .mapInArrow(run, schema).write.option("compression", "none").parquet(f"{folder}/data")

    data = spark.read.parquet(f"{folder}/data")
    # Ids before a block: of the parts before (one row a part) and of the blocks of its part before.
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = data.groupBy("part").agg(F.sum("n_tokens").alias("n")).select(
        F.col("part").alias("of"), F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    in_part = Window.partitionBy("part").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = data.select("part", "block", F.coalesce(
        F.sum("n_tokens").over(in_part), F.lit(0)).alias("inside")).join(
        parts, F.col("part") == F.col("of")).select(
        F.col("part").alias("p"), F.col("block").alias("b"),
        (F.col("base") + F.col("inside")).alias("first"))
    entries = data.select("part", "block", F.posexplode("index").alias("nth", "e"))
    entries.join(starts, (F.col("part") == F.col("p")) & (F.col("block") == F.col("b"))).select(
        "part", "block", "nth", "e.doc_id", "e.offset", "e.length", "e.n_tokens",
        (F.col("first") + F.col("e.before")).alias("start")).write.parquet(f"{folder}/index")


def _unpacker(spark: SparkSession, folder: str):
    row = spark.read.parquet(f"{folder}/dictionary").first()
    if hashlib.sha256(bytes(row["bytes"])).hexdigest() != row["hash"]:
        raise ValueError("the dictionary does not have the hash it is stored under")
    return row["hash"], bytes(row["bytes"])


def _frames(payload: bytes, entries: list[dict], width: int, unpacker) -> Iterator[np.ndarray]:
    for e in entries:
        body = unpacker.decompress(payload[e["offset"]:e["offset"] + e["length"]],
                                   max_output_size=e["n_tokens"] * width)
        yield np.frombuffer(body, f"<u{width}")


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """Every document of a file set, from its frame: doc_id, start, n_tokens, ids_crc32 (the
    unsigned crc32 of the ids as little-endian 32-bit numbers). A block that names another
    dictionary is an error."""
    digest, dictionary = _unpacker(spark, folder)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpacker = zstandard.ZstdDecompressor(dict_data=_compressor_dictionary(dictionary))
        for batch in batches:
            for row in (batch.slice(k, 1).to_pylist()[0] for k in range(batch.num_rows)):
                if row["dictionary"] != digest:
                    raise ValueError(f"block needs dictionary {row['dictionary']}")
                found = [(row["part"], row["block"], nth, len(ids), zlib.crc32(ids.astype("<u4").tobytes()))
                         for nth, ids in enumerate(
                             _frames(row["payload"], row["index"], row["width"], unpacker))]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(
                        zip(*found), (pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64()))],
                    ["part", "block", "nth", "n_tokens", "ids_crc32"])

    read = spark.read.parquet(f"{folder}/data").mapInArrow(
        run, "part int, block int, nth int, n_tokens long, ids_crc32 long")
    index = spark.read.parquet(f"{folder}/index").select("part", "block", "nth", "doc_id", "start")
    return read.join(index, ["part", "block", "nth"]).select(
        "doc_id", "start", "n_tokens", "ids_crc32")


def read_document(spark: SparkSession, folder: str, doc_id: int) -> list[np.ndarray]:
    """The ids of one document (of each row of that id), decoding nothing but its own frames."""
    digest, dictionary = _unpacker(spark, folder)
    entries = spark.read.parquet(f"{folder}/index").where(F.col("doc_id") == doc_id) \
        .orderBy("start").collect()
    out, unpacker = [], zstandard.ZstdDecompressor(dict_data=_compressor_dictionary(dictionary))
    for e in entries:
        row = spark.read.parquet(f"{folder}/data").where(
            (F.col("part") == e["part"]) & (F.col("block") == e["block"])).select(
            "dictionary", "width", F.expr(
                f"substring(payload, {e['offset'] + 1}, {e['length']})").alias("frame")).first()
        if row["dictionary"] != digest:
            raise ValueError(f"block needs dictionary {row['dictionary']}")
        body = unpacker.decompress(bytes(row["frame"]), max_output_size=e["n_tokens"] * row["width"])
        out.append(np.frombuffer(body, f"<u{row['width']}"))
    return out
