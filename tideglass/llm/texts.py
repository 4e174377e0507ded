"""Arrow text columns as numpy arrays: bounded slices, and 64-bit hashes of words.

A word is a run of ``[^\\x20\\x09-\\x0D]``. All work is on the UTF-8 bytes of a whole slice, so a
document costs no Python loop over its words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 2_000_000
PIECE_BYTES = 1 << 18  # hashed at once; the hashes are the same for any size

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LETTERS = np.random.default_rng(20_11).integers(1, 1 << 63, 256, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1
_powers: dict[str, np.ndarray] = {}


def slices(batches: Iterator[pa.RecordBatch], column: int,
           most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches, cut so that the text of a slice takes at most ``most`` bytes or is one row."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        sizes = np.nan_to_num(np.asarray(
            pc.binary_length(batch.column(column)).to_numpy(zero_copy_only=False), float))
        ends, first = np.cumsum(sizes), 0
        while first < batch.num_rows:
            before = ends[first - 1] if first else 0
            last = max(first + 1, int(np.searchsorted(ends, before + most, "right")))
            yield batch.slice(first, last - first)
            first = last


def utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, and where each begins (one more entry for the end). NULL is empty."""
    texts = texts.cast(pa.large_string())
    if texts.null_count:
        texts = pc.fill_null(texts, "")
    bounds = np.frombuffer(texts.buffers()[1], dtype=np.int64)[
        texts.offset:texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    if data is None:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    return np.frombuffer(data, dtype=np.uint8)[bounds[0]:bounds[-1]], bounds - bounds[0]


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values evenly (the finaliser of splitmix64)."""
    x = x.astype(np.uint64)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _power_table(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers.get("up", ())) < n:
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            table = np.full(n, base, dtype=np.uint64)
            table[0] = 1
            _powers[name] = np.cumprod(table, dtype=np.uint64)
    return _powers["up"], _powers["down"]


def _hash_piece(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    up, down = _power_table(max(len(data), PIECE_BYTES))
    total = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_LETTERS[data] * up[:len(data)], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The hash of each span of bytes; spans follow each other and do not overlap."""
    hashes, done = np.empty(len(starts), dtype=np.uint64), 0
    while done < len(starts):  # in pieces that end between spans, so that memory stays bounded
        last = max(done + 1, int(np.searchsorted(ends, starts[done] + PIECE_BYTES, "right")))
        a = starts[done]
        hashes[done:last] = _hash_piece(
            data[a:ends[last - 1]], starts[done:last] - a, ends[done:last] - a)
        done = last
    return hashes


def word_spans(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where words begin and end."""
    inside = np.zeros(len(data) + 2, dtype=bool)
    inside[1:-1] = ~_SPACE[data]
    first = np.zeros(len(data) + 1, dtype=bool)
    first[bounds] = True
    starts = np.flatnonzero(inside[1:] & (~inside[:-1] | first))
    ends = np.flatnonzero(inside[:-1] & (~inside[1:] | first))
    return starts, ends


def words(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The hash of every word, and the range of words of each text (as ``bounds`` for bytes)."""
    starts, ends = word_spans(data, bounds)
    return hash_spans(data, starts, ends), np.searchsorted(starts, bounds)


def window_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """The hash of each run of ``size`` neighbouring values, empty if there are fewer."""
    if len(hashes) < size:
        return np.zeros(0, dtype=np.uint64)
    n = len(hashes) - size + 1
    out = np.zeros(n, dtype=np.uint64)
    for k in range(size):
        out = out * np.uint64(0x9E3779B97F4A7C15) + hashes[k:k + n]
    return mix(out)


def windows_inside(bounds: np.ndarray, size: int) -> np.ndarray:
    """Which of the runs of ``size`` values over all texts lie in one text (a mask)."""
    n = max(0, int(bounds[-1]) - size + 1)
    ok = np.ones(n, dtype=bool)
    for end in np.unique(bounds[1:-1]):
        ok[max(0, end - size + 1):end] = False
    return ok
