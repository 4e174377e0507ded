"""Chunks: consecutive documents of one task as sequences of numbers for their distinct words.

A chunk's words are numbered from the most frequent on; a document is the sequence of its words'
numbers, which packs to about 1.5 bytes a word. The distinct words are dealt to hash parts. So a
shuffle by word carries each word once a chunk instead of once an occurrence, and what comes back
for it is looked up by position.
"""

from __future__ import annotations

import numpy as np
import zstandard

CHUNK_BYTES = 16_000_000


def pack(values: np.ndarray) -> bytes:
    """Unsigned 32-bit numbers as four compressed byte planes."""
    planes = np.ascontiguousarray(values.astype("<u4")).view(np.uint8).reshape(-1, 4).T
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def unpack(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    return np.ascontiguousarray(planes.reshape(4, -1).T).view("<u4").ravel()


def pack_words(words: list[bytes]) -> bytes:
    """Any byte strings: their lengths, then their bytes, compressed."""
    sizes = np.array([len(words), *map(len, words)], "<u4").tobytes()
    return zstandard.ZstdCompressor(level=3).compress(sizes + b"".join(words))


def unpack_words(data: bytes) -> list[bytes]:
    raw = zstandard.ZstdDecompressor().decompress(data)
    n = int.from_bytes(raw[:4], "little")
    ends = np.cumsum(np.frombuffer(raw, "<u4", n, 4), dtype=np.int64) + 4 + 4 * n
    at, out = 4 + 4 * n, []
    for end in ends.tolist():
        out.append(raw[at:end])
        at = end
    return out


def by_frequency(numbers: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(numbers renamed so that 0 is the most frequent, old number of each new one)."""
    order = np.argsort(-np.bincount(numbers, minlength=n), kind="stable")
    rank = np.empty(n, dtype=np.uint32)
    rank[order] = np.arange(n, dtype=np.uint32)
    return rank[numbers], order


def gather(flat: np.ndarray, start: np.ndarray, size: np.ndarray, which: np.ndarray) -> np.ndarray:
    """The runs of ``flat`` with the numbers ``which``, one after the other."""
    sizes = size[which]
    upto = np.cumsum(sizes)
    return flat[np.repeat(start[which] - upto + sizes, sizes) + np.arange(upto[-1] if len(upto) else 0)]
