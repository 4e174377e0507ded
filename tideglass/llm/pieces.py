"""Cuts texts at places where byte-level pre-tokenisation may be cut as well.

The pre-tokens of a text are those of its pieces if it is cut before a space that is followed by a
letter or a visible ASCII character: no pre-token reaches over such a place, whatever stands
before the space, as a run of white space always leaves its last space to what follows.
"""

from __future__ import annotations

import re
from collections.abc import Callable

import numpy as np
import pyarrow as pa

from tideglass.llm import texts

_CUT = re.compile(r" (?=[!-~]|[^\W\d_])")
_ODD = re.compile(r" (?![!-~]|[^\W\d_])")


def split(text: str) -> list[str]:
    """The pieces; all but the first have lost the space they begin with."""
    return _CUT.split(text) if _ODD.search(text) else text.split(" ")


# A byte after a space at which a piece may begin: visible ASCII, or the first byte of a code point
# from U+00C0 to U+07FF, among which there is no white space.
_BEGINS = np.zeros(256, dtype=bool)
_BEGINS[0x21:0x7F] = True
_BEGINS[0xC3:0xE0] = True


def spans(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pieces of UTF-8 texts as (starts, ends, range of pieces of each text); a piece has the space
    it begins with. There are as many cuts as in ``split`` or fewer."""
    begins = np.zeros(len(data) + 1, dtype=bool)
    if len(data):
        begins[:-2] = (data[:-1] == 0x20) & _BEGINS[data[1:]]
        ends = bounds[1:][np.diff(bounds) > 0]
        begins[ends - 1] = False  # what follows the last byte of a text is another text
        begins[bounds[:-1][np.diff(bounds) > 0]] = True
    starts = np.flatnonzero(begins[:-1])
    return starts, np.append(starts[1:], len(data))[:len(starts)], np.searchsorted(starts, bounds)


class PieceTable:
    """What ``encode`` gives for pieces, kept by their 64-bit hash in arrays, some 25 bytes a piece.

    ``encode`` takes distinct pieces and returns the values of all, one after the other, and how
    many each has. With 2 million pieces, two share a hash with a probability of 1e-7.
    """

    def __init__(self, kind: np.dtype,
                 encode: Callable[[list[str]], tuple[np.ndarray, np.ndarray]]) -> None:
        self.encode = encode
        self.hashes = np.zeros(0, np.uint64)                    # ascending
        self.at, self.size = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.flat = np.zeros(0, kind)                           # values of all known pieces

    def _learn(self, hashes: np.ndarray, pieces: list[str]) -> None:
        values, size = self.encode(pieces)
        at = len(self.flat) + np.cumsum(size) - size
        self.flat = np.concatenate([self.flat, values.astype(self.flat.dtype, copy=False)])
        place = np.searchsorted(self.hashes, hashes)
        self.hashes = np.insert(self.hashes, place, hashes)
        self.at = np.insert(self.at, place, at)
        self.size = np.insert(self.size, place, size)

    def look_up(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The values of an Arrow column of texts, one after the other, and where each text's begin
        (one more entry for the end). NULL is empty."""
        data, bounds = texts.utf8(column)
        starts, ends, ranges = spans(data, bounds)
        hashes, first, which = np.unique(
            texts.hash_spans(data, starts, ends), return_index=True, return_inverse=True)
        place = np.minimum(np.searchsorted(self.hashes, hashes), max(len(self.hashes) - 1, 0))
        new = np.flatnonzero(self.hashes[place] != hashes) if len(self.hashes) \
            else np.arange(len(hashes))
        if len(new):
            raw = data.tobytes()
            self._learn(hashes[new], [raw[a:b].decode() for a, b in zip(
                starts[first[new]].tolist(), ends[first[new]].tolist())])
            place = np.searchsorted(self.hashes, hashes)
        size = self.size[place][which]
        upto = np.concatenate([[0], np.cumsum(size)])
        source = np.repeat(self.at[place][which] - upto[:-1], size) + np.arange(upto[-1])
        return self.flat[source], upto[ranges]
