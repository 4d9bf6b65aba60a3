"""Hashes and places of the words of many texts at once.

A word is a run of bytes other than white space (9 to 13 and 32) in a text's
UTF-8, in lower case (A-Z).  Its hash is a polynomial over its bytes, modulo
2**64, from prefix sums over the whole batch, then mixed; equal words have equal
hashes wherever they stand.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa

FACTOR = 0x9E3779B97F4A7C15
_CODES = np.random.default_rng(17).integers(1, 1 << 64, 256, np.uint64) | np.uint64(1)
_CODES[65:91] = _CODES[97:123]
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


class Words(NamedTuple):
    """``hash`` of every word; text i has the words ``first[i]`` to
    ``first[i + 1]``; ``start`` and ``end`` are code points in its text."""

    hash: np.ndarray
    first: np.ndarray
    start: np.ndarray
    end: np.ndarray


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column without nulls, and each text's bounds in them."""
    wide = pa.types.is_large_string(texts.type)
    _, bounds, data = texts.buffers()
    if not len(texts) or data is None:
        return np.empty(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    at = np.frombuffer(bounds, np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]


class WordReader:
    """Reads the words of string columns; keeps the factor's powers."""

    def __init__(self) -> None:
        self.power = self.inverse = np.ones(1, np.uint64)

    def _powers(self, n: int) -> None:
        if len(self.power) < n:
            size = 1 << (n - 1).bit_length()
            self.power, self.inverse = (
                np.cumprod(np.r_[np.uint64(1), np.full(size - 1, f, np.uint64)]) for f in (FACTOR, pow(FACTOR, -1, 1 << 64))
            )

    def __call__(self, texts: pa.Array, places: bool = True) -> Words:
        data, bounds = text_bytes(texts)
        n = len(data)
        if not n:
            none = np.empty(0, np.int64)
            return Words(np.empty(0, np.uint64), np.zeros(len(texts) + 1, np.int64), none, none)
        self._powers(n)
        inside = ~_SPACE[data]
        opens, closes = inside.copy(), inside.copy()
        opens[1:] &= ~inside[:-1]
        closes[:-1] &= ~inside[1:]
        border = bounds[(bounds > 0) & (bounds < n)]
        opens[border] = inside[border]
        closes[border - 1] = inside[border - 1]
        start, end = np.flatnonzero(opens), np.flatnonzero(closes) + 1
        total = np.empty(n + 1, np.uint64)
        total[0] = 0
        np.cumsum(_CODES[data] * self.power[:n], out=total[1:])
        hashes = mixed((total[end] - total[start]) * self.inverse[start])
        first = np.searchsorted(start, bounds)
        if places:
            points = np.empty(n + 1, np.int64)
            points[0] = 0
            np.cumsum((data & 0xC0) != 0x80, out=points[1:])
            base = np.repeat(points[bounds[:-1]], np.diff(first))
            start, end = points[start] - base, points[end] - base
        return Words(hashes, first, start, end)
