"""Words of many texts at once: positions and 64-bit hashes, from the bytes of an Arrow column.

UTF-8 bytes of code points from U+0080 on are all above 0x7F, so word classes whose limits are
ASCII can be found byte by byte. Work is done in slices of bounded size; a text longer than a
slice is a slice of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20
U = np.uint64
_BASE = U(0x9E3779B97F4A7C15)
_INVERSE = U(pow(int(_BASE), -1, 1 << 64))
_POWERS = [np.ones(1, U), np.ones(1, U)]

_byte = np.arange(256)
# Words are runs of anything but white space ...
SPACED = ~((_byte == 0x20) | ((_byte >= 0x09) & (_byte <= 0x0D)))
# ... or runs of digits, letters, and everything beyond ASCII.
ALNUM = (
    ((_byte >= 0x30) & (_byte <= 0x39))
    | ((_byte >= 0x41) & (_byte <= 0x5A))
    | ((_byte >= 0x61) & (_byte <= 0x7A))
    | (_byte >= 0x80)
)


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values in place (the finaliser of splitmix64)."""
    x ^= x >> U(30)
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


_VALUE = mix(np.arange(1, 257, dtype=U) * _BASE)
_FOLDED = _VALUE.copy()
_FOLDED[0x41:0x5B] = _VALUE[0x61:0x7B]
_ODD = mix(np.arange(1000, 1064, dtype=U) * _BASE) | U(1)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column, and where each text begins; a null has none."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    width = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    at = np.zeros(1, np.int64)
    if len(column):
        at = np.frombuffer(offsets, width)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[at[0] : at[-1]], at - at[0]


def slices(at: np.ndarray, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows with at most so many bytes each, or one row."""
    i, n = 0, len(at) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(at, at[i] + most, side="right")) - 1)
        yield i, j
        i = j


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS[0]) < n:
        for k, base in enumerate((_BASE, _INVERSE)):
            powers = np.full(n, base, U)
            powers[0] = 1
            _POWERS[k] = np.cumprod(powers, dtype=U)
    return _POWERS[0], _POWERS[1]


@dataclass
class Words:
    """The words of some texts: byte ranges, hashes, and the first word of each text."""

    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def windows(self, width: int) -> tuple[np.ndarray, np.ndarray]:
        """First words and hashes of all runs of ``width`` words that lie in one text."""
        n = len(self.hashes) - width + 1
        if n <= 0:
            return np.zeros(0, np.int64), np.zeros(0, U)
        hashed = self.hashes[:n] * _ODD[0]
        for k in range(1, width):
            hashed += self.hashes[k : n + k] * _ODD[k % 64]
        text = np.repeat(np.arange(len(self.first) - 1), self.counts)
        inside = np.flatnonzero(text[:n] == text[width - 1 :])
        return inside, mix(hashed[inside])

    def short(self, width: int) -> tuple[np.ndarray, np.ndarray]:
        """For texts of at least one word but under ``width``: first word, hash of all words."""
        at = np.flatnonzero((self.counts > 0) & (self.counts < width))
        hashed = np.zeros(len(at), U)
        for i, t in enumerate(at):
            h = self.hashes[self.first[t] : self.first[t + 1]]
            with np.errstate(over="ignore"):
                hashed[i] = (h * _ODD[: len(h)]).sum(dtype=U)
        return self.first[at], mix(hashed)


def words_of(data: np.ndarray, at: np.ndarray, word: np.ndarray, fold: bool = True) -> Words:
    """Find and hash the words; ``word`` says which bytes belong to one, ``fold`` lower-cases A-Z."""
    n = len(data)
    inside = word[data]
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    edge = at[(at > 0) & (at < n)]
    begins[edge] |= inside[edge]
    ends[edge - 1] |= inside[edge - 1]
    s, e = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    hashes = np.empty(len(s), U)
    table = _FOLDED if fold else _VALUE
    i = 0
    while i < len(s):
        j = max(i + 1, int(np.searchsorted(e, s[i] + SLICE_BYTES, side="right")))
        low, high = s[i], e[j - 1]
        power, inverse = _powers(high - low)
        total = np.zeros(high - low + 1, U)
        np.cumsum(table[data[low:high]] * power[: high - low], out=total[1:])
        hashes[i:j] = (total[e[i:j] - low] - total[s[i:j] - low]) * inverse[s[i:j] - low]
        i = j
    return Words(s, e, mix(hashes), np.searchsorted(s, at))
