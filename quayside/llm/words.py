"""Words of many texts at once, from the bytes of an Arrow string column.

A word is a run of bytes other than space and 0x09-0x0D; those bytes never
occur inside a longer UTF-8 character. Word hashes are 64-bit polynomials over
a random table of bytes, taken from prefix sums: no Python object per word.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

U64 = np.uint64
CHUNK_BYTES = 1 << 20
_BASE = U64(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2**64
_INVERSE = U64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_IS_LETTER = np.zeros(256, dtype=bool)  # letters and digits, and every byte of longer characters
_IS_LETTER[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_BYTES = np.random.default_rng(20240201).integers(1, 2**64, 256, dtype=np.uint64)
_LOWER = np.arange(256)
_LOWER[0x41:0x5B] += 0x20


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of a 64-bit hash."""
    h = (h ^ (h >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U64(27))) * U64(0x94D049BB133111EB)
    return h ^ (h >> U64(31))


@functools.lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = np.full(n + 1, _BASE), np.full(n + 1, _INVERSE)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


@dataclass
class Words:
    """Words of consecutive texts; ``first[i]:first[i + 1]`` are those of text ``i``."""
    row: int              # number of the first text in the batch
    data: np.ndarray      # bytes of the texts
    offset: np.ndarray    # byte offsets of the texts in ``data``, and the end
    first: np.ndarray
    start: np.ndarray     # byte offsets of the words
    end: np.ndarray
    sums: np.ndarray      # prefix sums of the polynomial
    down: np.ndarray

    def hashes(self, longest: int | None = None, last: int | None = None) -> np.ndarray:
        """Hash of each word, of its first ``longest`` or its ``last`` bytes."""
        start, end = self.start, self.end
        if longest is not None:
            end = np.minimum(end, start + longest)
        if last is not None:
            start = np.maximum(start, end - last)
        return mix((self.sums[end] - self.sums[start]) * self.down[start] + (end - start).astype(U64))

    def cased(self) -> np.ndarray:
        """Hash of each word as it is, where ``lower`` folded it."""
        up, _ = _powers(len(self.down) - 1)
        sums = np.zeros(len(self.data) + 1, dtype=U64)
        np.cumsum(_BYTES[self.data] * up[:len(self.data)], out=sums[1:])
        return mix((sums[self.end] - sums[self.start]) * self.down[self.start] + (self.end - self.start).astype(U64))

    def text_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def __len__(self) -> int:
        return len(self.first) - 1


def texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; null counts as empty."""
    if column.null_count:
        column = column.fill_null("")
    if pa.types.is_large_string(column.type):
        kind = np.int64
    else:
        kind = np.int32
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], dtype=kind)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    if not len(column) or buffers[2] is None:
        return np.zeros(0, dtype=np.uint8), np.zeros(len(column) + 1, dtype=np.int64)
    data = np.frombuffer(buffers[2], dtype=np.uint8)[offsets[0]:offsets[-1]]
    return data, offsets - offsets[0]


def words(column: pa.Array, lower: bool = False, letters: bool = False, breaks: bytes = b"") -> Iterator[Words]:
    """The words of a batch, in chunks of about a megabyte and at least one text.

    ``lower`` hashes A-Z as a-z. ``letters`` takes runs of letters, digits and
    non-ASCII characters as words. Bytes of ``breaks`` separate words too.
    """
    held = _IS_LETTER.copy() if letters else ~_IS_SPACE
    held[list(breaks)] = False
    data, offset = texts(column)
    values = _BYTES[_LOWER] if lower else _BYTES
    row, n = 0, len(offset) - 1
    while row < n:
        to = max(row + 1, int(np.searchsorted(offset, offset[row] + CHUNK_BYTES, side="right")) - 1)
        part, ends = data[offset[row]:offset[to]], offset[row:to + 1] - offset[row]
        size = max(len(part), CHUNK_BYTES)
        up, down = _powers(1 << (size - 1).bit_length())
        inside = held[part]
        edge = np.zeros(len(part) + 1, dtype=bool)
        edge[ends] = True
        before = np.concatenate([[False], inside])  # before[i]: byte i - 1 is inside
        start = np.flatnonzero(inside & (~before[:-1] | edge[:-1]))
        after = np.concatenate([inside[1:], [False]])[:len(part)]
        end = np.flatnonzero(inside & (~after | edge[1:])) + 1
        sums = np.zeros(len(part) + 1, dtype=U64)
        np.cumsum(values[part] * up[:len(part)], out=sums[1:])
        yield Words(row, part, ends, np.searchsorted(start, ends), start, end, sums, down)
        row = to


def grams(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` consecutive hashes (as many as there are, less ``size - 1``)."""
    n = max(0, len(hashes) - size + 1)
    out = np.zeros(n, dtype=U64)
    for k in range(size):
        out = out * _BASE + hashes[k:k + n]
        out ^= out >> U64(29)
    return mix(out)


def within(first: np.ndarray, size: int) -> np.ndarray:
    """True for the positions of :func:`grams` that lie in one text."""
    n = max(0, int(first[-1]) - size + 1)
    text_end = np.repeat(first[1:], np.diff(first))[:n]
    return np.arange(n) + size <= text_end
