"""Words of whole texts as arrays: one numpy pass over the bytes of an Arrow column.

Word characters are given as a set of byte values. Both word patterns used in
this subpackage separate words at ASCII characters only, so a byte of a
multi-byte UTF-8 character is always part of a word and bytes suffice.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa

U = np.uint64

# Fixed values: [^\x20\x09-\x0D]+ and [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ after lower-casing A-Z.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
NOT_SPACE = np.ones(256, dtype=bool)
NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = False
LETTERS = np.zeros(256, dtype=bool)
LETTERS[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True

# Texts are taken in slices of so many bytes (one longer text is a slice of its own).
SLICE = 1 << 19

def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer that spreads every input bit over the word (splitmix64)."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def _sign(place: np.ndarray, code: np.ndarray) -> np.ndarray:
    """A pseudo-random number for a character at a place in its word."""
    return mix((place.astype(U) << U(21) | code.astype(U)) * U(0x9E3779B97F4A7C15) + U(0x243F6A8885A308D3))


@cache
def _signs() -> np.ndarray:
    return _sign(np.repeat(np.arange(256), 256), np.tile(np.arange(256), 256))


def characters(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where each word's characters begin in the list of all, their places in the word, and in the text."""
    size = end - start
    first = np.cumsum(size) - size
    place = np.arange(int(size.sum())) - np.repeat(first, size)
    return first, place, np.repeat(start, size) + place


def word_hashes(code: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each word code[start:end]: a sum of one number for each character and place.

    The numbers are mixed, not powers of a radix, so no pattern of letters makes
    long words cancel out.
    """
    if not len(start):
        return np.zeros(0, dtype=U)
    begin = np.zeros(len(code), dtype=np.int32)
    begin[start] = start
    place = np.arange(len(code), dtype=np.int32) - np.maximum.accumulate(begin)
    letter = code.astype(np.int32)
    far = np.flatnonzero((place > 255) | (letter > 255))
    key = place << 8 | letter
    key[far] = 0
    sign = _signs()[key]
    sign[far] = _sign(place[far], letter[far])
    total = np.zeros(len(code) + 1, dtype=U)
    np.cumsum(sign, out=total[1:])
    return mix(total[end] - total[start])


@dataclass
class Words:
    """Words of some rows. Row r has words first[r]:first[r + 1]; word i is
    data[start[i]:end[i]] (lower-cased) and has the 64-bit hash hashes[i]."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray
    hashes: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def row(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and len + 1 offsets into them; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    _, offsets, data = column.buffers()
    place = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    whole = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    base = int(place[0]) if len(place) else 0
    return whole[base : int(place[-1]) if len(place) else 0], place - base


def small(batches: Iterator[pa.RecordBatch], rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """The batches in parts of few rows, so that what is built for a part stays small;
    memory that Arrow keeps for itself is given back between batches."""
    for batch in batches:
        for start in range(0, max(batch.num_rows, 1), rows):
            yield batch.slice(start, rows)
        pa.default_memory_pool().release_unused()


def slices(offsets: np.ndarray, limit: int = SLICE) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes, or of one row."""
    n, at = len(offsets) - 1, 0
    while at < n:
        to = int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1
        to = min(n, max(at + 1, to))
        yield at, to
        at = to


def words_of(data: np.ndarray, offsets: np.ndarray, keep: np.ndarray) -> Words:
    """The words of rows that lie one behind the other in ``data``."""
    base = int(offsets[0])
    offsets, data = offsets - base, LOWER[data[base : int(offsets[-1])]]
    inside = keep[data]
    n = len(data)
    opens, closes = inside.copy(), inside.copy()
    if n:
        opens[1:] &= ~inside[:-1]
        closes[:-1] &= ~inside[1:]
        edge = offsets[offsets < n]
        opens[edge] = inside[edge]
        edge = offsets[offsets > 0] - 1
        closes[edge] = inside[edge]
    start, end = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    return Words(data, start, end, np.searchsorted(start, offsets), word_hashes(data, start, end))


def word_slices(column: pa.Array, keep: np.ndarray) -> Iterator[tuple[int, int, Words]]:
    """(first row, row after the last, words) for slices of a string column."""
    data, offsets = text_bytes(column)
    for at, to in slices(offsets):
        yield at, to, words_of(data, offsets[at : to + 1], keep)


def windows(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` consecutive words (len - size + 1 of them)."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, dtype=U)
    out = np.full(n, size, dtype=U)
    for k in range(size):
        out = out * U(0xD6E8FEB86659FD93) + hashes[k : k + n]
    return mix(out)


def word_hash(word: bytes) -> int:
    """The hash that ``words_of`` gives a word."""
    return int(words_of(np.frombuffer(word, np.uint8), np.array([0, len(word)]), np.ones(256, bool)).hashes[0])
