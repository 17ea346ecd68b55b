"""Texts as blocks of bytes: words, hashes of spans and shingles for many documents at once.

A partition's texts arrive as Arrow batches; each is cut into blocks of whole documents of about
``BLOCK`` bytes, so that memory follows the block (or the longest text), never the partition.
Hashes have 64 bits and mixed bits: two different spans are taken for one with probability 2^-60.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK = 1 << 20

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_RANDOM = np.random.default_rng(20240607)
_BYTE = _RANDOM.integers(1, 2**64, 256, dtype=np.uint64) | np.uint64(1)
_BYTE_LOWER = _BYTE[_LOWER]
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_STEP = np.uint64(0xD6E8FEB86659FD93)
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base^0 .. base^(n-1) modulo 2^64, kept for the next block."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        have = np.full(max(n, BLOCK + 1), base, dtype=np.uint64)
        have[0] = 1
        have = np.multiply.accumulate(have)
        if n <= 4 * BLOCK:
            _powers[base] = have
    return have[:n]


def mixed(x: np.ndarray) -> np.ndarray:
    """Spreads what the values differ in over all bits; one to one."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Block:
    """Whole documents, as bytes; document i is ``data[at[i]:at[i + 1]]``."""

    def __init__(self, data: np.ndarray, at: np.ndarray, rows: slice, lower: bool = False):
        self.data, self.at, self.rows, self.n = data, at, rows, len(at) - 1
        table = _BYTE_LOWER if lower else _BYTE
        self._sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(table[data] * powers(_BASE, len(data)), out=self._sums[1:])

    def hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """A hash of each span of bytes."""
        back = powers(_INVERSE, len(self.data) + 1)
        return mixed((self._sums[ends] - self._sums[starts]) * back[starts] + (ends - starts).astype(np.uint64))

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts and ends of the words ``[^\\x20\\x09-\\x0D]+``; the first word of each document, and how many there are."""
        inside = np.zeros(len(self.data) + 2, dtype=np.int8)
        inside[1:-1] = ~_SPACE[self.data]
        starts = inside[1:] > inside[:-1]
        ends = inside[1:] < inside[:-1]
        cut = self.at[1:-1]  # a word does not run on into the next document
        cut = cut[(inside[cut] > 0) & (inside[cut + 1] > 0)]
        starts[cut] = True
        ends[cut] = True
        starts, ends = np.flatnonzero(starts), np.flatnonzero(ends)
        return starts, ends, np.searchsorted(starts, self.at)

    def lines(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts and ends of the \\n-split lines, without the \\n; the first line of each document, and how many there are."""
        cuts = np.flatnonzero(self.data == 10)
        begins = self.at[:-1]
        starts = np.sort(np.concatenate([begins, cuts + 1]), kind="stable")
        ends = np.sort(np.concatenate([self.at[1:], cuts]), kind="stable")
        # A \n that ends a document opens an empty line, which starts where the next document does.
        first = np.arange(self.n + 1) + np.searchsorted(cuts, self.at)
        return starts, ends, first

    def doc_of(self, first: np.ndarray) -> np.ndarray:
        """The document of each element that ``first`` deals out."""
        return np.repeat(np.arange(self.n), np.diff(first))


def shingles(words: np.ndarray, first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the runs of ``size`` words of each document, in text order, and where each document's begin.

    A document with fewer words has one: all its words. One without words has none.
    """
    n = np.diff(first)
    runs = np.where(n >= size, n - size + 1, np.minimum(n, 1))
    begins = np.concatenate([[0], np.cumsum(runs)])
    if not len(words):
        return np.zeros(0, dtype=np.uint64), begins
    padded = np.concatenate([words, np.zeros(size, dtype=np.uint64)])
    at = np.repeat(first[:-1], runs) + np.arange(begins[-1]) - np.repeat(begins[:-1], runs)
    sums = np.zeros(len(at), dtype=np.uint64)
    short = np.repeat(np.where(n >= size, size, n), runs)
    whole = bool((short == size).all())
    for k in range(size):
        more = (sums + padded[at + k]) * _STEP
        sums = more if whole else np.where(k < short, more, sums)
    return mixed(sums + short.astype(np.uint64)), begins


def column(batch: pa.RecordBatch, name: str = "text") -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and where each row's begin; null counts as empty."""
    values = batch.column(batch.schema.get_field_index(name))
    if values.null_count:
        values = values.fill_null("")
    wide = pa.types.is_large_string(values.type)
    _, offsets, data = values.buffers()
    if data is None or not len(values):
        return np.zeros(0, dtype=np.uint8), np.zeros(len(values) + 1, dtype=np.int64)
    at = np.frombuffer(offsets, dtype=np.int64 if wide else np.int32)[values.offset : values.offset + len(values) + 1].astype(np.int64)
    return np.frombuffer(data, dtype=np.uint8)[at[0] : at[-1]], at - at[0]


def spans(at: np.ndarray, limit: int = BLOCK) -> Iterator[tuple[int, int]]:
    """Rows [a, b) of about ``limit`` bytes, a longer text by itself."""
    a = 0
    while a < len(at) - 1:
        b = max(a + 1, int(np.searchsorted(at, at[a] + limit, "right")) - 1)
        yield a, b
        a = b


def blocks(batch: pa.RecordBatch, name: str = "text", lower: bool = False, limit: int = BLOCK) -> Iterator[Block]:
    data, at = column(batch, name)
    for a, b in spans(at, limit):
        yield Block(data[at[a] : at[b]], at[a : b + 1] - at[a], slice(a, b), lower)
