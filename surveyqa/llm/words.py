"""Words and word windows of whole Arrow batches, as 64-bit hashes, without a Python loop over words.

A word is a run of bytes other than space and 0x09-0x0D; those bytes never occur inside a longer
UTF-8 character. Hashes are a fixed function of the bytes, so they agree between tasks and runs.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa

#: Bytes of text handled at once; a longer text makes a block of its own.
BLOCK = 1 << 21
ODD = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finalizer: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
BYTES = mix((np.arange(256, dtype=np.uint64) + np.uint64(1)) * ODD)
FOLDED = BYTES.copy()
FOLDED[ord("A") : ord("Z") + 1] = BYTES[ord("a") : ord("z") + 1]
BASE = 0xD6E8FEB86659FD93


@lru_cache(maxsize=2)
def powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number modulo 2**64, and of its inverse."""
    up, down = (np.full(size, b, np.uint64) for b in (BASE, pow(BASE, -1, 1 << 64)))
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and the offset of each row; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.fill_null("").cast(pa.large_binary())
    _, offsets, data = column.buffers()
    where = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8), where


@dataclass
class Words:
    """Words of the rows ``first`` to ``last`` of a batch; ``row`` counts from ``first``."""

    first: int
    last: int
    data: np.ndarray
    offsets: np.ndarray
    start: np.ndarray
    end: np.ndarray
    row: np.ndarray
    hash: np.ndarray

    def bounds(self) -> np.ndarray:
        """Where each row's words begin, and the number of all words."""
        return np.searchsorted(self.row, np.arange(self.last - self.first + 1))


def span_hashes(data: np.ndarray, table: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    size = 1 << max(16, int(len(data)).bit_length())
    up, down = powers(size)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(table[data] * up[: len(data)], out=total[1:])
    return mix((total[end] - total[start]) * down[start] ^ (end - start).astype(np.uint64) * ODD)


def blocks(column: pa.Array, lower: bool) -> Iterator[Words]:
    """The words of a string column, in blocks of whole rows."""
    data, offsets = texts(column)
    table, count, first = FOLDED if lower else BYTES, len(offsets) - 1, 0
    while first < count:
        last = int(np.searchsorted(offsets, offsets[first] + BLOCK, "right")) - 1
        last = min(count, max(first + 1, last))
        part, at = data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        inside = ~SPACE[part]
        edge = np.ones(len(part) + 1, bool)
        edge[1:-1] = ~inside[:-1]
        edge[at] = True
        start = np.flatnonzero(inside & edge[:-1])
        edge[:-1] = ~inside
        edge[at] = True
        end = np.flatnonzero(inside & edge[1:]) + 1
        row = np.searchsorted(at, start, "right") - 1
        yield Words(first, last, part, at, start, end, row, span_hashes(part, table, start, end))
        first = last


def windows(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first word of each window of ``size`` words within one row."""
    count = len(words.hash) - size + 1
    if count <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    first = np.flatnonzero(words.row[:count] == words.row[size - 1 :])
    total = np.zeros(len(first), np.uint64)
    for k in range(size):
        total = total * np.uint64(BASE) + mix(words.hash[first + k] + ODD)
    return mix(total), first


def shingle_sets(words: Words, size: int) -> Iterator[tuple[int, np.ndarray]]:
    """Row of the batch and its distinct ``size``-word windows, sorted.

    A row with fewer words has its whole word sequence as the only element, one without words none.
    """
    hashes, first = windows(words, size)
    at = np.searchsorted(words.row[first], np.arange(words.last - words.first + 1))
    bounds = words.bounds()
    for k in range(words.last - words.first):
        own = hashes[at[k] : at[k + 1]]
        if len(own) > 1:
            own = np.sort(own)
            own = own[np.concatenate(([True], own[1:] != own[:-1]))]
        elif not len(own) and bounds[k + 1] > bounds[k]:
            total = np.uint64(bounds[k + 1] - bounds[k])
            with np.errstate(over="ignore"):
                for h in words.hash[bounds[k] : bounds[k + 1]]:
                    total = total * np.uint64(BASE) + mix(np.array([h]) + ODD)[0]
            own = mix(np.array([total]))
        yield words.first + k, own
