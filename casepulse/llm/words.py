"""Words of whole texts as numpy arrays over the UTF-8 bytes of an Arrow batch.

A separator is always a single ASCII byte, so bytes can be classified one by one: a byte of a
longer character never looks like one. Word hashes are polynomial in 2^64 over the bytes and
come from one running sum, so a batch is handled without a Python object for each word.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa

BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Separators ``[\x20\x09-\x0D]``: all other bytes belong to words.
BLANK = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
#: Separators ``[\x00-\x2F\x3A-\x60\x7B-\x7F]`` of lower-cased text.
PUNCTUATED = (np.arange(256) < 128) & ~np.isin(np.arange(256), [*range(48, 58), *range(97, 123)])


@dataclass
class Words:
    """The words of some rows: ``starts`` and ``ends`` are byte positions in ``data``.

    The words of row i are those from ``first[i]`` up to ``first[i + 1]``, its bytes those
    from ``edges[i]`` up to ``edges[i + 1]``.
    """

    data: np.ndarray
    edges: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    @property
    def rows(self) -> np.ndarray:
        """The row of each word."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def word(self, i: int) -> bytes:
        return self.data[self.starts[i] : self.ends[i]].tobytes()


def slices(texts: pa.Array, most_bytes: int = 1 << 17) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Runs of rows of at most ``most_bytes``, or one longer row: first row, bytes, edges. Null is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string())
    if texts.null_count:
        texts = texts.fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    buffer = texts.buffers()[2]
    data = np.frombuffer(buffer, np.uint8) if buffer is not None else np.zeros(0, np.uint8)
    i = 0
    while i < len(texts):
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + most_bytes, side="right")) - 1)
        yield i, data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        i = j


def split(data: np.ndarray, edges: np.ndarray, blank: np.ndarray = BLANK, lower: bool = True) -> Words:
    """Words of rows that lie one after another in ``data``."""
    data = LOWER[data] if lower else data
    inside = ~blank[data]
    before = np.empty_like(inside)
    before[:1] = False
    before[1:] = inside[:-1]
    at = edges[:-1][edges[:-1] < len(data)]
    before[at] = False  # a row begins anew
    starts = np.flatnonzero(inside & ~before)
    after = np.empty_like(inside)
    after[-1:] = False
    after[:-1] = inside[1:]
    after[edges[1:][edges[1:] > 0] - 1] = False
    ends = np.flatnonzero(inside & ~after) + 1
    return Words(data, edges, starts, ends, np.searchsorted(starts, edges))


@lru_cache(None)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = np.uint64(pow(int(BASE), -1, 1 << 64))
    with np.errstate(over="ignore"):
        up, down = np.full(size, BASE), np.full(size, inverse)
        up[0] = down[0] = 1
        return np.multiply.accumulate(up), np.multiply.accumulate(down)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits that spreads each of them over all."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def hashes(words: Words) -> np.ndarray:
    """A 64-bit hash of each word, the same in every batch."""
    n = len(words.data)
    up, down = _powers(1 << max(18, int(n).bit_length()))
    with np.errstate(over="ignore"):
        total = np.zeros(n + 1, np.uint64)
        np.cumsum((words.data.astype(np.uint64) + np.uint64(1)) * up[:n], out=total[1:])
        return mix((total[words.ends] - total[words.starts]) * down[words.starts])


def grams(values: np.ndarray, n: int) -> np.ndarray:
    """A hash of each n values in a row; the last n - 1 begin no gram of their own row."""
    size = max(0, len(values) - n + 1)
    out = np.zeros(size, np.uint64)
    with np.errstate(over="ignore"):
        for j in range(n):
            out = out * BASE + values[j : j + size]
    return mix(out)


def sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of the values of each row, zero for a row without any; values may be a matrix."""
    total = np.zeros((len(first) - 1, *values.shape[1:]), values.dtype)
    full = np.flatnonzero(np.diff(first))
    if len(full):
        total[full] = np.add.reduceat(values, first[:-1][full], axis=0)
    return total


def tally(values: np.ndarray, weights: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values in order and how often each occurs, or the sum of its weights."""
    if weights is None:
        return np.unique(values, return_counts=True)
    order = np.argsort(values, kind="stable")
    values, weights = values[order], weights[order]
    begins = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]])) if len(values) else np.zeros(0, int)
    return values[begins], np.add.reduceat(weights, begins) if len(begins) else weights


def find(keys: np.ndarray, values: np.ndarray) -> np.ndarray:
    """The place of each value among the sorted keys, -1 where it is not one of them."""
    if not len(keys):
        return np.full(len(values), -1)
    at = np.searchsorted(keys, values)
    at[at == len(keys)] = 0
    return np.where(keys[at] == values, at, -1)


class HashIndex:
    """A sorted hash array with a table of where each leading bit pattern begins.

    Hashes spread evenly, so a value is found after a look at one or two neighbours instead of
    a binary search through the whole array.
    """

    def __init__(self, keys: np.ndarray) -> None:
        self.keys = keys
        bits = max(1, min(24, int(len(keys)).bit_length() + 1))
        self.shift = np.uint64(64 - bits)
        self.begins = np.searchsorted(keys >> self.shift, np.arange((1 << bits) + 1, dtype=np.uint64)).astype(np.int32)
        self.padded = np.concatenate([keys, np.zeros(1, np.uint64)])
        self.widest = int(np.diff(self.begins).max(initial=0))

    def find(self, values: np.ndarray) -> np.ndarray:
        """The place of each value, -1 where it is not there."""
        place = (values >> self.shift).astype(np.int64)
        at, end = self.begins[place], self.begins[place + 1]
        out = np.where((at < end) & (self.padded[at] == values), at, np.int32(-1))
        open_ = np.flatnonzero((out < 0) & (at + 1 < end))
        for step in range(1, self.widest):
            if not len(open_):
                break
            here = at[open_] + np.int32(step)
            hit = self.padded[here] == values[open_]
            out[open_[hit]] = here[hit]
            open_ = open_[~hit & (here + 1 < end[open_])]
        return out
