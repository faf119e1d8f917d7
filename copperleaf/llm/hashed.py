"""Words of whole Arrow batches as numpy arrays: where they stand, 64-bit hashes of their bytes, and tables that remember words by hash.

No Python object is made for a word that is known. Words are told apart by their hashes:
two of a million words share one with a chance under 1e-7, and words over ``MAX_WORD`` bytes
(whose hashes could be made to agree) are told apart by a digest of their bytes besides.
"""

from __future__ import annotations

import sys
import types
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from copperleaf.llm.common import _grown, starts

MAX_WORD = 64
SLICE_BYTES = 2 << 20
#: Words that a table remembers before it starts anew, by default.
MEMO = 1 << 20
_ODD = 0x9E3779B97F4A7C15  # odd, so it has an inverse
_INVERSE = pow(_ODD, -1, 1 << 64)
_VALUES = np.random.default_rng(20).integers(1, 1 << 63, 256, np.uint64) | np.uint64(1)
_MIX = np.uint64(0xBF58476D1CE4E5B9)


def remembered(name: str, make):
    """make(), once for a worker process: what a task has learnt of fixed files stays for the worker's next tasks."""
    kept = sys.modules.setdefault("_copperleaf_remembered", types.ModuleType("_copperleaf_remembered")).__dict__
    if name not in kept:
        kept[name] = make()
    return kept[name]


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column, and where each row begins (and the last one ends); nulls have none."""
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None or not len(at) or at[-1] == at[0]:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]


def slices(batches: Iterable[pa.RecordBatch], limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut record batches into slices of about ``limit`` bytes of text; one very long text is a slice of its own."""
    for batch in batches:
        size = np.append(0, np.cumsum(text_lengths(batch.column("text"))))
        begin = 0
        while begin < batch.num_rows:
            end = max(begin + 1, int(np.searchsorted(size, size[begin] + limit, "right")) - 1)
            yield batch.slice(begin, end - begin)
            begin = end


def text_lengths(column: pa.Array) -> np.ndarray:
    return np.asarray(pc.fill_null(pc.binary_length(column.cast(pa.large_binary())), 0))


class Powers:
    """Powers of an odd number and of its inverse modulo 2^64, as many as were asked for so far."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def __call__(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > len(self.up):
            size = max(n, 1 << 20)
            for name, base in (("up", _ODD), ("down", _INVERSE)):
                steps = np.full(size, base, np.uint64)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps, dtype=np.uint64))
        return self.up[:n], self.down[:n]


def hashes(data: np.ndarray, begin: np.ndarray, end: np.ndarray, mark: np.ndarray | None = None) -> np.ndarray:
    """A hash of each data[begin:end], not 0; ``mark`` tells equal words apart."""
    up, down = remembered("powers", Powers)(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_VALUES[data] * up[: len(data)], out=sums[1:])
    out = (sums[end] - sums[begin]) * down[begin]
    for i in np.flatnonzero(end - begin > MAX_WORD):
        word = data[begin[i] : end[i]].tobytes()
        out[i] ^= np.uint64(zlib.crc32(word) << 32 | zlib.adler32(word[::-1]))
    out ^= (end - begin).astype(np.uint64) * _MIX
    if mark is not None:
        out ^= mark.astype(np.uint64) * np.uint64(_ODD)
    out = (out ^ (out >> np.uint64(32))) * _MIX
    out ^= out >> np.uint64(29)
    out[out == 0] = 1
    return out


class HashIndex:
    """hash -> row number, in the order of arrival; slots are probed one after the other, for all hashes at once."""

    def __init__(self, size: int = 1 << 16):
        self._make(size)

    def _make(self, size: int) -> None:
        self.mask, self.used = np.uint64(size - 1), 0
        self.keys, self.row = np.zeros(size, np.uint64), np.zeros(size, np.int32)

    def find(self, wanted: np.ndarray) -> np.ndarray:
        """Row numbers; -1 for hashes that are not there."""
        out = np.full(len(wanted), -1, np.int32)
        at, left = wanted & self.mask, np.arange(len(wanted))
        while len(left):
            there = self.keys[at]
            hit = there == wanted[left]
            out[left[hit]] = self.row[at[hit]]
            go_on = ~hit & (there != 0)
            left, at = left[go_on], (at[go_on] + np.uint64(1)) & self.mask
        return out

    def add(self, new: np.ndarray) -> None:
        """Give distinct hashes that are not there the next row numbers."""
        if 2 * (self.used + len(new)) > len(self.keys):
            old, rows = self.keys[self.keys != 0], self.row[self.keys != 0]
            self._make(1 << int(4 * (len(old) + len(new))).bit_length())
            self._put(old, rows)
            self.used = len(old)
        self._put(new, np.arange(self.used, self.used + len(new), dtype=np.int32))
        self.used += len(new)

    def _put(self, keys: np.ndarray, rows: np.ndarray) -> None:
        at = keys & self.mask
        while len(keys):
            free = np.flatnonzero(self.keys[at] == 0)
            self.keys[at[free]] = keys[free]  # where several want a slot, the last one has it
            won = free[self.keys[at[free]] == keys[free]]
            self.row[at[won]] = rows[won]
            rest = np.ones(len(keys), bool)
            rest[won] = False
            keys, rows, at = keys[rest], rows[rest], (at[rest] + np.uint64(1)) & self.mask


class HashedLists:
    """A list of integers for each hash. Beyond ``limit`` words it starts anew, so memory stays bounded whatever the vocabulary."""

    def __init__(self, limit: int = MEMO):
        self.limit = limit
        self._reset()

    def _reset(self) -> None:
        self.index, self.flat, self.size = HashIndex(), np.empty(0, np.uint32), 0
        self.begin, self.count = np.empty(0, np.int64), np.empty(0, np.int64)

    def lists(self, wanted: np.ndarray, fill) -> tuple[np.ndarray, np.ndarray]:
        """The integers of all words, and where each word's begin; ``fill`` makes (all numbers, count of each) for places in ``wanted`` that hold new words."""
        if self.index.used > self.limit:
            self._reset()
        rows = self.index.find(wanted)
        missing = np.flatnonzero(rows < 0)
        if len(missing):
            _, first = np.unique(wanted[missing], return_index=True)
            first = missing[np.sort(first)]
            flat, count = fill(first)
            old, end = self.index.used, self.index.used + len(first)
            self.begin, self.count, self.flat = _grown(self.begin, end), _grown(self.count, end), _grown(self.flat, self.size + len(flat))
            self.begin[old:end], self.count[old:end] = self.size + starts(count)[:-1], count
            self.flat[self.size : self.size + len(flat)] = flat
            self.size += len(flat)
            self.index.add(wanted[first])
            rows[missing] = self.index.find(wanted[missing])
        count = self.count[rows]
        to = starts(count)
        return self.flat[np.repeat(self.begin[rows] - to[:-1], count) + np.arange(to[-1])], to
