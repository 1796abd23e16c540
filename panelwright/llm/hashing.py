"""Numpy helpers: a table of 64-bit keys, and the distinct words of a batch."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterable, Sequence
from itertools import count

import numpy as np

MIX = np.uint64(0x9E3779B97F4A7C15)


class KeyTable:
    """Open addressing over distinct uint64 keys; every lookup is one array
    operation per probe. Values are int32, -1 stands for a missing key."""

    def __init__(self, keys: np.ndarray, values: np.ndarray, load: float = 0.25) -> None:
        self.shift = np.uint64(64 - max(4, int(np.ceil(np.log2(max(len(keys), 1) / load)))))
        size = 1 << (64 - int(self.shift))
        self.keys = np.zeros(size, np.uint64)
        self.values = np.full(size, -1, np.int32)
        self.last = size - 1
        keys, values = keys.astype(np.uint64), values.astype(np.int32)
        slots = self._slots(keys)
        while len(keys):
            # Of the keys that want a free slot the first one takes it.
            free = self.values[slots] < 0
            taken, first = np.unique(slots[free], return_index=True)
            rows = np.flatnonzero(free)[first]
            self.keys[taken], self.values[taken] = keys[rows], values[rows]
            rest = np.ones(len(keys), bool)
            rest[rows] = False
            keys, values, slots = keys[rest], values[rest], (slots[rest] + 1) & self.last

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * MIX) >> self.shift).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        slots = self._slots(keys)
        found = self.values[slots]
        rows = np.flatnonzero((found >= 0) & (self.keys[slots] != keys))
        while len(rows):
            slots[rows] = (slots[rows] + 1) & self.last
            at = slots[rows]
            found[rows] = self.values[at]
            rows = rows[(found[rows] >= 0) & (self.keys[at] != keys[rows])]
        return found


def coded(rows: Sequence[str], split: Callable[[str], Iterable[str]]):
    """(distinct words, code of every word, number of words of every row)."""
    codes: defaultdict[str, int] = defaultdict(count().__next__)
    flat: list[int] = []
    sizes = np.zeros(len(rows), np.int64)
    for i, text in enumerate(rows):
        before = len(flat)
        flat.extend(map(codes.__getitem__, split(text)))
        sizes[i] = len(flat) - before
    return list(codes), np.array(flat, np.int64), sizes


def ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of every range, one after the other."""
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(starts - (ends - sizes), sizes)
