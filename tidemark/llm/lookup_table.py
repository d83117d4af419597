"""A fixed open-addressing hash table over numpy arrays, for vectorised lookups inside tasks."""

from __future__ import annotations

import numpy as np

_MIX = np.uint64(0x9E3779B97F4A7C15)


class KeyTable:
    """Maps distinct 64-bit keys to their positions 0..n-1; unknown keys to -1."""

    def __init__(self, keys: np.ndarray):
        keys = np.ascontiguousarray(keys).astype(np.uint64)
        bits = max(4, int(2 * len(keys)).bit_length() + 1)
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys = np.zeros(1 << bits, np.uint64)
        self.where = np.full(1 << bits, -1, np.int32)
        left = np.arange(len(keys), dtype=np.int32)
        slot = self._slot(keys)
        while left.size:
            free = np.flatnonzero(self.where[slot[left]] < 0)
            first, at = np.unique(slot[left[free]], return_index=True)
            placed = left[free[at]]
            self.where[first], self.keys[first] = placed, keys[placed]
            waiting = np.ones(len(keys), bool)
            waiting[placed] = False
            left = left[waiting[left]]
            taken = left[self.where[slot[left]] >= 0]
            slot[taken] = (slot[taken] + 1) & self.mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * _MIX) >> self.shift).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        keys = keys.astype(np.uint64, copy=False)
        slot = self._slot(keys)
        found = self.where[slot]
        missed = np.flatnonzero((found >= 0) & (self.keys[slot] != keys))
        while missed.size:
            slot[missed] = (slot[missed] + 1) & self.mask
            at = slot[missed]
            found[missed] = self.where[at]
            missed = missed[(found[missed] >= 0) & (self.keys[at] != keys[missed])]
        return found
