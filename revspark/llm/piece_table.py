"""A hash table in numpy arrays: 64-bit hashes of pieces -> numbers 0, 1, 2, ..."""

from __future__ import annotations

import numpy as np

EMPTY = np.uint64(0)


class PieceTable:
    """Open addressing; all look-ups and insertions of a batch run together. At ``limit`` pieces
    the table is full: what came first, and so nearly all frequent pieces, stays."""

    def __init__(self, limit: int):
        self.limit = limit
        self.bits = max(4, (2 * limit - 1).bit_length())
        self.keys = np.zeros(1 << self.bits, np.uint64)
        self.values = np.zeros(1 << self.bits, np.int32)
        self.size = 0

    def _slots(self, hashes: np.ndarray) -> np.ndarray:
        return (hashes >> np.uint64(64 - self.bits)).astype(np.int64)

    def get(self, hashes: np.ndarray) -> np.ndarray:
        """The number of each piece, -1 for unknown ones. (A hash of 0 is taken as 1.)"""
        hashes = np.maximum(hashes, np.uint64(1))
        slots = self._slots(hashes)
        keys = self.keys[slots]
        out = np.where(keys == hashes, self.values[slots], np.int32(-1))
        going = np.flatnonzero((keys != hashes) & (keys != EMPTY))
        while len(going):
            slots[going] = (slots[going] + 1) & (len(self.keys) - 1)
            keys = self.keys[slots[going]]
            hit = keys == hashes[going]
            out[going[hit]] = self.values[slots[going[hit]]]
            going = going[~hit & (keys != EMPTY)]
        return out

    def add(self, hashes: np.ndarray) -> int:
        """Number new, distinct hashes in order, as far as the limit goes; how many were added."""
        n = max(0, min(len(hashes), self.limit - self.size))
        left = np.maximum(hashes[:n], np.uint64(1))
        numbers = np.arange(self.size, self.size + n, dtype=np.int32)
        slots = self._slots(left)
        while len(left):
            free = self.keys[slots] == EMPTY
            self.keys[slots[free]] = left[free]
            won = free & (self.keys[slots] == left)
            self.values[slots[won]] = numbers[won]
            left, numbers, slots = left[~won], numbers[~won], slots[~won]
            slots = (slots + 1) & (len(self.keys) - 1)
        self.size += n
        return n
