"""Growing map from 63-bit keys to 32-bit values, looked up in numpy batches."""

from __future__ import annotations

import numpy as np

_ODD = np.uint64(0x9E3779B97F4A7C15)


class HashMap:
    """Open addressing with linear probing; at most half full."""

    def __init__(self, bits: int = 12):
        self.size = 0
        self._room(bits)

    def _room(self, bits: int) -> None:
        self.bits = bits
        self.keys = np.full(1 << bits, -1, np.int64)
        self.values = np.zeros(1 << bits, np.int32)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * _ODD) >> np.uint64(64 - self.bits)).astype(np.int64)

    def insert(self, keys: np.ndarray, values: np.ndarray) -> None:
        """Add distinct keys that are not there yet."""
        if 2 * (self.size + len(keys)) > len(self.keys):
            old = self.keys >= 0
            keys = np.concatenate([self.keys[old], keys])
            values = np.concatenate([self.values[old], values])
            self.size = 0
            self._room(max(self.bits, int(4 * len(keys)).bit_length()))
        self.size += len(keys)
        slot = self._slot(keys)
        while len(keys):
            free = self.keys[slot] < 0
            self.keys[slot[free]] = keys[free]  # of several, one stays
            placed = self.keys[slot] == keys
            self.values[slot[placed]] = values[placed]
            keys, values = keys[~placed], values[~placed]
            slot = (slot[~placed] + 1) & (len(self.keys) - 1)

    def lookup(self, keys: np.ndarray) -> np.ndarray:
        """Values; -1 where a key is missing."""
        out = np.full(len(keys), -1, np.int32)
        slot, rows = self._slot(keys), np.arange(len(keys))
        while len(rows):
            found = self.keys[slot]
            hit = found == keys
            out[rows[hit]] = self.values[slot[hit]]
            on = ~hit & (found >= 0)
            rows, keys = rows[on], keys[on]
            slot = (slot[on] + 1) & (len(self.keys) - 1)
        return out
