"""A table of whole numbers as numpy arrays, for lookups of many keys at a time."""

from __future__ import annotations

import numpy as np


class OpenTable:
    """Numbers from 0 to 2^63 to numbers from 0 to 2^31: open addressing with linear probes."""

    SPREAD = np.uint64(0x9E3779B97F4A7C15)

    def __init__(self, room: int):
        """``room``: how many keys it is to hold; it has at least twice as many slots."""
        size = max(4, (2 * room).bit_length())
        self.shift, self.last = np.uint64(64 - size), (1 << size) - 1
        self.keys, self.values = np.full(1 << size, -1, np.int64), np.full(1 << size, -1, np.int32)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * self.SPREAD) >> self.shift).astype(np.int64)

    def add(self, keys: np.ndarray, values: np.ndarray) -> None:
        """Keys that are new and differ."""
        slot = self._slot(keys)
        while len(keys):
            empty = self.keys[slot] < 0
            _, first = np.unique(np.where(empty, slot, -1 - np.arange(len(slot))), return_index=True)
            first = first[empty[first]]
            self.keys[slot[first]], self.values[slot[first]] = keys[first], values[first]
            left = np.ones(len(keys), bool)
            left[first] = False
            keys, values, slot = keys[left], values[left], (slot[left] + 1) & self.last

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The value of each key, -1 where there is none; keys below zero have none."""
        slot = self._slot(keys)
        there = self.keys[slot]
        out = np.where(there == keys, self.values[slot], np.int32(-1))
        unclear = np.flatnonzero((there != keys) & (there >= 0) & (keys >= 0))
        while len(unclear):
            slot[unclear] = (slot[unclear] + 1) & self.last
            there = self.keys[slot[unclear]]
            hit = there == keys[unclear]
            out[unclear[hit]] = self.values[slot[unclear[hit]]]
            unclear = unclear[~hit & (there >= 0)]
        out[keys < 0] = -1
        return out
