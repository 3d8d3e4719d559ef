"""A set of 64-bit numbers that is asked for many at once."""

from __future__ import annotations

import numpy as np

_SPREAD = np.uint64(0x9E3779B97F4A7C15)


class Table:
    """Numbers with the order in which they came (open addressing in numpy); it doubles as it fills."""

    def __init__(self, keys: np.ndarray = np.zeros(0, np.uint64)):  # noqa: B008 - never changed
        self.n = 0
        self.keys = np.zeros(1, np.uint64)  # the last is never a key: an index of -1 reads it
        self._room(max(16, len(keys)))
        self.add(keys)

    def _room(self, wanted: int) -> None:
        """Slots for ``wanted`` keys, at most a third of them taken."""
        self.bits = max(6, int(wanted * 3).bit_length())
        self.index = np.full(1 << self.bits, -1, np.int32)
        if len(self.keys) <= wanted:
            self.keys = np.concatenate([self.keys[: self.n], np.zeros(wanted - self.n + 1, np.uint64)])
        self._place(np.arange(self.n, dtype=np.int32))

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * _SPREAD) >> np.uint64(64 - self.bits)).astype(np.int64)

    def _place(self, left: np.ndarray) -> None:
        slot = self._slot(self.keys[left])
        while len(left):
            free = self.index[slot] < 0
            self.index[slot[free]] = left[free]  # of several for one slot the last stays
            lost = self.index[slot] != left
            left, slot = left[lost], (slot[lost] + 1) & ((1 << self.bits) - 1)

    def add(self, keys: np.ndarray) -> None:
        """Append distinct numbers that are not there yet."""
        if not len(keys):
            return
        if (self.n + len(keys)) * 3 > 1 << self.bits or self.n + len(keys) >= len(self.keys):
            self._room(2 * (self.n + len(keys)))
        self.keys[self.n : self.n + len(keys)] = keys
        self.n += len(keys)
        self._place(np.arange(self.n - len(keys), self.n, dtype=np.int32))

    def find(self, wanted: np.ndarray) -> np.ndarray:
        """The index of each number, or -1."""
        slot = self._slot(wanted)
        found = self.index[slot]
        open_ = np.flatnonzero((found >= 0) & (self.keys[found] != wanted))
        while len(open_):
            slot[open_] = (slot[open_] + 1) & ((1 << self.bits) - 1)
            found[open_] = self.index[slot[open_]]
            open_ = open_[(found[open_] >= 0) & (self.keys[found[open_]] != wanted[open_])]
        return found
