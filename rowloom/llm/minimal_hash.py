"""Minimal perfect hashing of 64-bit keys, and vectors indexed by it.

Keys are dealt to twice as many places as there are keys; those alone at their place have it, the others go on to the next
level. A key's slot is the number of taken places before its own, so n keys have the slots 0 to n - 1. Asked for a key
that it was not built from, a hash may name any slot: the slot's own key tells.
"""

from __future__ import annotations

import numpy as np

SPARE = 2


def _mixed(keys: np.ndarray, level: int) -> np.ndarray:
    """A bijection of 64-bit numbers (splitmix64), another one for each level: no two keys meet at every level."""
    z = keys.astype(np.uint64) + np.uint64((0x9E3779B97F4A7C15 * (level + 1)) % 2**64)
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


class MinimalHash:
    """Slots of a fixed set of keys. `levels` holds the taken places of each level, a bit each."""

    def __init__(self, sizes: list[int], levels: list[bytes]):
        self.sizes, self.levels = list(sizes), list(levels)
        self._taken, self._before, n = [], [], 0
        for size, bits in zip(self.sizes, self.levels):
            taken = np.unpackbits(np.frombuffer(bits, np.uint8), count=size)
            before = np.cumsum(taken, dtype=np.int64) - taken + n
            n += int(taken.sum())
            self._taken.append(taken.view(bool))
            self._before.append(before)
        self.n = n

    @classmethod
    def of(cls, keys: np.ndarray) -> MinimalHash:
        """Built from distinct keys."""
        sizes, levels = [], []
        left = np.asarray(keys, np.int64)
        while len(left):
            size = SPARE * len(left) + 1
            at = (_mixed(left, len(sizes)) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(at, minlength=size) == 1
            sizes.append(size)
            levels.append(np.packbits(alone).tobytes())
            left = left[~alone[at]]
            if len(sizes) > 200:
                raise ValueError("keys repeat")
        return cls(sizes, levels)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """A slot per key; -1 for some that it was not built from."""
        found = np.full(len(keys), -1, np.int64)
        waiting = np.arange(len(keys))
        for level, size in enumerate(self.sizes):
            at = (_mixed(keys[waiting], level) % np.uint64(size)).astype(np.int64)
            taken = self._taken[level][at]
            found[waiting[taken]] = self._before[level][at[taken]]
            waiting = waiting[~taken]
            if not len(waiting):
                break
        return found

    def ordered(self, keys: np.ndarray) -> np.ndarray:
        """The keys it was built from, by slot."""
        out = np.empty(self.n, np.int64)
        out[self.slots(keys)] = keys
        return out


def verified(slots: np.ndarray, ordered: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Whether each key is the one its slot belongs to."""
    if not len(ordered):
        return np.zeros(len(keys), bool)
    return (slots >= 0) & (ordered[np.maximum(slots, 0)] == keys)
