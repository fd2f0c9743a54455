"""SuperMinHash signatures of many sets at once (numpy; runs inside Spark tasks).

Every element walks through a random permutation of the signature's slots: at level j it offers
the value j + u to slot p[j], so the offers of one element to the slots are spread evenly
instead of being independent. A slot keeps the least offer. Once all slots of a set hold offers
of level j or less, later levels cannot change anything: the set is done (early stopping).
"""

from __future__ import annotations

import numpy as np

_ODD = np.uint64(0x9E3779B97F4A7C15)
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
#: A value is its level in the upper bits and a random fraction below.
_LEVEL_SHIFT = np.uint64(52)
_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)
MAX_SLOTS = 4096


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def _draw(elements: np.ndarray, level: int, slots: int) -> tuple[np.ndarray, np.ndarray]:
    """For each element its swap partner (level..slots-1) and its value at this level."""
    with np.errstate(over="ignore"):
        seed = elements + _ODD * np.uint64(2 * level + 1)
        partner = level + (mix(seed) % np.uint64(slots - level)).astype(np.int64)
        value = (np.uint64(level) << _LEVEL_SHIFT) | (mix(seed + _ODD) >> np.uint64(12))
    return partner, value


def signatures(elements: np.ndarray, owner: np.ndarray, sets: int, slots: int) -> np.ndarray:
    """A row of `slots` values for each of `sets` sets; elements[i] (uint64) is in set owner[i].

    Sets without elements keep the largest number in every slot.
    """
    if not 0 < slots <= MAX_SLOTS:
        raise ValueError(f"slots must be in 1..{MAX_SLOTS}")
    found = np.full(sets * slots, _EMPTY)
    partner, value = _draw(elements, 0, slots)
    np.minimum.at(found, owner * slots + partner, value)
    table = found.reshape(sets, slots)
    filled = np.zeros(sets, dtype=bool)
    filled[np.unique(owner)] = True
    unfinished = filled & (table.max(axis=1) == _EMPTY)
    if not unfinished.any():
        return table
    mine = unfinished[owner]
    elements, owner, partner = elements[mine], owner[mine], partner[mine]
    places = np.tile(np.arange(slots, dtype=np.uint16), (len(elements), 1))
    row = np.arange(len(elements))
    for level in range(1, slots):
        # the swap of the level before, then the next offer
        places[row, partner], places[:, level - 1] = places[:, level - 1].copy(), places[row, partner]
        partner, value = _draw(elements, level, slots)
        np.minimum.at(found, owner * slots + places[row, partner], value)
        unfinished &= (table.max(axis=1) >> _LEVEL_SHIFT) > np.uint64(level)
        mine = unfinished[owner]
        if not mine.any():
            break
        if not mine.all():
            elements, owner, partner, places = elements[mine], owner[mine], partner[mine], places[mine]
            row = np.arange(len(elements))
    return table
