"""Minimal perfect hashing of 64-bit keys, over whole arrays at a time.

Level by level each key gets a slot of a bit table; keys alone in theirs are done, the others go
on to the next level. A key's number is the count of bits before its own, so that n keys have the
numbers 0 to n - 1 and a lookup takes constant time. Other keys get any number or none: store a
fingerprint beside each entry to tell.
"""

from __future__ import annotations

import numpy as np

_SLOTS_A_KEY = 1.6
_LEVELS = 64


def mixed(keys: np.ndarray, seed: int) -> np.ndarray:
    """A one-to-one mixing of 64-bit keys that depends on the seed (the finalizer of splitmix64)."""
    # fixed values: the increment and multipliers of the public splitmix64 generator
    with np.errstate(over="ignore"):
        x = keys.astype(np.uint64) + np.uint64((seed + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def build(keys: np.ndarray) -> list[np.ndarray]:
    """The bit tables, packed, for distinct keys."""
    levels, rest = [], keys.astype(np.uint64)
    while len(rest):
        if len(levels) == _LEVELS:
            raise ValueError("keys repeat")
        size = int(_SLOTS_A_KEY * len(rest)) // 8 * 8 + 8
        slots = (mixed(rest, len(levels)) % np.uint64(size)).astype(np.int64)
        held = np.bincount(slots, minlength=size)
        levels.append(np.packbits(held == 1))
        rest = rest[held[slots] > 1]
    return levels


class PerfectHash:
    def __init__(self, levels: list[np.ndarray]):
        self._levels, before = [], 0
        for packed in levels:
            bits = np.unpackbits(packed).astype(bool)
            rank = before + np.cumsum(bits) - bits
            before += int(bits.sum())
            self._levels.append((bits, rank))

    def numbers(self, keys: np.ndarray) -> np.ndarray:
        """The number of each key, -1 where no level has it (surely not one of the keys)."""
        found = np.full(len(keys), -1, np.int64)
        left = np.arange(len(keys))
        for level, (bits, rank) in enumerate(self._levels):
            slots = (mixed(keys[left], level) % np.uint64(len(bits))).astype(np.int64)
            hit = bits[slots]
            found[left[hit]] = rank[slots[hit]]
            left = left[~hit]
        return found
