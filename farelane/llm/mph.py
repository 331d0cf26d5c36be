"""Minimal perfect hashing of 64-bit keys with numpy: levels of bit arrays and ranks.

Every level gives each key left a place in a table of twice as many bits. Keys alone
in their place are settled; the others go to the next level. A key's slot is the
number of set bits before its own, so n keys fill the slots 0 to n - 1.
"""

from __future__ import annotations

import struct

import numpy as np

SPREAD = 2
MAX_LEVELS = 64


def mixed(keys: np.ndarray, seed: int) -> np.ndarray:
    """A bijective mix of 64-bit keys."""
    x = keys.astype(np.uint64) + np.uint64((0x9E3779B97F4A7C15 * (seed + 1)) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class MinimalPerfectHash:
    """Slots of distinct 64-bit keys. Other keys get any slot or none, so callers compare fingerprints."""

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels
        before, self.ranks = 0, []
        for bits in levels:
            self.ranks.append(before + np.cumsum(bits, dtype=np.int64) - bits)
            before += int(bits.sum())
        self.size = before

    @classmethod
    def build(cls, keys: np.ndarray) -> MinimalPerfectHash:
        left, levels = keys.astype(np.uint64), []
        while len(left):
            if len(levels) == MAX_LEVELS:
                raise ValueError("keys of a minimal perfect hash must be distinct")
            places = (mixed(left, len(levels)) % np.uint64(SPREAD * len(left))).astype(np.int64)
            taken = np.bincount(places, minlength=SPREAD * len(left))
            alone = taken == 1
            levels.append(alone)
            left = left[~alone[places]]
        return cls(levels)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key, -1 for keys that are certainly not among those built."""
        keys = keys.astype(np.uint64)
        found = np.full(len(keys), -1, dtype=np.int64)
        left = np.arange(len(keys))
        for level, (bits, ranks) in enumerate(zip(self.levels, self.ranks)):
            if not len(left):
                break
            places = (mixed(keys[left], level) % np.uint64(len(bits))).astype(np.int64)
            hit = bits[places]
            found[left[hit]] = ranks[places[hit]]
            left = left[~hit]
        return found

    def to_bytes(self) -> bytes:
        parts = [struct.pack("<I", len(self.levels))]
        for bits in self.levels:
            parts += [struct.pack("<Q", len(bits)), np.packbits(bits).tobytes()]
        return b"".join(parts)

    @classmethod
    def from_bytes(cls, data: bytes) -> MinimalPerfectHash:
        (count,), at, levels = struct.unpack_from("<I", data), 4, []
        for _ in range(count):
            (length,) = struct.unpack_from("<Q", data, at)
            packed = np.frombuffer(data, np.uint8, (length + 7) // 8, at + 8)
            levels.append(np.unpackbits(packed, count=length).astype(bool))
            at += 8 + len(packed)
        return cls(levels)
