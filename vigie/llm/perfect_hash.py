"""Minimal perfect hashing of 64-bit keys.

Level by level, the keys that are left are thrown into twice as many places. A key alone in its place
takes it, the others go to the next level. A key's number is the number of places taken before its
own, so n keys have the numbers 0 to n - 1. Foreign keys get some number or none, therefore keys are
stored by number and compared.
"""

from __future__ import annotations

import numpy as np

from vigie.llm import shingles

ROOM = 2
MOST_LEVELS = 64


class PerfectHash:
    """Numbers for a set of distinct keys."""

    def __init__(self, levels: list[np.ndarray]):
        """``levels``: for each level, one boolean a place."""
        self.levels = levels
        self.ranks, before = [], 0
        for taken in levels:
            self.ranks.append(np.cumsum(taken, dtype=np.int64) - 1 + before)
            before += int(taken.sum())
        self.size = before

    @staticmethod
    def _places(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        step = np.uint64((level + 1) * int(shingles.BASE) % (1 << 64))
        return (shingles.mix64(keys.view(np.uint64) + step) % np.uint64(size)).astype(np.int64)

    @classmethod
    def of(cls, keys: np.ndarray) -> PerfectHash:
        left, levels = np.asarray(keys, np.int64), []
        while len(left):
            if len(levels) == MOST_LEVELS:
                raise ValueError("keys are not distinct")
            size = max(64, ROOM * len(left))
            at = cls._places(left, len(levels), size)
            taken = np.bincount(at, minlength=size) == 1
            levels.append(taken)
            left = left[~taken[at]]
        return cls(levels)

    def numbers(self, keys: np.ndarray) -> np.ndarray:
        """The number of each key; -1 for a foreign key that finds no place."""
        keys = np.asarray(keys, np.int64)
        out = np.full(len(keys), -1, np.int64)
        left = np.arange(len(keys))
        for level, (taken, rank) in enumerate(zip(self.levels, self.ranks)):
            at = self._places(keys[left], level, len(taken))
            hit = taken[at]
            out[left[hit]] = rank[at[hit]]
            left = left[~hit]
        return out

    def to_bytes(self) -> bytes:
        head = np.array([len(self.levels), *map(len, self.levels)], "<i8").tobytes()
        return head + b"".join(np.packbits(level).tobytes() for level in self.levels)

    @classmethod
    def from_bytes(cls, data: bytes) -> PerfectHash:
        n = int(np.frombuffer(data, "<i8", 1)[0])
        sizes = np.frombuffer(data, "<i8", n, 8)
        at, levels = 8 * (n + 1), []
        for size in sizes.tolist():
            packed = np.frombuffer(data, np.uint8, -(-size // 8), at)
            levels.append(np.unpackbits(packed, count=size).astype(bool))
            at += len(packed)
        return cls(levels)
