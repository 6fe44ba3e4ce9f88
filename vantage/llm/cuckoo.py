"""Cuckoo filter over 64-bit hashes, in numpy: insertions, deletions and lookups of whole arrays.

Four 16-bit fingerprints a bucket; an item lies in one of two buckets that follow from each other by
its fingerprint alone.  Items are kept as often as they were inserted, so a deletion takes back one
insertion and never another item's only trace."""

from __future__ import annotations

import numpy as np

SLOTS = 4
LOAD = 0.8
ROUNDS = 500


class CuckooFilter:
    def __init__(self, table: np.ndarray):
        self.table = table

    @classmethod
    def sized(cls, items: int) -> "CuckooFilter":
        """Empty, with room for ``items``."""
        buckets = 1
        while buckets * SLOTS * LOAD < items:
            buckets *= 2
        return cls(np.zeros((buckets, SLOTS), dtype=np.uint16))

    @classmethod
    def from_bytes(cls, data: bytes) -> "CuckooFilter":
        return cls(np.frombuffer(data, dtype="<u2").reshape(-1, SLOTS).astype(np.uint16))

    def to_bytes(self) -> bytes:
        return self.table.astype("<u2").tobytes()

    def __len__(self) -> int:
        return int(np.count_nonzero(self.table))

    def _home(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        hashes = hashes.astype(np.uint64)
        prints = np.maximum((hashes >> np.uint64(48)).astype(np.uint16), np.uint16(1))
        return prints, (hashes & np.uint64(len(self.table) - 1)).astype(np.int64)

    def _other(self, prints: np.ndarray, buckets: np.ndarray) -> np.ndarray:
        mixed = prints.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(32)
        return buckets ^ (mixed & np.uint64(len(self.table) - 1)).astype(np.int64)

    def contains(self, hashes: np.ndarray) -> np.ndarray:
        prints, first = self._home(hashes)
        second = self._other(prints, first)
        return ((self.table[first] == prints[:, None]) | (self.table[second] == prints[:, None])).any(axis=1)

    def _settle(self, prints: np.ndarray, buckets: np.ndarray) -> np.ndarray:
        """Put items into free slots of their buckets; true where there was none."""
        order = np.argsort(buckets, kind="stable")
        sorted_buckets = buckets[order]
        starts = np.flatnonzero(np.r_[True, sorted_buckets[1:] != sorted_buckets[:-1]])
        turn = np.arange(len(order)) - np.repeat(starts, np.diff(np.r_[starts, len(order)]))
        taken = self.table[sorted_buckets] != 0
        fits = turn < (SLOTS - taken.sum(axis=1))
        free_first = np.argsort(taken[fits], axis=1, kind="stable")
        self.table[sorted_buckets[fits], free_first[np.arange(len(free_first)), turn[fits]]] = prints[order][fits]
        left = np.ones(len(order), dtype=bool)
        left[order[fits]] = False
        return left

    def insert(self, hashes: np.ndarray) -> bool:
        """Insert all; false (the filter is then of no use) where there is no room."""
        prints, buckets = self._home(hashes)
        rng = np.random.default_rng(len(hashes))
        left = self._settle(prints, buckets)
        prints, buckets = prints[left], buckets[left]
        buckets = self._other(prints, buckets)
        for _ in range(ROUNDS):
            left = self._settle(prints, buckets)
            prints, buckets = prints[left], buckets[left]
            if not len(prints):
                return True
            # one item a bucket pushes another out, which goes on to its own other bucket
            _, pushers = np.unique(buckets, return_index=True)
            at, slot = buckets[pushers], rng.integers(0, SLOTS, len(pushers))
            out = self.table[at, slot].copy()
            self.table[at, slot] = prints[pushers]
            prints[pushers], buckets[pushers] = out, self._other(out, at)
        return False

    def remove(self, hashes: np.ndarray) -> None:
        """Take back one insertion of each."""
        prints, buckets = self._home(hashes)
        for p, first, second in zip(prints, buckets, self._other(prints, buckets)):
            for b in (first, second):
                found = np.flatnonzero(self.table[b] == p)
                if len(found):
                    self.table[b, found[0]] = 0
                    break
