"""Minimal perfect hashing with numpy: levels of bit vectors, the rank of a key's bit is its slot.

A key is a pair of 64-bit hashes. On each level a key that shares its place with no other key sets a bit there; the others
go on to the next level. A segment holds up to a few thousand keys, so that many segments make up an index and each is
built by one task. Segments are plain bytes: header, bits, then one fixed-size record for each key.
"""

import numpy as np

GAMMA = 1.7  # places per key and level
MAX_LEVELS = 200
_STEP = np.uint64(0x9E3779B97F4A7C15)


def _place(a: np.ndarray, b: np.ndarray, level: int, size: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = a + np.uint64(level + 1) * _STEP
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x ^= b
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
    return (x % np.uint64(size)).astype(np.int64)


def build(a: np.ndarray, b: np.ndarray, records: np.ndarray) -> bytes:
    """A segment of distinct keys ``(a[i], b[i])`` with ``records[i]``; equal keys raise ``ValueError``."""
    slots = np.empty(len(a), np.int64)
    left, sizes, bits, before = np.arange(len(a)), [], [], 0
    while len(left):
        if len(sizes) == MAX_LEVELS:
            raise ValueError("equal keys")
        size = max(8, -(-int(GAMMA * len(left)) // 8) * 8)
        at = _place(a[left], b[left], len(sizes), size)
        single = np.bincount(at, minlength=size) == 1
        rank = np.cumsum(single) - 1
        placed = single[at]
        slots[left[placed]] = before + rank[at[placed]]
        before += int(single.sum())
        left = left[~placed]
        sizes.append(size)
        bits.append(np.packbits(single))
    ordered = np.empty_like(records)
    ordered[slots] = records
    head = np.array([len(a), len(sizes), *sizes], "<i8")
    return head.tobytes() + b"".join(x.tobytes() for x in bits) + ordered.tobytes()


class Segment:
    """A built segment, opened for lookups of many keys at once."""

    def __init__(self, data: bytes, dtype: np.dtype):
        n, n_levels = (int(x) for x in np.frombuffer(data, "<i8", 2))
        self.sizes = [int(x) for x in np.frombuffer(data, "<i8", n_levels, 16)]
        at, self.levels, before = 16 + 8 * n_levels, [], 0
        for size in self.sizes:
            bits = np.unpackbits(np.frombuffer(data, np.uint8, size // 8, at)).astype(bool)
            self.levels.append((bits, before + np.cumsum(bits) - 1))
            before += int(bits.sum())
            at += size // 8
        self.records = np.frombuffer(data, dtype, n, at)

    def slots(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The slot of each key, -1 where no level has a bit. A stranger may get a slot: compare what the record holds."""
        out = np.full(len(a), -1, np.int64)
        left = np.arange(len(a))
        for level, (bits, rank) in enumerate(self.levels):
            at = _place(a[left], b[left], level, len(bits))
            hit = bits[at]
            out[left[hit]] = rank[at[hit]]
            left = left[~hit]
        return out
