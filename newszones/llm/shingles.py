"""Word shingles of UTF-8 texts as 64-bit hashes, with numpy."""

import numpy as np

_rng = np.random.Generator(np.random.PCG64(20240229))
_BYTE = _rng.integers(0, 1 << 64, 256, np.uint64)
_BASE = np.uint64(0xD6E8FEB86659FD93)
#: Inverse of the base modulo 2^64.
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]
PIECE = 1 << 20


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    with np.errstate(over="ignore"):
        while len(_powers[0]) < n:
            for i, base in enumerate((_BASE, _INVERSE)):
                p = _powers[i]
                _powers[i] = np.concatenate((p, p * (p[-1] * base)))
    return _powers[0], _powers[1]


def mixed(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def byte_hashes(text: bytes, size: int) -> np.ndarray:
    """The hash of every run of ``size`` bytes; texts of any length, piece by piece."""
    if len(text) > PIECE:
        return np.concatenate([byte_hashes(text[at:at + (PIECE >> 1) + size - 1], size)
                               for at in range(0, len(text) - size + 1, PIECE >> 1)])
    raw = np.frombuffer(text, np.uint8)
    n = len(raw) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    up, down = _power(len(raw) + 1)
    with np.errstate(over="ignore"):
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_BYTE[raw] * up[:len(raw)], dtype=np.uint64)))
        return mixed((sums[size:] - sums[:n]) * down[:n])


def _hashes(text: bytes, size: int) -> np.ndarray:
    """Of words joined by single spaces: the hash of every run of ``size`` words."""
    raw = np.frombuffer(text, np.uint8)
    up, down = _power(len(raw) + 1)
    with np.errstate(over="ignore"):
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_BYTE[raw] * up[:len(raw)], dtype=np.uint64)))
        gaps = np.flatnonzero(raw == 32)
        starts, ends = np.concatenate(([0], gaps + 1)), np.concatenate((gaps, [len(raw)]))
        size = min(size, len(starts))
        starts, ends = starts[:len(starts) - size + 1], ends[size - 1:]
        return mixed((sums[ends] - sums[starts]) * down[starts])


def shingles(text: bytes, size: int = 5) -> np.ndarray:
    """Sorted distinct hashes of all runs of ``size`` words; of the whole sequence if it is shorter; none without words."""
    own = text.lower().split()
    if not own:
        return np.empty(0, np.uint64)
    if len(text) <= PIECE:
        return np.unique(_hashes(b" ".join(own), size))
    parts, step = [], 1 << 16  # a long text goes by runs of words that overlap by size - 1
    for at in range(0, max(1, len(own) - size + 1), step):
        parts.append(np.unique(_hashes(b" ".join(own[at:at + step + size - 1]), size)))
    return np.unique(np.concatenate(parts))
