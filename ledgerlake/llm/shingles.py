"""Sets of word shingles as hashes, and minwise sketches of them."""

from __future__ import annotations

import numpy as np
import xxhash

WORDS = 5
#: Minwise functions of a sketch. The first ``ROOTS`` are also kept with all their bits.
FUNCTIONS, ROOTS = 256, 16
_rng = np.random.Generator(np.random.PCG64(20240601))
_PLACES = _rng.integers(1, 1 << 63, size=WORDS + 1, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_MINWISE = _rng.integers(1, 1 << 63, size=FUNCTIONS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_MIX = np.uint64(0xD6E8FEB86659FD93)


def shingles(text: bytes, size: int = WORDS) -> np.ndarray:
    """Hashes of the distinct runs of ``size`` words, sorted; of a shorter text, the one of all
    its words. Words are parted by ASCII white space and A-Z are lower-cased."""
    words = text.lower().split()
    n = len(words)
    if not n:
        return np.empty(0, dtype=np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=n)
    if n < size:
        out = (hashes * _PLACES[:n]).sum(keepdims=True, dtype=np.uint64) + _PLACES[-1:] * np.uint64(size - n)
    else:
        out = hashes[: n - size + 1] * _PLACES[0]
        for k in range(1, size):
            out += hashes[k: n - size + 1 + k] * _PLACES[k]
    out ^= out >> np.uint64(32)
    out *= _MIX
    out ^= out >> np.uint64(29)
    out.sort()
    fresh = np.empty(len(out), dtype=bool)
    fresh[0] = True
    np.not_equal(out[1:], out[:-1], out=fresh[1:])
    return out[fresh]


def sketches(sets: list[np.ndarray]) -> np.ndarray:
    """The 32 high bits of every minwise function for each set (none empty)."""
    out = np.empty((len(sets), FUNCTIONS), dtype=np.uint32)
    lo = 0
    while lo < len(sets):
        hi, total = lo, 0
        while hi < len(sets) and (hi == lo or total + len(sets[hi]) <= 1 << 15):
            total += len(sets[hi])
            hi += 1
        flat = np.concatenate(sets[lo:hi])
        begin = np.cumsum([0, *map(len, sets[lo:hi - 1])])
        scratch = np.empty_like(flat)
        for k in range(FUNCTIONS):
            np.multiply(flat, _MINWISE[k], out=scratch)
            out[lo:hi, k] = np.minimum.reduceat(scratch, begin) >> np.uint64(32)
        lo = hi
    return out


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether the intersection of two sorted sets is at least so many percent of their union."""
    if min(len(a), len(b)) * 100 < percent * max(len(a), len(b)):
        return False
    both = np.concatenate([a, b])
    both.sort(kind="stable")
    common = int(np.count_nonzero(both[1:] == both[:-1]))
    return 100 * common >= percent * (len(a) + len(b) - common)
