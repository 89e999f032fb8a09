"""Polynomial hashes of byte ranges, as array operations modulo 2**64."""

from __future__ import annotations

import numpy as np

_SEED = np.random.default_rng(20240607)
#: A random odd 64-bit number per byte value; the base and its inverse modulo 2**64.
TABLE = _SEED.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1); kept for the next call up to 2M entries."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = 1 << max(12, int(n - 1).bit_length())
        have = np.empty(size, np.uint64)
        have[0], done, step = 1, 1, base
        while done < size:
            have[done : 2 * done] = have[:done] * np.uint64(step)
            done, step = 2 * done, step * step % (1 << 64)
        if size <= 1 << 21:
            _powers[base] = have
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def prefix(values: np.ndarray) -> np.ndarray:
    """n + 1 prefix sums of values[i] * BASE**i."""
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers(BASE, len(values)), out=out[1:])
    return out


def ranges(sums: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of values[begin:end], the same wherever the range lies; its length is mixed in."""
    raw = (sums[end] - sums[begin]) * powers(INVERSE, len(sums))[begin]
    return mix(raw + (end - begin).astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))


def spaces(flat: np.ndarray) -> np.ndarray:
    """Which bytes are ASCII white space."""
    return (flat == 0x20) | ((flat >= 0x09) & (flat <= 0x0D))


def words(flat: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begins and ends of the runs without ASCII white space; no run crosses an offset."""
    inside = np.zeros(len(flat) + 1, bool)
    inside[:-1] = ~spaces(flat)
    cut = np.zeros(len(flat) + 1, bool)
    cut[offsets] = True
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | cut[1:]
    ends = np.zeros(len(flat) + 1, bool)
    ends[1:] = inside[:-1] & (~inside[1:] | cut[1:])
    return np.flatnonzero(begins), np.flatnonzero(ends)
