"""Polynomial hashes of all stretches of an array, and sliding minima, in numpy.

``sum(v[i] * B**i)`` modulo 2**64 over prefixes gives the hash of any stretch as
the difference of two prefixes times a power of the inverse of B: one product,
whatever its length. Values go through a fixed table or mixer first.
"""

from __future__ import annotations

import numpy as np

B = np.uint64(0x9E3779B97F4A7C15)
B_INVERSE = np.uint64(pow(int(B), -1, 1 << 64))
_powers: dict[str, np.ndarray] = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def powers(n: int, which: str) -> np.ndarray:
    """First n powers of B (``up``) or of its inverse (``down``)."""
    have = _powers[which]
    if len(have) < n:
        steps = np.full(max(n, 2 * len(have)), B if which == "up" else B_INVERSE, np.uint64)
        steps[0] = 1
        _powers[which] = have = np.cumprod(steps, dtype=np.uint64)
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (a bijection)."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def prefixes(values: np.ndarray) -> np.ndarray:
    """Prefix sums of value times power, one longer than ``values`` (uint64)."""
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers(len(values), "up"), dtype=np.uint64, out=out[1:])
    return out


def stretch(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Mixed hashes of the stretches [start, end): equal content gives equal hashes wherever it stands."""
    return mix((sums[end] - sums[start]) * powers(len(sums), "down")[start])


def sliding_argmin(values: np.ndarray, window: int) -> np.ndarray:
    """Position of the rightmost minimum of each window of ``window`` values (none if there are fewer values)."""
    n = len(values) - window + 1
    if n <= 0:
        return np.zeros(0, np.int32)
    low, at, width = values, np.arange(len(values), dtype=np.int32), 1
    while width < window:
        step = min(width, window - width)
        left, right = low[:-step], low[step:]
        at = np.where(left < right, at[:-step], at[step:])
        low = np.minimum(left, right)
        width += step
    return at


def distinct_runs(at: np.ndarray) -> np.ndarray:
    """Distinct values of a non-decreasing array."""
    return at[np.concatenate(([True], at[1:] != at[:-1]))] if len(at) else at
