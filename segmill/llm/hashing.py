"""Rolling polynomial hashes modulo 2^64 over arrays, for all positions at once.

Arrays are worked through in stretches, so memory beyond the result does not grow with a text.
"""

from __future__ import annotations

import numpy as np

from segmill.llm.common import ragged

#: Odd multipliers of the polynomials over bytes and over words.
BYTE_BASE, WORD_BASE = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93
#: Values that are hashed at once.
STRETCH = 1 << 18
_tables: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base^i and base^-i modulo 2^64 for i below n (an odd base has an inverse)."""
    got = _tables.get(base)
    if got is None or len(got[0]) < n:
        size = 1 << max(16, (n - 1).bit_length())
        both = []
        for b in (base, pow(base, -1, 1 << 64)):
            p = np.full(size, b, np.uint64)
            p[0] = 1
            both.append(np.cumprod(p, dtype=np.uint64))
        got = _tables[base] = (both[0], both[1])
    return got


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit over all others (a bijection of 64-bit numbers)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def prefix(values: np.ndarray, base: int) -> np.ndarray:
    """Prefix sums of value[i] * base^i (n + 1)."""
    power, _ = _powers(base, len(values) + 1)
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values.astype(np.uint64) * power[: len(values)], out=out[1:])
    return out


def spans(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int) -> np.ndarray:
    """Hashes of value[start:end], the same wherever the span stands."""
    _, inverse = _powers(base, len(sums))
    return mix((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))


def rolling(values: np.ndarray, size: int, base: int) -> np.ndarray:
    """Hashes of all windows of size values (n - size + 1 of them)."""
    number = len(values) - size + 1
    if number <= 0:
        return np.empty(0, np.uint64)
    out = np.empty(number, np.uint64)
    for a in range(0, number, STRETCH):
        b = min(number, a + STRETCH)
        sums = prefix(values[a : b + size - 1], base)
        _, inverse = _powers(base, len(sums))
        out[a:b] = mix((sums[size:] - sums[:-size]) * inverse[: b - a] + np.uint64(size))
    return out


def of_spans(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray, base: int) -> np.ndarray:
    """Hashes of data[start : start + size] for spans anywhere, overlapping or not."""
    out = np.empty(len(starts), np.uint64)
    ends = np.cumsum(sizes)
    a = 0
    while a < len(starts):
        b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + STRETCH, side="right")))
        begin = np.concatenate([[0], np.cumsum(sizes[a:b])])
        sums = prefix(data[ragged(starts[a:b], sizes[a:b])], base)
        out[a:b] = spans(sums, begin[:-1], begin[1:], base)
        a = b
    return out
