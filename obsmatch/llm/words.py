"""Words of many texts at once, as numpy arrays.

A word is a maximal run of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]`` after A-Z became a-z: ASCII letters and
digits and everything beyond ASCII. In UTF-8 this is a property of single bytes, so whole Arrow buffers are
scanned without making Python strings.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

_LOWER = np.zeros(256, np.uint8)  # 0 marks a byte that is in no word
for _b in range(256):
    if 0x30 <= _b <= 0x39 or 0x61 <= _b <= 0x7A or _b >= 0x80:
        _LOWER[_b] = _b
    elif 0x41 <= _b <= 0x5A:
        _LOWER[_b] = _b + 32

#: An odd multiplier and its inverse modulo 2**64: a word's hash is a polynomial in it, finished by ``mix``.
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """The finalizer of splitmix64: a bijection of 64-bit numbers that spreads every bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


#: Numbers of powers that are kept; a longer text's are made for it alone.
_KEPT = 1 << 21


def _make_powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


@lru_cache(maxsize=6)
def _kept_powers(base: int, bits: int) -> np.ndarray:
    return _make_powers(base, 1 << bits)


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    return _kept_powers(base, max(16, int(n).bit_length()))[:n] if n < _KEPT else _make_powers(base, int(n))


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(start byte, end byte, hash) of every word, and the row offsets into them (one more than rows)."""
    n = len(data)
    rows = len(offsets) - 1
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(rows + 1, np.int64)
    low = _LOWER[data]
    inside = low != 0
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True  # a word never goes on into the next row
    first = inside.copy()
    first[1:] &= ~inside[:-1] | edge[1:n]
    last = inside.copy()
    last[:-1] &= ~inside[1:] | edge[1:n]
    start = np.flatnonzero(first)
    end = np.flatnonzero(last) + 1
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(low * powers(_BASE, n), dtype=np.uint64, out=total[1:])
    value = (total[end] - total[start]) * powers(_INVERSE, n)[start]
    value = mix(value + (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    return start, end, value, np.searchsorted(start, offsets)


def sequence_fingerprint(values: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits for each row's sequence of word hashes, as two int64 arrays."""
    n = len(values)
    count = np.diff(offsets).astype(np.uint64)
    out = []
    for base, twist in ((_BASE, 0x2545F4914F6CDD1D), (0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)):
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(mix(values ^ np.uint64(twist)) * powers(base, n), dtype=np.uint64, out=total[1:])
        inverse = powers(pow(base, -1, 1 << 64), n + 1)
        part = (total[offsets[1:]] - total[offsets[:-1]]) * inverse[offsets[:-1]]
        out.append(mix(part + count * np.uint64(0x9FB21C651E98DF25)).view(np.int64))
    return out[0], out[1]


def shingles(values: np.ndarray, offsets: np.ndarray, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each row's runs of ``size`` words and the row offsets into them.

    A row of fewer words, but not none, has one shingle: all its words.
    """
    n = np.diff(offsets)
    count = np.where(n >= size, n - size + 1, np.minimum(n, 1))
    out_at = np.concatenate([[0], np.cumsum(count)])
    row = np.repeat(np.arange(len(n)), count)
    at = offsets[:-1][row] + (np.arange(out_at[-1]) - out_at[:-1][row])
    stop = offsets[1:][row]
    acc = np.zeros(len(at), np.uint64)
    padded = np.concatenate([values, np.zeros(size, np.uint64)])
    for k in range(size):
        here = padded[at + k]
        acc = acc * np.uint64(_BASE) + np.where(at + k < stop, here, np.uint64(1))
    return mix(acc), out_at
