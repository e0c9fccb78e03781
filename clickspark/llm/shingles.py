"""Word-shingle sets as sorted arrays of 64-bit hashes, in numpy.

Words are ``[^\\x20\\x09-\\x0D]+`` of the text with A-Z lower-cased; a set
holds the distinct shingles of K words.  With fewer words the whole sequence
is the one shingle; without words the set is empty.
"""

from __future__ import annotations

import numpy as np

K = 5
BLOCK = 1 << 20  # bytes hashed at a time
U = np.uint64
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BASE = 0x9E3779B97F4A7C15 | 1
_SLOTS = np.array([0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93,
                   0xA0761D6478BD642F, 0xE7037ED1A0B428DB], U)
_powers = np.ones(1, U)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser on 64-bit values."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def _power(n: int) -> np.ndarray:
    global _powers
    if len(_powers) < n:
        grown = np.full(max(n, 2 * len(_powers), 256), _BASE, U)
        grown[0] = 1
        _powers = np.multiply.accumulate(grown)
    return _powers


def word_hashes(text: str) -> np.ndarray:
    raw = np.frombuffer(text.encode(), np.uint8)
    out, at = [], 0
    while at < len(raw):
        end = min(len(raw), at + BLOCK)
        while end < len(raw) and not _SPACE[raw[end]]:  # never cut a word
            more = np.flatnonzero(_SPACE[raw[end:end + BLOCK]])
            end = end + int(more[0]) if len(more) else min(len(raw), end + BLOCK)
        out.append(_hash_block(_LOWER[raw[at:end]]))
        at = end
    return np.concatenate(out) if out else np.zeros(0, U)


def _hash_block(b: np.ndarray) -> np.ndarray:
    edge = np.diff(np.concatenate([[True], _SPACE[b], [True]]).astype(np.int8))
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    if not len(starts):
        return np.zeros(0, U)
    size = ends - starts
    first = np.cumsum(size) - size
    inside = np.arange(int(size.sum())) - np.repeat(first, size)
    letters = b[inside + np.repeat(starts, size)].astype(U) + U(1)
    sums = np.add.reduceat(letters * _power(int(size.max()))[inside], first)
    return mix(sums + size.astype(U) * U(0xD6E8FEB86659FD93))


def shingle_set(text: str) -> np.ndarray:
    """Sorted distinct shingle hashes."""
    w = word_hashes(text)
    if not len(w):
        return w
    if len(w) < K:
        return mix((w * _SLOTS[:len(w)]).sum(keepdims=True) + U(len(w)))
    n = len(w) - K + 1
    s = np.full(n, K, U)
    for i in range(K):
        s += w[i:i + n] * _SLOTS[i]
    return np.unique(mix(s))


def common(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted sets."""
    if len(a) > len(b):
        a, b = b, a
    if not len(a):
        return 0
    at = np.minimum(np.searchsorted(b, a), len(b) - 1)
    return int((b[at] == a).sum())
