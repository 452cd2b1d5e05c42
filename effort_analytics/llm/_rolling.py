"""Vectorised hashes of token sequences: words of a byte buffer, rolling hashes of any span, and
local minima (winnowing) that pick the same anchors in every copy of a passage."""

from __future__ import annotations

import numpy as np

_BASE = 0x9E3779B97F4A7C15
_U = np.uint64

BYTE_VALUES = np.random.default_rng(20240607).integers(1, 2**64 - 1, 256, dtype=np.uint64)
_powers: dict[bool, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash (splitmix64)."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _power(n: int, inverse: bool) -> np.ndarray:
    """base**i modulo 2**64 for i < n (or of the base's inverse); kept and grown as needed."""
    have = _powers.get(inverse)
    if have is None or len(have) < n:
        base = pow(_BASE, -1, 2**64) if inverse else _BASE
        have, k, size = np.ones(1, np.uint64), 1, max(n, 1 << 16)
        while k < size:
            have = np.concatenate([have, have * _U(pow(base, k, 2**64))])
            k *= 2
        _powers[inverse] = have
    return have[:n]


class Rolling:
    """Hash of any span [s, e) of a sequence of 64-bit values, in constant time a span."""

    def __init__(self, values: np.ndarray):
        self.n = n = len(values)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(values * _power(n, False), out=self.sums[1:])

    def hash(self, s: np.ndarray, e: np.ndarray) -> np.ndarray:
        return mix((self.sums[e] - self.sums[s]) * _power(self.n + 1, True)[s] + (e - s).astype(np.uint64))


def words(data: np.ndarray, at: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of bytes with ``is_word[byte]`` within each document, and
    the number of words before each document (one more entry than documents)."""
    n = len(data)
    inside = np.zeros(n + 2, bool)
    inside[1:-1] = is_word[data]
    edge = inside[1:] != inside[:-1]
    first = np.zeros(n + 1, bool)
    first[at] = True
    starts = np.flatnonzero(inside[1:] & (edge | first) )
    ends = np.flatnonzero(inside[:-1] & (edge | first))
    return starts, ends, np.searchsorted(starts, at)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    if not len(starts):
        return np.zeros(0, np.uint64)
    return Rolling(BYTE_VALUES[data]).hash(starts, ends)


def sliding_argmin(x: np.ndarray, w: int) -> np.ndarray:
    """Position of the leftmost smallest value (by its upper 32 bits) of each run of ``w`` values."""
    n = len(x)
    packed = (x & _U(0xFFFFFFFF00000000)) | np.arange(n, dtype=np.uint64)
    blocks = np.full(-(-n // w) * w, np.iinfo(np.uint64).max, np.uint64)
    blocks[:n] = packed
    blocks = blocks.reshape(-1, w)
    left = np.minimum.accumulate(blocks, axis=1).ravel()
    right = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return (np.minimum(right[:n - w + 1], left[w - 1:n]) & _U(0xFFFFFFFF)).astype(np.int64)


def anchors(values: np.ndarray, at: np.ndarray, length: int, w: int, gram: int) -> dict[str, np.ndarray]:
    """Anchors of all windows of ``length`` values that lie within one document.

    A window picks the position of the smallest ``gram``-value hash among its first ``w`` positions
    (``w + gram - 1 <= length``), so equal windows pick the same place. Consecutive windows share a
    pick: one row is (doc, a: the pick, lo and hi: first and last window start, all from the start
    of the document; key: hash of the ``length - w + 1`` values from the pick, which equal windows
    share; full: hash of all values of these windows and of the place of the pick in them).
    """
    none = np.zeros(0, np.int64)
    empty = {"doc": none, "a": none, "lo": none, "hi": none, "key": none, "full": none}
    n = len(values)
    if n < length:
        return empty
    roll = Rolling(values)
    i = np.arange(n - gram + 1)
    pick = sliding_argmin(roll.hash(i, i + gram), w)
    sizes = np.diff(at)
    counts = np.maximum(sizes - length + 1, 0)
    total = int(counts.sum())
    if not total:
        return empty
    doc = np.repeat(np.arange(len(sizes)), counts)
    start = np.arange(total) + np.repeat(at[:-1] - (np.cumsum(counts) - counts), counts)
    p = pick[start]
    new = np.ones(total, bool)
    new[1:] = p[1:] != p[:-1]
    b = np.flatnonzero(new)
    last = np.append(b[1:], total) - 1
    a, lo, hi, doc = p[b], start[b], start[last], doc[b]
    key = roll.hash(a, a + (length - w + 1))
    full = mix(roll.hash(lo, hi + length) ^ (a - lo).astype(np.uint64) * _U(0x9E3779B97F4A7C15))
    base = at[doc]
    return {"doc": doc, "a": a - base, "lo": lo - base, "hi": hi - base,
            "key": key.view(np.int64), "full": full.view(np.int64)}
