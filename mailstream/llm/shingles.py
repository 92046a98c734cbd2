"""Vectorised word and shingle hashing and MinHash, for use inside tasks.

A word's hash is a difference of polynomial prefix sums (mod 2**64) over the
text's bytes, so all words of a text are hashed by a few numpy calls.
"""

from __future__ import annotations

import hashlib

import numpy as np

# Fixed value: shingle length in words.
K = 5

_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_BASE = 0x9E3779B97F4A7C15 | 1
_INV = pow(_BASE, -1, 1 << 64)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_powers: dict[int, np.ndarray] = {}


def _powers_of(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) mod 2**64; the table doubles when a longer text
    comes (8 bytes for each byte of the longest text)."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = max(4096, 1 << int(n - 1).bit_length())
        with np.errstate(over="ignore"):
            have = np.full(size, base, dtype=np.uint64)
            have[0] = 1
            np.multiply.accumulate(have, out=have)
        _powers[base] = have
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX1
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


def word_hashes(text: str) -> np.ndarray:
    """64-bit hash of every word, A-Z lower-cased, in order."""
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8)
    if not raw.size:
        return np.empty(0, dtype=np.uint64)
    space = np.concatenate(([True], _SPACE[raw], [True]))
    edge = np.flatnonzero(space[1:] != space[:-1])
    start, end = edge[0::2], edge[1::2]
    sums = np.zeros(raw.size + 1, dtype=np.uint64)
    np.cumsum((_LOWER[raw].astype(np.uint64) + np.uint64(1)) * _powers_of(_BASE, raw.size), out=sums[1:])
    h = (sums[end] - sums[start]) * _powers_of(_INV, raw.size + 1)[start]
    return mix(h + (end - start).astype(np.uint64) * _MIX2)


def shingle_set(text: str | None) -> np.ndarray:
    """Sorted distinct hashes of the 5-word shingles; a text of fewer words
    has its whole sequence as one shingle; no words, no shingles."""
    if not text:
        return np.empty(0, dtype=np.uint64)
    w = word_hashes(text)
    n = len(w)
    if n == 0:
        return w
    size = min(n, K)
    acc = np.full(n - size + 1, size * 0x632BE59BD9B4E019 & (2**64 - 1), dtype=np.uint64)
    for k in range(size):
        acc = acc * np.uint64(_BASE) + w[k:n - size + 1 + k]
    return np.unique(mix(acc))


def set_digest(s: np.ndarray) -> bytes:
    return hashlib.blake2b(s.tobytes(), digest_size=16).digest()


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """100 * intersection >= percent * union, on full sets."""
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)) or not len(a):
        return False
    common = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * common >= percent * (len(a) + len(b) - common)


class HalfSignatures:
    """``2 * m`` collections of ``k`` MinHashes: the two sides that a tensored
    index pairs up. Each collection is folded into one 64-bit value."""

    def __init__(self, m: int, k: int, seed: int = 20240501):
        self.m, self.k = m, k
        rng = np.random.default_rng(seed)
        self.mult = rng.integers(0, 2**64, size=2 * m * k, dtype=np.uint64) | np.uint64(1)

    def __call__(self, s: np.ndarray, block: int = 2048) -> np.ndarray:
        low = np.full(len(self.mult), 2**64 - 1, dtype=np.uint64)
        for at in range(0, len(s), block):
            part = s[at:at + block]
            np.minimum(low, (self.mult[:, None] * part[None, :]).min(axis=1), out=low)
        acc = np.zeros(2 * self.m, dtype=np.uint64)
        for k in range(self.k):
            acc = mix(acc * np.uint64(_BASE) + low[k::self.k])
        return acc.view(np.int64)
