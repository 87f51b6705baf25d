"""Hashing of words, shingles and windows with numpy, one batch of texts at a time."""

from __future__ import annotations

import hashlib

import numpy as np

# An odd multiplier and its inverse modulo 2**64: powers of the second undo powers of the first.
_P = 0x9E3779B97F4A7C15
_P_INVERSE = pow(_P, -1, 1 << 64)
_CODES = np.random.default_rng(20240301).integers(1, 1 << 63, 256, dtype=np.uint64)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


class Powers:
    """Powers of the multiplier and of its inverse, kept and grown as longer texts come."""

    def __init__(self) -> None:
        self.up = self.down = np.zeros(0, np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > len(self.up):
            n2 = max(n, 2 * len(self.up), 1 << 16)
            self.up, self.down = powers(_P, n2), powers(_P_INVERSE, n2)
        return self.up, self.down


def prefix_hash(data: np.ndarray, tables: Powers) -> np.ndarray:
    """H with H[i] the sum of code(data[j]) * P**j over j < i."""
    up, _ = tables.get(len(data) + 1)
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_CODES[data] * up[: len(data)], out=out[1:])
    return out


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray, tables: Powers) -> np.ndarray:
    """Hash of the bytes start..end-1, wherever they stand."""
    _, down = tables.get(len(prefix))
    return mix((prefix[end] - prefix[start]) * down[start])


def shingles(text: bytes, width: int, tables: Powers) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the ``width``-word shingles of a text.

    A-Z are lower-cased and words end at ASCII white space. A text with fewer
    words has one shingle, the whole sequence; one without words has none.
    """
    data = _LOWER[np.frombuffer(text, np.uint8)]
    space = np.ones(len(data) + 2, bool)
    space[1:-1] = _SPACE[data]
    turns = np.flatnonzero(space[1:] != space[:-1])
    start, end = turns[0::2], turns[1::2]
    if not len(start):
        return np.zeros(0, np.uint64)
    words = span_hash(prefix_hash(data, tables), start, end, tables)
    n = max(1, len(words) - width + 1)
    out = np.full(n, min(width, len(words)), np.uint64)
    for i in range(min(width, len(words))):
        out = mix(out * np.uint64(_P) + words[i:i + n])
    out.sort()
    fresh = np.ones(n, bool)
    np.not_equal(out[1:], out[:-1], out=fresh[1:])
    return out[fresh]


def set_digest(hashes: np.ndarray) -> bytes:
    """128 bits that tell sets of hashes apart."""
    return hashlib.blake2b(hashes.tobytes(), digest_size=16).digest()
