"""Sets of hashed word shingles."""

from __future__ import annotations

import numpy as np
import xxhash

KNOWN_WORDS = 400_000  # words a worker remembers

_MUL = np.uint64(0x9E3779B97F4A7C15)
_STEP = np.uint64(0xD6E8FEB86659FD93)


def mixed(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """Well-spread 64-bit values; another permutation for each seed."""
    with np.errstate(over="ignore"):
        x = (x + np.uint64((seed * 0xA0761D6478BD642F + 0x1234567) % 2**64)) * _MUL
        x ^= x >> np.uint64(32)
        x *= _STEP
        x ^= x >> np.uint64(29)
        x *= _MUL
        return x ^ (x >> np.uint64(32))


class Shingler:
    """Shingles of a text: lower-case A-Z, words apart by ASCII white space.

    A text with fewer words than a shingle has its whole sequence as one; a text without
    words has none. A shingle is known by 64 bits.
    """

    def __init__(self, words: int):
        self.words = words
        self.number: dict[bytes, int] = {}
        self.hashes = np.zeros(1 << 12, np.uint64)

    def _learn(self, word: bytes) -> int:
        known = self.number.get(word)
        if known is None:
            known = self.number[word] = len(self.number)
            if known >= len(self.hashes):
                self.hashes = np.concatenate([self.hashes, np.zeros_like(self.hashes)])
            self.hashes[known] = xxhash.xxh64_intdigest(word)
        return known

    def __call__(self, text: str | None) -> np.ndarray:
        """The set, sorted."""
        words = (text or "").encode().lower().split()
        if not words:
            return np.zeros(0, np.uint64)
        if len(self.number) > KNOWN_WORDS:
            self.number = {}
        ids = list(map(self.number.get, words))
        if None in ids:
            ids = [self._learn(w) if i is None else i for w, i in zip(words, ids)]
        hashes = self.hashes[ids]
        size = min(self.words, len(hashes))
        count = len(hashes) - size + 1
        with np.errstate(over="ignore"):
            value = np.full(count, size, np.uint64)
            for i in range(size):
                value = value * _MUL + mixed(hashes[i : i + count], i + 1)
        return np.unique(mixed(value))


def set_digest(shingles: np.ndarray) -> tuple[int, int]:
    """128 bits of a set, as two signed numbers."""
    parts = []
    for seed in (101, 102):
        with np.errstate(over="ignore"):
            parts.append(int(mixed(shingles, seed).sum(dtype=np.uint64).astype(np.int64)))
    return parts[0], parts[1]


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether 100 * |a and b| >= percent * |a or b|, for sorted sets."""
    if not len(a) or not len(b):
        return False
    both = np.concatenate([a, b])
    both.sort()
    common = int((both[1:] == both[:-1]).sum())
    return 100 * common >= percent * (len(both) - common)
