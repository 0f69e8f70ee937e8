"""Words, 64-bit word hashes and shingle hashes of one text, in numpy."""

from __future__ import annotations

from hashlib import blake2b

import numpy as np

MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


class WordHashes(dict):
    """64-bit hash of a word's bytes, remembered up to ``limit`` words."""

    def __init__(self, limit: int = 150_000):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        h = self[word] = int.from_bytes(blake2b(word, digest_size=8).digest(), "little")
        return h

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def words(text: bytes | None) -> list[bytes]:
    """Words [^\\x20\\x09-\\x0D]+ of UTF-8 text with A-Z lower-cased."""
    return text.lower().split() if text else []


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit integers (a bijection)."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def shingle_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` words, in order; fewer words give one
    hash of the whole sequence, no words give none."""
    n = len(hashes)
    if n == 0:
        return hashes
    width = min(n, size)
    acc = np.full(n - width + 1, width, np.uint64)
    for j in range(width):
        acc = mix(acc * MULTIPLIER + hashes[j:n - width + 1 + j])
    return acc


def shingle_set(hashes: np.ndarray, size: int) -> np.ndarray:
    """Sorted distinct shingle hashes."""
    return np.unique(shingle_hashes(hashes, size))
