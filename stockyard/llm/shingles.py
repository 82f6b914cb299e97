"""Word hashes and hashed runs of words."""

from __future__ import annotations

import hashlib
import re

import numpy as np

words_of = re.compile(r"[^\x20\x09-\x0D]+").findall
MIX = np.uint64(0x9E3779B97F4A7C15)
KEPT = 250_000


def hash64(data: str) -> int:
    """Signed 64-bit hash, the same in every process."""
    return int.from_bytes(hashlib.blake2b(data.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


class WordHashes(dict):
    """Hash of a word, kept for the words met so far; emptied when large."""

    def __missing__(self, word: str) -> int:
        if len(self) > KEPT:
            self.clear()
        value = self[word] = hash64(word) & 0xFFFFFFFFFFFFFFFF
        return value

    def of(self, words: list[str]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), dtype=np.uint64, count=len(words))


def window_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit hash of every run of ``size`` words."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    out = np.zeros(n, dtype=np.uint64)
    for i in range(size):
        out = (out * MIX) ^ words[i : i + n]
        out ^= out >> np.uint64(29)
    return out * MIX


def shingle_set(words: np.ndarray, size: int) -> np.ndarray:
    """Sorted distinct shingles; a text with fewer words is one shingle, one without words has none."""
    return np.unique(window_hashes(words, min(size, len(words)))) if len(words) else words
