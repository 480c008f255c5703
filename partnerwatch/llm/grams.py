"""Hashes of words and word n-grams of whole texts."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import xxhash

KEPT_WORDS = 100_000
_M = np.uint64(0x9E3779B97F4A7C15)


class WordHashes(dict):
    """64-bit hash of a word (bytes), 0 for words that ``normal`` makes empty;
    kept for a bounded number of words."""

    def __init__(self, normal: Callable[[bytes], bytes] | None = None) -> None:
        super().__init__()
        self.normal = normal

    def __missing__(self, word: bytes) -> int:
        if len(self) >= KEPT_WORDS:
            self.clear()
        form = self.normal(word) if self.normal else word
        self[word] = value = (xxhash.xxh3_64_intdigest(form) or 1) if form else 0
        return value

    def of(self, text: str | None) -> np.ndarray:
        """Hashes of the words ``[^\\x20\\x09-\\x0D]+`` of ``text``, A-Z lower-cased."""
        words = (text or "").encode("utf-8", "surrogatepass").lower().split()
        found = np.fromiter(map(self.__getitem__, words), np.uint64, len(words))
        return found[found != 0] if self.normal else found


def mix(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (the finaliser of a multiplicative hash)."""
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    return h ^ (h >> np.uint64(33))


def ngrams(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of ``n`` words, in text order."""
    if len(words) < n:
        return np.empty(0, np.uint64)
    h = np.full(len(words) - n + 1, n, np.uint64)
    for i in range(n):
        h = (h ^ words[i : len(words) - n + 1 + i]) * _M
        h ^= h >> np.uint64(29)
    return mix(h)


def shingle_set(words: np.ndarray, n: int = 5) -> np.ndarray:
    """Distinct shingles, ascending; a shorter text is one shingle."""
    if len(words) < n:
        return ngrams(words, len(words)) if len(words) else np.empty(0, np.uint64)
    return np.unique(ngrams(words, n))
