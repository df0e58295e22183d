"""Words and their 64-bit hashes inside a task."""

from __future__ import annotations

import numpy as np
import xxhash

# Odd 64-bit multipliers (golden ratio and the finalizer of splitmix64).
GOLDEN = np.uint64(0x9E3779B97F4A7C15)
MIX_1 = np.uint64(0xBF58476D1CE4E5B9)
MIX_2 = np.uint64(0x94D049BB133111EB)

# ASCII punctuation becomes a space.
PUNCTUATION = bytes(32 if chr(b) in "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~" else b for b in range(256))


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of unsigned 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * MIX_1
    x = (x ^ (x >> np.uint64(27))) * MIX_2
    return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    """word bytes -> 64-bit hash; forgets everything once it holds ``limit`` words."""

    def __init__(self, limit: int = 150_000):
        self.limit = limit

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def ascii_words(text: str) -> list[bytes]:
    """Runs of anything but ASCII white space, A-Z in lower case."""
    return text.encode("utf-8", "surrogatepass").lower().split()


def plain_words(text: str) -> list[bytes]:
    """Lower-case words; ASCII punctuation separates them."""
    return text.lower().encode("utf-8", "surrogatepass").translate(PUNCTUATION).split()


def ngram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of ``n`` words; a shorter non-empty sequence is one run."""
    if len(words) < n:
        n = len(words)
        if n == 0:
            return words
    count = len(words) - n + 1
    total = np.full(count, n, np.uint64) * GOLDEN
    for i in range(n):
        total = mix(total * GOLDEN + words[i:i + count])
    return total
