"""64-bit hashes of words and of word windows, vectorised."""
from __future__ import annotations

import numpy as np
import xxhash

#: Words remembered by one Python worker.
MAX_WORDS = 400_000
_ODD, _ADD = np.uint64(0x9E3779B97F4A7C15), np.uint64(0x2545F4914F6CDD1D)
_MORE = np.uint64(0xBF58476D1CE4E5B9)


class Words(dict):
    """word -> hash, computed when first met."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= MAX_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def array(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mix(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Hash of two neighbouring hashes; order counts."""
    x = (left * _ODD) ^ (right + _ADD)
    x ^= x >> np.uint64(29)
    x *= _MORE
    x ^= x >> np.uint64(32)
    return x * _ODD


def extend(hashes: np.ndarray, length: int, to: int) -> np.ndarray:
    """From the hashes of all windows of ``length`` those of length ``to``, at most twice as long, by joining two
    windows that overlap or touch."""
    step = to - length
    return mix(hashes[:-step], hashes[step:]) if len(hashes) > step else hashes[:0]


def windows(words: np.ndarray, length: int) -> np.ndarray:
    """Hashes of all windows of ``length`` words, by doubling."""
    have = 1
    while have < length and len(words):
        to = min(2 * have, length)
        words, have = extend(words, have, to), to
    return words
