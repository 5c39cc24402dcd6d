"""Words, word hashes and shingle hashes shared by the operators that read texts in tasks."""

from __future__ import annotations

import numpy as np
import xxhash

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_MIX_1, _MIX_2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_S33 = np.uint64(33)


class WordHashes(dict):
    """word -> 64-bit hash, computed on first use; emptied when it holds ``limit`` words."""

    def __init__(self, limit: int = 100_000):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def words_of(data: bytes | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` with A-Z in lower case; none for a null text.

    ``bytes.lower`` and ``bytes.split`` know exactly those letters and separators.
    """
    return data.lower().split() if data else []


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _S33)) * _MIX_1
    x = (x ^ (x >> _S33)) * _MIX_2
    return x ^ (x >> _S33)


def shingle_hashes(hashes: np.ndarray, width: int) -> np.ndarray:
    """64-bit hashes of all runs of ``width`` words, in order, repeats included.

    A text of fewer words is one run; the run's length takes part in its hash.
    """
    n = len(hashes)
    if n == 0:
        return hashes
    width = min(width, n)
    with np.errstate(over="ignore"):
        total = np.full(n - width + 1, width, np.uint64)
        for i in range(width):
            total = total * _MULTIPLIER + hashes[i:n - width + 1 + i]
        return mixed(total)
