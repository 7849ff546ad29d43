"""Words, their hashes and running hashes, vectorised over the documents of an Arrow batch."""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import xxhash

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))

_MIX_1 = np.uint64(0xBF58476D1CE4E5B9)
_MIX_2 = np.uint64(0x94D049BB133111EB)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_BASE = np.uint64(0xD6E8FEB86659FD93)

# Entries a task keeps of its word cache before it starts anew; a bound on memory only.
MAX_CACHE = 400_000


def split(text: str | None, lower: bool = False) -> list[bytes]:
    """UTF-8 words of a text: maximal runs without blank, tab, line feed, vertical tab, form feed or return.

    These are just the bytes at which ``bytes.split`` splits; bytes of other characters are above 0x7F.
    """
    data = (text or "").encode("utf-8")
    return (data.translate(_LOWER) if lower else data).split()


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * _MIX_1
    x = (x ^ (x >> np.uint64(27))) * _MIX_2
    return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    """Cache from word to 64-bit hash."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= MAX_CACHE:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: Iterable[bytes], count: int) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), dtype=np.uint64, count=count)


def windows(hashes: np.ndarray, size: int, salt: int = 0) -> np.ndarray:
    """64-bit hashes of all runs of ``size`` consecutive words, by doubling."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    with np.errstate(over="ignore"):
        total = np.zeros(n, np.uint64)
        for i in range(size):
            total = total * _BASE + hashes[i : i + n]
        return mix(total + np.uint64(salt) * _STEP)


def whole(hashes: np.ndarray) -> int:
    """64-bit hash of one whole sequence."""
    return int(windows(hashes, len(hashes))[0]) if len(hashes) else 0


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)
