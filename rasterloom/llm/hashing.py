"""Words as 64-bit hashes: many words at once, few of them hashed anew."""

from __future__ import annotations

import numpy as np
import xxhash

#: Words that are remembered, and the length up to which they are.
HELD, HELD_BYTES = 1 << 18, 64
# Odd multipliers and shifts of the public 64-bit finalizer of MurmurHash3.
_FIRST, _SECOND, _SHIFT = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53), np.uint64(33)


class Hashes(dict):
    """XXH64 of words (bytes), but for ``fixed`` ones.

    It forgets all others when it holds ``HELD``; longer words are hashed each time.
    """

    def __init__(self, seed: int = 42, fixed: dict[bytes, int] | None = None):
        super().__init__(fixed or {})
        self.seed, self.fixed = seed, fixed or {}

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh64_intdigest(word, self.seed)
        if len(word) <= HELD_BYTES:
            if len(self) >= HELD:
                self.clear()
                self.update(self.fixed)
            self[word] = value
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mixed(value: np.ndarray) -> np.ndarray:
    """A one-to-one scramble of 64-bit numbers."""
    value = (value ^ (value >> _SHIFT)) * _FIRST
    value = (value ^ (value >> _SHIFT)) * _SECOND
    return value ^ (value >> _SHIFT)


def chained(first: np.ndarray, *rest: np.ndarray) -> np.ndarray:
    """One hash of several hashes in their order."""
    for other in rest:
        first = mixed(first * np.uint64(0x9E3779B97F4A7C15) + other)
    return first
