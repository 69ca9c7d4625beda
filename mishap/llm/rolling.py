"""Hashes of words, of runs of words, and of sets of them, as numpy arrays."""

from __future__ import annotations

import numpy as np
import xxhash

WORD_CACHE = 200_000
_MULTIPLIERS = (
    np.uint64(0x9E3779B97F4A7C15),
    np.uint64(0xC2B2AE3D27D4EB4F),
    np.uint64(0x165667B19E3779F9),
)


class WordDigests(dict):
    """64-bit digests of words, computed on first use; starts again when it has grown large."""

    def __missing__(self, word: bytes) -> bytes:
        digest = self[word] = xxhash.xxh3_64_digest(word)
        return digest

    def array(self, words: list[bytes]) -> np.ndarray:
        if len(self) > WORD_CACHE:
            self.clear()
        return np.frombuffer(b"".join(map(self.__getitem__, words)), np.uint64)


DIGESTS = WordDigests()


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _MULTIPLIERS[2]
    return x ^ (x >> np.uint64(29))


def chain(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Hash of a sequence from the hashes of its two parts."""
    return mix(x * _MULTIPLIERS[0] + y * _MULTIPLIERS[1])


def runs(h: np.ndarray, length: int) -> np.ndarray:
    """Hash of every ``length`` consecutive entries, by doubling; empty if there are fewer."""
    if len(h) < length:
        return np.zeros(0, np.uint64)
    result, done, power, size = None, 0, h, 1
    while True:
        if length & size:
            if result is None:
                result = power
            else:
                n = len(h) - done - size + 1
                result = chain(result[:n], power[done : done + n])
            done += size
        if done == length:
            return result
        power = chain(power[: len(power) - size], power[size:])
        size *= 2


def least_places(h: np.ndarray, width: int) -> np.ndarray:
    """Place of the least entry, the last of equals, in every window of ``width`` entries."""
    n = len(h) - width + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    places, size = np.arange(len(h)), 1

    def later(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.where(h[b] <= h[a], b, a)

    while 2 * size <= width:
        places = later(places[: len(places) - size], places[size:])
        size *= 2
    return later(places[:n], places[width - size : width - size + n])
