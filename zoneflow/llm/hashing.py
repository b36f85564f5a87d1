"""Hashes of words, shingles and byte windows over whole arrays; 64-bit arithmetic wraps on purpose."""

from __future__ import annotations

from hashlib import blake2b

import numpy as np

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
BLANKS = np.zeros(256, bool)
BLANKS[[9, 10, 11, 12, 13, 32]] = True
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every input bit over the whole word (the finalizer of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def byte_values(seed: int) -> np.ndarray:
    """A fixed random 64-bit value for each byte."""
    return mix(np.arange(1, 257, dtype="u8") * np.uint64(_BASE) + np.uint64(seed))


_VALUES = byte_values(1)


def powers(n: int, base: int) -> np.ndarray:
    out = np.full(n, np.uint64(base))
    if n:
        out[0] = 1
    return np.multiply.accumulate(out)


class Rolling:
    """Hashes of substrings by differences of prefix sums, independent of where they lie."""

    def __init__(self, longest: int = 1 << 16, values: np.ndarray = _VALUES):
        self.values = values
        self._grow(longest)

    def _grow(self, n: int) -> None:
        self.up, self.down = powers(n, _BASE), powers(n, _INVERSE)

    def prefix(self, data: np.ndarray) -> np.ndarray:
        if len(data) > len(self.up):
            self._grow(2 * len(data))
        out = np.zeros(len(data) + 1, "u8")
        np.cumsum(self.values[data] * self.up[: len(data)], out=out[1:])
        return out

    def between(self, prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hash of ``data[start:end]`` for each pair of positions (start below the length of the data)."""
        return (prefix[end] - prefix[start]) * self.down[start]


class WordHashes(dict):
    """64 bits of BLAKE2b under a secret key for each word, remembered while there is room.

    Rolling hashes of bytes can be made to collide by whoever writes the texts; under a key drawn for the run nobody can
    aim at a collision, and one by chance needs about 2^32 distinct words that meet in one comparison.
    """

    ROOM = 60_000

    def __init__(self, key: bytes):
        super().__init__()
        self.key = key

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.ROOM:
            self.clear()
        value = self[word] = int.from_bytes(blake2b(word, digest_size=8, key=self.key).digest(), "little")
        return value

    def of(self, data: bytes, piece: int = 1 << 20) -> np.ndarray:
        """One hash per word of lower-cased bytes, in order; words are what ASCII white space separates.

        Works in pieces of about ``piece`` bytes cut at white space, so memory does not follow the text.
        """
        out, at = [], 0
        while at < len(data):
            end = min(len(data), at + piece)
            while end < len(data) and not BLANKS[data[end]]:
                end += 1
            words = data[at:end].split()
            out.append(np.fromiter(map(self.__getitem__, words), "u8", len(words)))
            at = end
        return np.concatenate(out) if out else np.empty(0, "u8")


def shingle_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of ``k`` words; fewer words make one run of them all, no words none."""
    if not len(words):
        return words
    n = min(k, len(words))
    h = np.full(len(words) - n + 1, np.uint64(n))
    for i in range(n):
        h = mix(h * np.uint64(_BASE) + words[i : len(words) - n + 1 + i])
    return h
