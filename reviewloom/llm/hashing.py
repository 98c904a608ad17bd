"""Hashes of words and of windows of words inside tasks: numpy over whole batches of texts."""

from __future__ import annotations

import numpy as np
import xxhash

#: Word hashes that a task remembers; all are forgotten when there are more.
REMEMBERED = 500_000
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)
_S29, _S32 = np.uint64(29), np.uint64(32)


def mix(x: np.ndarray) -> np.ndarray:
    """Scatters 64-bit numbers; equal numbers stay equal, different ones different."""
    x = x ^ (x >> _S32)
    x *= _B
    x ^= x >> _S29
    x *= _A
    x ^= x >> _S32
    return x


class WordHashes(dict):
    """64-bit hashes by word."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        found = self[word] = xxhash.xxh3_64_intdigest(word)
        return found

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def spaced_words(text: str | None, lower: bool = False) -> list[bytes]:
    """Words that ASCII white space parts, as UTF-8; with lower, A-Z in lower case."""
    data = (text or "").encode("utf-8", "surrogatepass")
    return (data.lower() if lower else data).split()


def windows(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash of each window of `size` numbers; none if there are fewer. Built by doubling."""
    n = len(hashes) - size + 1
    if n <= 0:
        return hashes[:0]
    power, of_power, done, found = 1, mix(hashes + _A), 0, None
    while True:
        if size & power:
            part = of_power[done:done + n]
            found = part if found is None else mix(found * _A + part)
            done += power
        power *= 2
        if power > size:
            return found
        half = power // 2
        of_power = mix(of_power[:-half] * _A + of_power[half:])
