"""Words and rolling window hashes of whole texts, inside Arrow tasks.

A word is a maximal run of bytes outside ``\\x20`` and ``\\x09-\\x0D``; a null
text has none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash

_CACHE = 400_000
_ODD = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_MASK = (1 << 64) - 1


class WordHashes(dict):
    """64-bit hash of a word, remembered; the memory is emptied when it is full."""

    def __init__(self, seed: int = 0) -> None:
        super().__init__()
        self.seed = seed

    def __missing__(self, word: bytes) -> int:
        if len(self) >= _CACHE:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word, self.seed)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mix(values: np.ndarray) -> np.ndarray:
    """Spreads every bit of a 64-bit value over all bits (a bijection)."""
    values = values ^ (values >> np.uint64(33))
    values = values * np.uint64(0xFF51AFD7ED558CCD)
    values = values ^ (values >> np.uint64(33))
    values = values * np.uint64(0xC4CEB9FE1A85EC53)
    return values ^ (values >> np.uint64(33))


class Windows:
    """Hash of every run of ``size`` consecutive words, by prefix sums."""

    def __init__(self, size: int, base: int = 0) -> None:
        self.size = size
        self.odd = _ODD[base]
        self.inverse = pow(self.odd, -1, 1 << 64)
        self.up = np.ones(0, np.uint64)
        self.down = self.up

    def _powers(self, n: int) -> None:
        if len(self.up) < n:
            n = max(n, 2 * len(self.up), 4096)
            for name, factor in (("up", self.odd), ("down", self.inverse)):
                steps = np.full(n, factor, np.uint64)
                steps[0] = 1
                setattr(self, name, np.multiply.accumulate(steps))

    def of(self, hashes: np.ndarray) -> np.ndarray:
        n = len(hashes) - self.size + 1
        if n <= 0:
            return np.zeros(0, np.uint64)
        self._powers(len(hashes))
        sums = np.zeros(len(hashes) + 1, np.uint64)
        np.cumsum(hashes * self.up[: len(hashes)], out=sums[1:])
        return mix((sums[self.size :] - sums[:n]) * self.down[:n] + np.uint64(self.size))


def texts(batch: pa.RecordBatch, column: int) -> Iterator[bytes]:
    """The UTF-8 bytes of each text; null counts as empty."""
    for value in batch.column(column).cast(pa.binary()):
        yield value.as_py() or b""


def shingles(hashes: np.ndarray, size: int, windows: Windows) -> np.ndarray:
    """The sorted set of shingle hashes: one for the whole text if it is shorter."""
    if not len(hashes):
        return np.zeros(0, np.uint64)
    if len(hashes) < size:
        return Windows(len(hashes)).of(hashes)
    return np.unique(windows.of(hashes))
