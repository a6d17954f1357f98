"""Vectorised word, shingle and byte-window hashes over batches of texts.

A batch of texts is one byte buffer.  A polynomial prefix hash over it gives the hash of any
slice in one subtraction, so words and windows of all texts are hashed without a Python loop.
All arithmetic is modulo 2**64.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd

BASE = 0x9E3779B97F4A7C15
SLICE = 1 << 20
#: Slices whose 64-bit arrays stay in a core's cache.
CACHED = 1 << 17
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACE = np.zeros(256, bool)
SPACE[[32, *range(9, 14)]] = True
_rng = np.random.default_rng(20240229)
BYTE_CODE = _rng.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
WORD_FACTORS = _rng.integers(0, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the base and of its inverse; kept between calls up to a few slices."""
    if len(_powers[0]) < n:
        m = -(-(n - 1) // SLICE) * SLICE + 1
        made = [np.cumprod(np.concatenate([[np.uint64(1)], np.full(m - 1, x, np.uint64)]))
                for x in (BASE, pow(BASE, -1, 1 << 64))]
        if m > 16 * SLICE:
            return made[0], made[1]
        _powers[:] = made
    return _powers[0][:n], _powers[1][:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every bit of h over the word."""
    low = h >> np.uint64(32)
    h = h ^ low
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= np.right_shift(h, np.uint64(29), out=low)
    h *= np.uint64(0xA0761D6478BD642F)
    h ^= np.right_shift(h, np.uint64(32), out=low)
    return h


def encode(texts: Iterable) -> list[bytes]:
    """UTF-8 bytes; null counts as empty."""
    return [b"" if t is None or t is pd.NA or t != t else t.encode() for t in texts]


def batches(raw: list[bytes], limit: int = SLICE) -> Iterator[tuple[int, int]]:
    """Ranges of texts holding at most ``limit`` bytes together, or one longer text."""
    start = size = 0
    for i, b in enumerate(raw):
        if i > start and size + len(b) > limit:
            yield start, i
            start, size = i, 0
        size += len(b) + 1
    if start < len(raw):
        yield start, len(raw)


class Prefix:
    """Prefix hash over one buffer."""

    def __init__(self, data: np.ndarray):
        self.up, self.down = powers(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        code = BYTE_CODE[data]
        code *= self.up[:-1]
        np.cumsum(code, out=self.sums[1:])

    def windows(self, width: int) -> np.ndarray:
        """Unmixed hash of the ``width`` bytes at every position."""
        h = self.sums[width:] - self.sums[:-width]
        h *= self.down[: len(h)]
        return h

    def spans(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Mixed hash of bytes [start, end)."""
        h = (self.sums[end] - self.sums[start]) * self.down[start]
        return mix(h + (end - start).astype(np.uint64) * np.uint64(0x9FB21C651E98DF25))


class Words:
    """Lower-cased words of a batch of texts: place, hash and text index of each.

    Words are maximal runs without ASCII white space; only A-Z are lower-cased.
    """

    def __init__(self, raw: list[bytes]):
        self.texts = len(raw)
        data = LOWER[np.frombuffer(b" ".join([*raw, b""]), np.uint8)]
        self.offsets = np.zeros(len(raw) + 1, np.int64)
        np.cumsum([len(b) + 1 for b in raw], out=self.offsets[1:])
        inside = ~SPACE[data]
        edge = np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8))
        self.start, self.end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        self.text = np.searchsorted(self.offsets, self.start, "right") - 1
        self.count = np.bincount(self.text, minlength=self.texts)
        self.first = np.concatenate([[0], np.cumsum(self.count)])
        self.hash = Prefix(data).spans(self.start, self.end) if len(self.start) else np.zeros(0, np.uint64)

    def grams(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Index of the first word and hash of every k words that lie in one text."""
        n = len(self.hash) - k + 1
        if n <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        at = np.flatnonzero(self.text[:n] == self.text[k - 1 :])
        h = np.zeros(n, np.uint64)
        for j in range(k):
            h += self.hash[j : n + j] * WORD_FACTORS[j]
        return at, mix(h[at])

    def shingles(self, k: int) -> list[np.ndarray]:
        """Distinct k-word shingle hashes of each text; a shorter text is one shingle."""
        at, h = self.grams(k)
        cut = np.searchsorted(self.text[at], np.arange(self.texts + 1))
        out = []
        for i in range(self.texts):
            n = self.count[i]
            if 0 < n < k:
                w = self.hash[self.first[i] : self.first[i] + n]
                out.append(mix((w * WORD_FACTORS[:n]).sum(keepdims=True) + np.uint64(n)))
            else:
                out.append(np.unique(h[cut[i] : cut[i + 1]]))
        return out
