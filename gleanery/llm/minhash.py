"""MinHash signatures in bands, with the number of bands taken from the collision curve."""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterable, Sequence

import numpy as np

_PRIME = (1 << 61) - 1


def bands_for(similarity: float, recall: float, rows: int) -> int:
    """The least number of bands of ``rows`` rows with which two sets of that similarity collide
    with probability ``recall``: 1 - (1 - s^r)^b >= recall."""
    return math.ceil(math.log(1 - recall) / math.log(1 - similarity**rows))


class Banding:
    """``keys(shingles)`` gives one 64-bit key per band; equal sets give equal keys."""

    def __init__(self, bands: int, rows: int, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.bands, self.rows = bands, rows
        self.a = rng.integers(1, 1 << 31, bands * rows, dtype=np.uint64)
        self.b = rng.integers(0, 1 << 31, bands * rows, dtype=np.uint64)
        self.mix = rng.integers(1, 1 << 62, rows, dtype=np.uint64) | np.uint64(1)

    def keys(self, shingles: Iterable[str]) -> np.ndarray:
        return self.keys_of([shingles])[0]

    def keys_of(self, sets: Sequence[Iterable[str]]) -> np.ndarray:
        """A row of keys for each set of shingles; no set may be empty."""
        hashed = [[zlib.crc32(s.encode()) for s in x] for x in sets]
        h = np.array([v for x in hashed for v in x], np.uint64)
        starts = np.concatenate(([0], np.cumsum([len(x) for x in hashed])[:-1]))
        low = np.minimum.reduceat((h[:, None] * self.a + self.b) % np.uint64(4294967291), starts, axis=0)
        with np.errstate(over="ignore"):
            k = (low.reshape(len(hashed), self.bands, self.rows) * self.mix).sum(axis=2, dtype=np.uint64)
            k = (k ^ (np.arange(self.bands, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))) * np.uint64(0xBF58476D1CE4E5B9)
        return k.view(np.int64)


def grams(text: str, q: int, pad: str = "_") -> set[str]:
    """Padded q-grams of one string."""
    t = pad * (q - 1) + text + pad * (q - 1)
    return {t[i : i + q] for i in range(len(t) - q + 1)}


def edits(a: str, b: str, most: int) -> int:
    """Optimal string alignment distance (insert, delete, substitute, swap neighbours); ``most + 1``
    as soon as it must be larger than ``most``."""
    if abs(len(a) - len(b)) > most:
        return most + 1
    if a == b:
        return 0
    while a and b and a[0] == b[0]:
        a, b = a[1:], b[1:]
    while a and b and a[-1] == b[-1]:
        a, b = a[:-1], b[:-1]
    if not a or not b:
        return min(len(a) + len(b), most + 1)
    two, one = None, list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            d = min(one[j] + 1, row[j - 1] + 1, one[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                d = min(d, two[j - 2] + 1)
            row.append(d)
        if min(row) > most:
            return most + 1
        two, one = one, row
    return min(one[-1], most + 1)
