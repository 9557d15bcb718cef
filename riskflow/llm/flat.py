"""A batch of texts as one array of characters, with prefix hashes, so that words and n-grams are hashed without Python strings."""

from __future__ import annotations

from functools import lru_cache

import numpy as np

from .shared import mix

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_MASK = (1 << 64) - 1


@lru_cache(maxsize=1)
def char_hash() -> np.ndarray:
    """A fixed 64-bit number for each code point."""
    return mix(np.arange(0x110000, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95) + np.uint64(0x632BE59BD9B4E019))


@lru_cache(maxsize=4)
def char_class(kind: str) -> np.ndarray:
    """Whether each code point is a letter ("alpha"), a letter or number ("alnum"), or what patterns take for a letter
    ("letter": letters and numbers but decimal digits)."""
    if kind == "letter":
        return char_class("alnum") & ~char_class("decimal")
    return np.fromiter((getattr(chr(c), f"is{kind}")() for c in range(0x110000)), bool, 0x110000)


class _Powers:
    """Powers of a base modulo 2**64. The first 2**21 are kept; those of a longer sequence are made anew."""

    def __init__(self, base: int):
        self.base, self.values = base, np.ones(1, np.uint64)

    def upto(self, n: int) -> np.ndarray:
        values = self.values
        while len(values) < n:
            values = np.concatenate([values, values * np.uint64(pow(self.base, len(values), 1 << 64))])
            if len(values) <= 1 << 21:
                self.values = values
        return values[:n]


_up, _down = _Powers(_BASE), _Powers(_INVERSE)


class PrefixHash:
    """Hashes of any ranges of a sequence of 64-bit numbers; equal contents have equal hashes wherever they lie."""

    def __init__(self, values: np.ndarray):
        n = len(values)
        self.n, self.sums = n, np.zeros(n + 1, np.uint64)
        np.cumsum(values * _down.upto(n), out=self.sums[1:])

    def ranges(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Mixed hashes of values[start:end] for each pair; lengths count."""
        raw = (self.sums[end] - self.sums[start]) * _up.upto(self.n + 1)[start]
        return mix(raw + (end - start).astype(np.uint64) * np.uint64(0xA24BAED4963EE407))

    def windows(self, size: int) -> np.ndarray:
        """Mixed hashes of all windows of a size."""
        n = max(0, self.n - size + 1)
        raw = (self.sums[size : size + n] - self.sums[:n]) * _up.upto(self.n + 1)[:n]
        return mix(raw + np.uint64(size * 0xA24BAED4963EE407 & _MASK))


class PrimeHash:
    """A second hash of ranges, modulo a prime: sequences built to collide modulo a power of two don't collide here."""

    PRIME, BASE = (1 << 31) - 1, 1_103_515_245

    def __init__(self, values: np.ndarray):
        n, p = len(values), self.PRIME
        up, down = np.ones(n + 1, np.int64), np.ones(n + 1, np.int64)
        for powers, base in ((up, self.BASE), (down, pow(self.BASE, -1, p))):
            done = 1
            while done <= n:
                take = min(done, n + 1 - done)
                powers[done : done + take] = powers[:take] * pow(base, done, p) % p
                done += take
        self.up, terms = up, (values % np.uint64(p)).astype(np.int64) * down[:n] % p
        self.sums = np.append(0, np.cumsum(terms))

    def ranges(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hashes of values[start:end]; compare those of equal lengths only."""
        return (self.sums[end] - self.sums[start]) % self.PRIME * self.up[start] % self.PRIME


class FlatTexts:
    """Texts in lower case, one after the other, a line feed after each. None counts as empty."""

    def __init__(self, texts: list[str | None]):
        low = [(t or "").lower() for t in texts]
        self.length = np.fromiter(map(len, low), np.int64, len(low))
        self.end = np.cumsum(self.length + 1) - 1
        self.start = self.end - self.length
        self.codes = np.frombuffer(("\n".join(low) + "\n").encode("utf-32-le"), "<u4")

    def doc_of(self, at: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.end, at, side="right")

    def words(self, kind: str) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of the maximal runs of a character class."""
        inside = char_class(kind)[self.codes]
        edge = np.flatnonzero(np.diff(inside.view(np.int8), prepend=0, append=0))
        return edge[::2], edge[1::2]

    def hashes(self) -> PrefixHash:
        return PrefixHash(char_hash()[self.codes])


def per_doc(docs: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Counts of each of n documents in a sorted array of document numbers, and where each begins."""
    counts = np.bincount(docs, minlength=n)
    return counts, np.cumsum(counts) - counts
