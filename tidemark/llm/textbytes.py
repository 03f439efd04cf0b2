"""Words and shingles of many texts at once, on the bytes of an Arrow column.

A word is a run of bytes other than 0x20 and 0x09-0x0D; A-Z count as a-z. A word's hash is a polynomial over a random
table of byte values, taken from prefix sums, so any substring costs a subtraction and a product.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2**64
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
VALUES = np.random.default_rng(20240229).integers(1 << 40, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
BLANK = np.zeros(256, bool)
BLANK[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
STEPS = [np.uint64(pow(0xD6E8FEB86659FD93, i + 1, 1 << 64)) for i in range(8)]


def powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


class Powers:
    """Powers of the base and of its inverse, grown as needed and kept by the worker."""

    up, down = powers(BASE, 1 << 16), powers(INVERSE, 1 << 16)

    @classmethod
    def get(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > len(cls.up):
            cls.up, cls.down = powers(BASE, n * 5 // 4), powers(INVERSE, n * 5 // 4)
        return cls.up[:n], cls.down[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Words:
    """Words of a column of texts: ``start`` and ``end`` in ``data`` (lower-cased bytes), ``first[i]:first[i+1]`` those of text i."""

    def __init__(self, texts: pa.LargeBinaryArray):
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        whole = texts.buffers()[2]
        raw = np.frombuffer(whole, np.uint8)[offsets[0] : offsets[-1]] if whole is not None else np.zeros(0, np.uint8)
        self.bounds = offsets - offsets[0]
        self.data = LOWER[raw]
        inside = ~BLANK[raw]
        cut = np.zeros(len(raw) + 1, bool)
        cut[self.bounds] = True
        begins, ends = inside.copy(), inside.copy()
        begins[1:] &= ~inside[:-1] | cut[1:-1]
        ends[:-1] &= ~inside[1:] | cut[1:-1]
        self.start, self.end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
        self.first = np.searchsorted(self.start, self.bounds)
        self.doc = np.repeat(np.arange(len(texts)), np.diff(self.first))
        self._sums: np.ndarray | None = None

    def spans(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hashes of the substrings ``start:end``, before mixing."""
        up, down = Powers.get(len(self.data) + 1)
        if self._sums is None:
            self._sums = np.zeros(len(self.data) + 1, np.uint64)
            np.cumsum(VALUES[self.data] * up[:-1], out=self._sums[1:])
        return (self._sums[end] - self._sums[start]) * down[start]

    def hashes(self) -> np.ndarray:
        return mix(self.spans(self.start, self.end))


def shingle_sets(texts: pa.LargeBinaryArray, width: int = 5) -> tuple[np.ndarray, np.ndarray, Words]:
    """Distinct shingle hashes, ascending within each text, and where each text's begin.

    A text with fewer words than ``width`` has its whole sequence as its one shingle; one without words has none.
    """
    words = Words(texts)
    hashes, count = words.hashes(), np.diff(words.first)
    at = np.arange(len(hashes))
    long = at + width <= words.first[words.doc + 1]
    total = np.zeros(max(0, len(hashes) - width + 1), np.uint64)
    for i in range(width):
        total += hashes[i : i + len(total)] * STEPS[i]
    keep = long[: len(total)]
    values, docs = [mix(total[keep])], [words.doc[: len(total)][keep]]
    for n in range(1, width):
        short = np.flatnonzero(count == n)
        begin = words.first[short]
        values.append(mix(sum((hashes[begin + i] * STEPS[i] for i in range(n)), np.full(len(short), n * 0x632BE59BD9B4E019 % (1 << 64), np.uint64))))
        docs.append(short)
    value, doc = np.concatenate(values), np.concatenate(docs)
    order = np.lexsort((value, doc))
    value, doc = value[order], doc[order]
    fresh = np.ones(len(value), bool)
    fresh[1:] = (value[1:] != value[:-1]) | (doc[1:] != doc[:-1])
    value, doc = value[fresh], doc[fresh]
    return value, np.searchsorted(doc, np.arange(len(texts) + 1)), words
