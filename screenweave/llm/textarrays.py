"""Whole texts as flat numpy arrays: words, hashes and shingles of a batch of documents.

All functions work on a batch of texts at once, cost O(bytes) and keep no state. Words are the
maximal runs of bytes outside 0x20 and 0x09-0x0D, after lower-casing A-Z. A null text counts as empty.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True

_rng = np.random.Generator(np.random.PCG64(20240607))
_BYTE = _rng.integers(1, 2**64 - 1, 256, dtype=np.uint64) | np.uint64(1)
_STEP = int(_rng.integers(1, 2**63, dtype=np.uint64)) | 1


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective finalizer of 64-bit values, so that every bit depends on every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> np.ndarray:
    out = np.full(max(n, 1), _STEP, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


@dataclass
class Words:
    """Words of a batch: `data` holds the lower-cased bytes; word k spans start[k]:end[k] and belongs to document doc[k]."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray
    n_docs: int

    def counts(self) -> np.ndarray:
        return np.bincount(self.doc, minlength=self.n_docs)

    def first(self) -> np.ndarray:
        """Index of each document's first word; one more entry closes the last."""
        return np.concatenate([[0], np.cumsum(self.counts())])

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word."""
        if not len(self.start):
            return np.zeros(0, dtype=np.uint64)
        length = self.end - self.start
        inside = np.repeat(self.start - np.concatenate([[0], np.cumsum(length)[:-1]]), length)
        at = inside + np.arange(len(inside))
        offset = at - np.repeat(self.start, length)
        value = _BYTE[self.data[at]] * _powers(int(length.max()))[offset]
        begin = np.concatenate([[0], np.cumsum(length)[:-1]])
        return mix64(np.add.reduceat(value, begin) + length.astype(np.uint64))


def words(texts) -> Words:
    raw = [b"" if t is None else t.encode("utf-8", "surrogatepass") for t in texts]
    size = np.fromiter((len(b) + 1 for b in raw), dtype=np.int64, count=len(raw))
    data = _LOWER[np.frombuffer(b" ".join([*raw, b""]), dtype=np.uint8)] if raw else np.zeros(0, np.uint8)
    solid = ~_SPACE[data]
    edge = np.diff(np.concatenate([[False], solid, [False]]).astype(np.int8))
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    doc = np.searchsorted(np.cumsum(size), start, side="right")
    return Words(data, start, end, doc, len(raw))


def windows(hashes: np.ndarray, n: int) -> np.ndarray:
    """Karp-Rabin value of every run of n consecutive hashes of the flat array (runs that cross documents included)."""
    count = max(0, len(hashes) - n + 1)
    out = np.zeros(count, dtype=np.uint64)
    for k in range(n):
        out = out * np.uint64(_STEP) + hashes[k : k + count]
    return mix64(out)


def shingles(texts, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(document, hash) of the distinct n-word shingles, sorted. With 1 to n-1 words, the whole sequence is the one shingle; without words, none."""
    w = words(texts)
    h, count, first = w.hashes(), w.counts(), w.first()
    at = np.arange(max(0, len(h) - n + 1))
    inside = w.doc[at] == w.doc[at + n - 1] if len(at) else np.zeros(0, bool)
    doc, value = w.doc[at][inside], windows(h, n)[inside]
    few = np.flatnonzero((count > 0) & (count < n))
    if len(few):
        short = []
        for d in few:
            x = np.array([count[d]], dtype=np.uint64)
            for k in range(first[d], first[d + 1]):
                x = x * np.uint64(_STEP) + h[k]
            short.append(x)
        doc, value = np.concatenate([doc, few]), np.concatenate([value, mix64(np.concatenate(short) ^ np.uint64(0x5BD1E995))])
    if len(few):
        order = np.argsort(doc, kind="stable")
        doc, value = doc[order], value[order]
    cut = np.searchsorted(doc, np.arange(w.n_docs + 1))
    for lo, hi in zip(cut[:-1], cut[1:]):
        if hi - lo > 1:
            value[lo:hi].sort()
    keep = np.ones(len(doc), dtype=bool)
    keep[1:] = (doc[1:] != doc[:-1]) | (value[1:] != value[:-1])
    return doc[keep], value[keep]
