"""Runs of repeated words: maximal stretches of a text in which the words repeat with a period.

The method is the linear one of Gusfield and Stoye for tandem repeats (a square is a stretch twice as long as its period),
over words instead of letters, for all texts of a chunk at once, with separators that occur once:

1. `Factors` names all stretches whose length is a power of two; this gives suffix ranks, the longest common extension of
   two places in both directions, and the suffix tree: a place in the tree is an interval of suffix ranks and a depth.
2. `_covering`: the Lempel-Ziv blocks. The leftmost square of each kind crosses an end of a block, within a length that
   the block and its successor bound, so comparing around these ends finds a covering set of leftmost squares.
3. `_vocabulary`: from the marked places of these, suffix-link walks. Leaving out the first word and entering the edge of
   that word behind leads to the next rotation of the square, until the edge is missing or a marked place is reached.
   Steps that the text itself continues are made together.
4. `located`: the suffixes below each marked place are the occurrences of that kind of square; neighbours of the same
   period merge into runs. Squares of squares are left out by their divisors, so this list has n log n entries at most.

Before, `stretches` finds where a run of the least exponent E can be at all. In a run of period q every word but the first q
has occurred at most q words before, over at least (E - 1) q words: a segment of L such words has no longer period than
L / (E - 1), words whose last occurrence is farther back split it, and so on until nothing changes. Stretches that hold no
run of that exponent don't need the tree; all runs lie whole in one stretch.

Texts are read whole and stay in their task: a map without a shuffle. A chunk has about 500,000 characters or is one text;
working memory is some 200 bytes for each word of the chunk's stretches.

Defined results: null and empty texts have no words, no runs and an empty collapsed text. Words are maximal runs of
characters other than space and U+0009 to U+000D, compared exactly. Repeated rows give their rows each; null keys are kept;
other columns are not looked at. No rows give no rows.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Callable, Iterator
from itertools import chain, count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from screenweave.llm.common import chunks, table, tidy

#: A run has at least this length and this multiple of its period.
MIN_LENGTH, MIN_EXPONENT = 6, 4
Edit = Callable[[str, list[bytes]], list[bytes]]


class Factors:
    """Ranks of all stretches of 2^k words of a sequence of numbers whose last one occurs once."""

    def __init__(self, s: np.ndarray):
        n = self.n = len(s)
        self.s = s
        rank = np.unique(s, return_inverse=True)[1].astype(np.int64)
        self.ranks = [rank.astype(np.int32)]
        while rank.max(initial=0) + 1 < n:
            step = 1 << (len(self.ranks) - 1)
            key = rank * (n + 1)
            key[: n - step] += rank[step:] + 1
            order = np.argsort(key)
            ordered = key[order]
            rank = np.empty(n, np.int64)
            rank[order] = np.cumsum(np.concatenate([[0], ordered[1:] != ordered[:-1]]))
            self.ranks.append(rank.astype(np.int32))
        self.rank = self.ranks[-1].astype(np.int64)
        self.suffix = np.empty(n, np.int64)
        self.suffix[self.rank] = np.arange(n)
        lcp = np.zeros(n, np.int32)
        lcp[1:] = self.forward(self.suffix[:-1], self.suffix[1:])
        self.least = [lcp]
        while 1 << len(self.least) <= n:
            low, step = self.least[-1], 1 << (len(self.least) - 1)
            self.least.append(np.minimum(low[: len(low) - step], low[step:]))

    def forward(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many words from i and from another place j on are the same."""
        i, j, out = i.copy(), j.copy(), np.zeros(len(i), np.int64)
        for k in range(len(self.ranks) - 1, -1, -1):
            step = np.where(self.ranks[k][i] == self.ranks[k][j], 1 << k, 0)
            i += step
            j += step
            out += step
        return out

    def backward(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many words are the same that end with i and with another place j; places before the first have none."""
        i, j, out = i.copy(), j.copy(), np.zeros(len(i), np.int64)
        for k in range(len(self.ranks) - 1, -1, -1):
            size = 1 << k
            there = (i >= size - 1) & (j >= size - 1)
            a, b = np.maximum(i - size + 1, 0), np.maximum(j - size + 1, 0)
            step = np.where(there & (self.ranks[k][a] == self.ranks[k][b]), size, 0)
            i -= step
            j -= step
            out += step
        return out

    def place(self, i: np.ndarray, depth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The place in the suffix tree of the `depth` words from i on: first and last rank of the suffixes below it."""
        low = self.rank[i]
        high = low.copy()
        for k in range(len(self.least) - 1, -1, -1):
            least, size = self.least[k], 1 << k
            at = low - size + 1
            low = np.where((at >= 1) & (least[np.clip(at, 0, len(least) - 1)] >= depth), low - size, low)
            at = high + 1
            high = np.where((at + size <= self.n) & (least[np.clip(at, 0, len(least) - 1)] >= depth), high + size, high)
        return low, high

    def below(self, low: np.ndarray, high: np.ndarray, depth: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of the places (low, high, depth), the first rank whose suffix goes on with `word`, and whether there is one."""
        lo, hi = low.copy(), high + 1
        while (open_ := lo < hi).any():
            mid = np.where(open_, (lo + hi) // 2, lo)
            less = open_ & (self.ranks[0][np.minimum(self.suffix[np.minimum(mid, self.n - 1)] + depth, self.n - 1)] < word)
            lo = np.where(less, mid + 1, lo)
            hi = np.where(open_ & ~less, mid, hi)
        at = np.minimum(lo, self.n - 1)
        return at, (lo <= high) & (self.ranks[0][np.minimum(self.suffix[at] + depth, self.n - 1)] == word)


def _neighbours(suffix: list[int]) -> tuple[list[int], list[int]]:
    """For each place, the nearest suffixes by rank, before and behind, that begin earlier (-1: none)."""
    n = len(suffix)
    before, behind, stack = [-1] * n, [-1] * n, []
    for p in suffix:
        while stack and stack[-1] > p:
            behind[stack.pop()] = p
        if stack:
            before[p] = stack[-1]
        stack.append(p)
    return before, behind


def _blocks(f: Factors) -> np.ndarray:
    """Begins of the Lempel-Ziv blocks: each is the longest stretch that also begins earlier, or one new word."""
    size = np.zeros(f.n, np.int64)
    for near in _neighbours(f.suffix.tolist()):
        near = np.array(near)
        at = np.flatnonzero(near >= 0)
        size[at] = np.maximum(size[at], f.forward(at, near[at]))
    jump, out, h = np.maximum(size, 1).tolist(), [], 0
    while h < f.n:
        out.append(h)
        h += jump[h]
    return np.array(out)


def _pairs(count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, k) for k from 1 to count[row]."""
    row = np.repeat(np.arange(len(count)), count)
    return row, np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count) + 1


def _factored(k: int) -> list[int]:
    """The prime divisors of k."""
    out, d = [], 2
    while d * d <= k:
        if k % d == 0:
            out.append(d)
            while k % d == 0:
                k //= d
        d += 1
    return out + [k] * (k > 1)


def _covering(f: Factors) -> np.ndarray:
    """Rows (start, end, period): the stretches around the blocks' ends that hold the leftmost square of each kind, periods primitive."""
    h = _blocks(f)
    end = np.append(h[1:], f.n)
    size = end - h
    after = np.append(size[1:], 0)
    # centre and start in the block, end behind it
    row, k = _pairs(size)
    keep = end[row] < f.n
    row, k = row[keep], k[keep]
    b, q = end[row], end[row] - k
    right, left = f.forward(b, q), f.backward(b - 1, q - 1)
    ok = (left + right >= k) & (right > 0)
    first = np.stack([q - left, b + right, k], axis=1)[ok]
    # start before the block, centre in it
    row, k = _pairs(size + after)
    keep = (h[row] > 0) & (h[row] + k < f.n)
    row, k = row[keep], k[keep]
    b, q = h[row], h[row] + k
    right, left = f.forward(b, q), f.backward(b - 1, q - 1)
    ok = (left + right >= k) & (left > 0)
    second = np.stack([b - left, q + right, k], axis=1)[ok]
    found = np.unique(np.concatenate([first, second]), axis=0)
    periods, of = np.unique(found[:, 2], return_inverse=True)
    divisors = [_factored(k) for k in periods.tolist()]
    flat, size = np.array([p for d in divisors for p in d], dtype=np.int64), np.array([len(d) for d in divisors], dtype=np.int64)
    row, step = _pairs(size[of])
    part = found[row, 2] // flat[(np.cumsum(size) - size)[of[row]] + step - 1]
    divides = f.forward(found[row, 0], found[row, 0] + part) >= found[row, 1] - found[row, 0] - part
    primitive = np.ones(len(found), dtype=bool)
    primitive[row[divides]] = False
    return found[primitive]


def _vocabulary(f: Factors, covering: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(low, high, period) of each kind of square: its place in the suffix tree."""
    at, end, k = covering.T if len(covering) else np.zeros((3, 0), np.int64)
    left = k.copy()  # rotations that a walk may still make
    marked = np.zeros(0, np.int64)
    kinds = [np.zeros((0, 3), np.int64)]
    while len(at):
        steps = np.minimum(end - 2 * k - at + 1, left)
        row, step = _pairs(steps)
        low, high = f.place(at[row] + step - 1, 2 * k[row])
        key = low * (f.n + 1) + k[row]
        _, first = np.unique(key, return_index=True)
        new = first[~np.isin(key[first], marked, assume_unique=True)]
        kinds.append(np.stack([low[new], high[new], k[row][new]], axis=1))
        marked = np.concatenate([marked, key[new]])
        # a walk goes on from its last rotation if that one is new
        last = np.cumsum(steps) - 1
        go = np.flatnonzero(np.isin(last, new) & (left > steps))
        i, period, left = at[go] + steps[go] - 1, k[go], (left - steps)[go]
        low, high = f.place(i + 1, 2 * period - 1)  # the suffix link
        to, found = f.below(low, high, 2 * period - 1, f.ranks[0][i].astype(np.int64))
        at, k, left = f.suffix[to][found], period[found], left[found]
        end = at + k + f.forward(at, at + k)
    out = np.concatenate(kinds)
    return out[:, 0], out[:, 1], out[:, 2]


def located(s: np.ndarray) -> np.ndarray:
    """Rows (start, length, period), in order: all runs of exponent 2 or more of a sequence of numbers whose last one occurs once."""
    if len(s) < 3:
        return np.zeros((0, 3), np.int64)
    f = Factors(s)
    low, high, k = _vocabulary(f, _covering(f))
    row, step = _pairs(high - low + 1)
    at, k = f.suffix[low[row] + step - 1], k[row]
    order = np.lexsort((at, k))
    at, k = at[order], k[order]
    new = np.flatnonzero(np.concatenate([[True], (k[1:] != k[:-1]) | (at[1:] != at[:-1] + 1)])) if len(at) else np.zeros(0, int)
    last = np.append(new[1:], len(at)) - 1
    runs = np.stack([at[new], at[last] - at[new] + 2 * k[new], k[new]], axis=1) if len(at) else np.zeros((0, 3), np.int64)
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def stretches(ids: np.ndarray, doc: np.ndarray, min_length: int, min_exponent: int) -> list[tuple[int, int]]:
    """(begin, end) of the stretches outside which no document has a run of this length and exponent; each run lies in one of them."""
    n, e = len(ids), min_exponent - 1
    least = min(max(e * q, min_length - q) for q in range(1, min_length + 1))
    order = np.lexsort((ids, doc))
    back = np.full(n, n + 1, np.int64)
    same = (ids[order[1:]] == ids[order[:-1]]) & (doc[order[1:]] == doc[order[:-1]])
    back[order[1:][same]] = order[1:][same] - order[:-1][same]
    at = np.flatnonzero(back <= n)
    while True:
        new = np.concatenate([[True], (at[1:] != at[:-1] + 1) | (doc[at[1:]] != doc[at[:-1]])]) if len(at) else np.zeros(0, bool)
        segment = np.cumsum(new) - 1
        size = np.bincount(segment, minlength=0)[segment] if len(at) else np.zeros(0, int)
        keep = (size >= least) & (back[at] * e <= size)
        if keep.all():
            break
        at = at[keep]
    begin = at[new]
    length = np.bincount(segment) if len(at) else np.zeros(0, int)
    first = np.searchsorted(doc, doc[begin])  # of the document
    out: list[tuple[int, int]] = []
    for b, size, lowest in zip(begin.tolist(), length.tolist(), first.tolist()):
        lo, hi = max(lowest, b - size // e), b + size
        while out and out[-1][1] >= lo and out[-1][1] > lowest:
            lo = min(lo, out.pop()[0])
        out.append((lo, hi))
    return out


def runs(texts: list[list[bytes]], min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT) -> list[np.ndarray]:
    """For each text, given as its words, rows (start, length, period) of its runs by start and period."""
    if min_exponent < 2:
        raise ValueError("runs have an exponent of 2 or more")
    codes: defaultdict[bytes, int] = defaultdict(count().__next__)
    ids = np.fromiter(map(codes.__getitem__, chain.from_iterable(texts)), dtype=np.int64)
    n = np.array([len(words) for words in texts], dtype=np.int64)
    doc, first = np.repeat(np.arange(len(texts)), n), np.cumsum(n) - n
    where = stretches(ids, doc, min_length, min_exponent)
    begin, end = np.array(where, dtype=np.int64).reshape(-1, 2).T
    size = end - begin + 1  # with the separator
    row, step = _pairs(size)
    at = begin[row] + step - 1
    s = np.where(step == size[row], len(codes) + row, ids[np.minimum(at, max(len(ids) - 1, 0))]) if len(ids) else at
    found = located(s)
    start, length, period = found.T
    ok = (length >= min_length) & (length >= min_exponent * period)
    found = found[ok]
    found[:, 0] = at[found[:, 0]]
    of = doc[found[:, 0]] if len(found) else np.zeros(0, int)
    found[:, 0] -= first[of]
    cut = np.searchsorted(of, np.arange(len(texts) + 1))
    return [found[i:j] for i, j in zip(cut[:-1], cut[1:])]


def collapsed(words: list[bytes], found: np.ndarray) -> bytes:
    """The words joined by one space, of each run the first period only: a word goes if any run has it behind its first period."""
    if not len(found):
        return b" ".join(words)
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, found[:, 0] + found[:, 2], 1)
    np.add.at(edge, found[:, 0] + found[:, 1], -1)
    return b" ".join([words[i] for i in np.flatnonzero(np.cumsum(edge)[:-1] == 0).tolist()])


def found(docs: DataFrame, text: str = "text", key: str = "doc_id", min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT, edit: Edit | None = None) -> DataFrame:
    """(key, n_words, runs, collapsed): runs as structs start, length, period by start and period, words numbered from 0.

    `edit` may change a text's words, given the key as text, before they are looked at.
    """
    shape = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(1).to_pylist()
            names = b.column(0).cast(pa.string()).to_pylist() if edit else [None] * len(texts)
            for part in chunks(texts):
                words = [(t or "").encode().split() for t in texts[part]]  # bytes: exactly these six spaces
                if edit:
                    words = [edit(name or "", w) for name, w in zip(names[part], words)]
                rows = runs(words, min_length, min_exponent)
                end = np.cumsum([0, *map(len, rows)]).astype(np.int32)
                flat = np.concatenate(rows) if rows else np.zeros((0, 3), np.int64)
                spans = pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(c)) for c in flat.T], fields=list(shape.value_type))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0)[part], pa.array([len(w) for w in words], pa.int64()), pa.ListArray.from_arrays(pa.array(end), spans), pa.array([collapsed(w, r) for w, r in zip(words, rows)], pa.binary()).cast(pa.string())],
                    names=["key", "n_words", "runs", "collapsed"],
                )
        tidy()

    kind = docs.schema[key].dataType.simpleString()
    out = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text")).mapInArrow(run, f"key {kind}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string")
    return out.withColumnRenamed("key", key)


def planted(name: str, words: list[bytes]) -> list[bytes]:
    """The repeats that the query plants in a tenth of the texts, by the crc32 of the id."""
    h, n = zlib.crc32(name.encode()), len(words)
    g = h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a : a + p] * ((n - a) // p + 1))[: n - a]


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = found(table(spark, sf_dir, "documents"), edit=planted)
    more = lambda x, y: x.length * y.period > y.length * x.period  # noqa: E731  runs come by start and period, so ties keep the earlier
    best = F.aggregate("runs", F.get("runs", F.lit(0)), lambda x, y: F.when(more(y, x), y).otherwise(x))
    line = F.transform("runs", lambda r: F.concat(r.start.cast("string"), F.lit(","), r.length.cast("string"), F.lit(","), r.period.cast("string"), F.lit("\n")))
    rows = rows.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"), F.sha2(F.array_join(line, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
    b = F.col("best")
    return rows.select("doc_id", "n_runs", b.start.alias("start"), b.length.alias("length"), b.period.alias("period"), F.expr("1000 * best.length div best.period").alias("exponent_milli"), "runs_sha256", "collapsed_sha256")
