"""Language identification by hyperdimensional profiles.

Each letter has a random bipolar vector drawn from its code point. A trigram's vector binds its three letters'
vectors, each permuted (rolled) by its place; a text's vector bundles (sums) those of its trigrams; a language's
prototype bundles the vectors of its training texts, each weighted by 1 / its trigram count. A text gets the
language whose prototype has the greatest cosine with its vector.

Defined results: null texts and texts without a letter are `und` with score 0. Ties go to the alphabetically first
language. Rows with null language or text aren't learned from; without any training rows all texts are `und`.
Repeated rows count each time. Other columns, whatever their names, pass through untouched.
Texts are lower-cased and NFC-normalised; combining marks (vowel signs, points) belong to the letter before them; every
run of other characters is one blank, and texts get a blank at both ends, so that short words show their edges.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from screenweave.llm.common import bounded, chunks, fold, fresh, table, tidy

UND = "und"
_BLANK = 32
#: Trigram vectors are kept and multiplied in pieces of this many.
_PIECE = 4096


def _mark(c: int) -> bool:
    return unicodedata.category(chr(c)) in ("Mn", "Mc")


def _letters() -> np.ndarray:
    """For every code point of the basic plane, itself if it is a letter or a combining mark, else the blank."""
    return np.fromiter((c if chr(c).isalpha() or _mark(c) else _BLANK for c in range(65536)), dtype=np.uint32, count=65536)


class Encoder:
    """Turns texts into trigram counts and trigrams into vectors. The vectors depend on dim and seed only."""

    def __init__(self, dim: int, seed: int):
        self.dim, self.seed = dim, seed
        self.table = _letters()
        self.marks = np.fromiter((_mark(c) for c in range(65536)), dtype=bool, count=65536)
        self.letter: dict[int, np.ndarray] = {}
        self.known: dict[int, int] = {}
        self.rows = np.zeros((0, dim), dtype=np.int8)

    def _vector(self, c: int) -> np.ndarray:
        v = self.letter.get(c)
        if v is None:
            bits = np.random.Generator(np.random.PCG64([self.seed, c])).integers(0, 2, self.dim)
            v = self.letter[c] = (bits * 2 - 1).astype(np.int8)
        return v

    def vectors(self, codes: np.ndarray) -> np.ndarray:
        """A row for each trigram code (three code points of 21 bits)."""
        new = [int(c) for c in codes if int(c) not in self.known]
        if len(self.known) + len(new) > 4 * _PIECE:
            self.known, self.rows, new = {}, self.rows[:0], [int(c) for c in codes]
        if new:
            mask = (1 << 21) - 1
            made = np.empty((len(new), self.dim), dtype=np.int8)
            for k, c in enumerate(new):
                made[k] = np.roll(self._vector(c >> 42), 2) * np.roll(self._vector(c >> 21 & mask), 1) * self._vector(c & mask)
            base = len(self.known)
            self.known.update((c, base + k) for k, c in enumerate(new))
            self.rows = np.concatenate([self.rows, made])
        return self.rows[[self.known[int(c)] for c in codes]].astype(np.float32)

    def trigrams(self, texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(document, code, count) of the distinct trigrams of each text, sorted by code and document."""
        clean = ["" if t is None else t.lower() for t in texts]
        clean = [t if t.isascii() else unicodedata.normalize("NFC", t) for t in clean]
        size = np.fromiter((len(t) + 2 for t in clean), dtype=np.int64, count=len(clean))
        point = np.frombuffer("".join(f" {t} " for t in clean).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        doc = np.repeat(np.arange(len(clean)), size)
        far = point >= 65536
        letter = self.table[np.where(far, _BLANK, point)]
        if far.any():
            own = np.unique(point[far])
            real = np.array([chr(c).isalpha() or _mark(c) for c in own])
            at = np.searchsorted(own, point[far])
            letter[far] = np.where(real[at], point[far], _BLANK)
        mark = self.marks[np.where(far, _BLANK, point)]
        if far.any():
            mark[far] = np.array([_mark(c) for c in own])[at]
        if mark.any():  # without a letter before them they are no part of a word
            base = np.maximum.accumulate(np.where(mark, 0, np.arange(len(mark))))
            letter[mark & (letter[base] == _BLANK)] = _BLANK
        keep = np.ones(len(letter), dtype=bool)
        keep[1:] = (letter[1:] != _BLANK) | (letter[:-1] != _BLANK) | (doc[1:] != doc[:-1])
        letter, doc = letter[keep].astype(np.int64), doc[keep]
        if len(letter) < 3:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        used = np.unique(letter)
        small = np.searchsorted(used, letter) if used[-1] >= 65536 else self._rank(used)[letter]
        k = len(used)
        same = doc[2:] == doc[:-2]
        gram = ((small[:-2] * k + small[1:-1]) * k + small[2:])[same]
        place = doc[2:][same]
        own, inverse = np.unique(gram, return_inverse=True) if k > 160 else self._dense(gram, k**3)
        key, count = self._counted(inverse * len(clean) + place, len(own) * len(clean))
        code = (used[own // (k * k)] << 42) | (used[own // k % k] << 21) | used[own % k]
        return key % len(clean), code[key // len(clean)], count

    @staticmethod
    def _rank(used: np.ndarray) -> np.ndarray:
        out = np.zeros(65536, dtype=np.int64)
        out[used] = np.arange(len(used))
        return out

    @staticmethod
    def _dense(gram: np.ndarray, top: int) -> tuple[np.ndarray, np.ndarray]:
        there = np.zeros(top, dtype=bool)
        there[gram] = True
        own = np.flatnonzero(there)
        rank = np.zeros(top, dtype=np.int64)
        rank[own] = np.arange(len(own))
        return own, rank[gram]

    @staticmethod
    def _counted(key: np.ndarray, top: int) -> tuple[np.ndarray, np.ndarray]:
        if top <= 8_000_000:
            n = np.bincount(key, minlength=1)
            at = np.flatnonzero(n)
            return at, n[at]
        return np.unique(key, return_counts=True)

    def bundles(self, texts) -> tuple[np.ndarray, np.ndarray]:
        """The vector of each text, and its number of trigrams (0: it has no letter)."""
        out = np.zeros((len(texts), self.dim), dtype=np.float32)
        doc, code, count = self.trigrams(texts)
        if not len(doc):
            return out, np.zeros(len(texts), dtype=np.int64)
        first = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]]))
        own = code[first]
        column = np.cumsum(np.concatenate([[False], code[1:] != code[:-1]]))
        for k in range(0, len(own), _PIECE):
            part = slice(np.searchsorted(column, k), np.searchsorted(column, k + _PIECE))
            matrix = np.zeros((len(texts), len(own[k : k + _PIECE])), dtype=np.float32)
            matrix[doc[part], column[part] - k] = count[part]
            out += matrix @ self.vectors(own[k : k + _PIECE])
        return out, np.bincount(doc, weights=count, minlength=len(texts)).astype(np.int64)


_encoders: dict[tuple[int, int], Encoder] = {}


def _encoder(dim: int, seed: int) -> Encoder:
    if (dim, seed) not in _encoders:
        _encoders[dim, seed] = Encoder(dim, seed)
    return _encoders[dim, seed]


@dataclass
class Profiles:
    """Language prototypes: unit vectors in float32, one row for each language, in alphabetic order."""

    languages: list[str]
    vectors: np.ndarray
    dim: int
    seed: int

    def predict(self, texts) -> pd.DataFrame:
        out = pd.DataFrame({"lang_pred": [UND] * len(texts), "score": 0.0, "n_grams": 0})
        if not self.languages:
            return out
        for part in chunks(texts):
            bundle, grams = _encoder(self.dim, self.seed).bundles(texts[part])
            norm = np.sqrt(np.einsum("ij,ij->i", bundle, bundle, dtype=np.float64))
            cosine = (bundle @ self.vectors.T) / np.maximum(norm, 1e-9)[:, None]
            best = cosine.argmax(axis=1)
            names = np.array(self.languages, dtype=object)[best]
            out.iloc[part, 0] = np.where(grams > 0, names, UND)
            out.iloc[part, 1] = np.where(grams > 0, np.clip(cosine[np.arange(len(best)), best], 0, 1), 0).astype(float)
            out.iloc[part, 2] = grams
        return out

    def predicted(self, text: Column) -> Column:
        """struct(lang_pred, score, n_grams) of a text column."""
        model = self

        @F.pandas_udf("lang_pred string, score double, n_grams long")
        def udf(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
            for s in batches:
                yield model.predict(s.tolist())
                tidy()

        return udf(text)


def fit(docs: DataFrame, text: str = "text", lang: str = "lang", dim: int = 1024, seed: int = 17, max_languages: int = 2000) -> Profiles:
    """Prototypes from all rows of `docs` that have a text and a language.

    Each task bundles what it reads and emits one integer vector for each language (fixed point, so that sums don't
    depend on their order); Spark adds them up. The driver gets languages x dim numbers. The set of label values is
    taken to be small: more than max_languages are an error rather than a driver that runs out of memory.
    """

    def bundle(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder, sums = _encoder(dim, seed), {}
        for b in batches:
            texts, langs = b["text"].tolist(), b["lang"].tolist()
            for part in chunks(texts):
                doc, code, count = encoder.trigrams(texts[part])
                if not len(doc):
                    continue
                names, which = np.unique(np.array(langs[part], dtype=object).astype(str), return_inverse=True)
                total = np.bincount(doc, weights=count, minlength=len(which))
                first = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]]))
                column = np.cumsum(np.concatenate([[False], code[1:] != code[:-1]]))
                weight = np.bincount(which[doc] * len(first) + column, weights=count / total[doc], minlength=len(names) * len(first)).reshape(len(names), -1)
                for k in range(0, len(first), _PIECE):
                    part_sum = weight[:, k : k + _PIECE] @ encoder.vectors(code[first[k : k + _PIECE]]).astype(np.float64)
                    for name, v in zip(names, part_sum):
                        sums[name] = sums.get(name, 0) + v
        tidy()
        for name, v in sums.items():
            yield pd.DataFrame({"lang": name, "k": np.arange(dim, dtype=np.int32), "v": np.round(v * 1e6).astype(np.int64)})

    bounded(docs.sparkSession)
    rows = docs.select(F.col(text).cast("string").alias("text"), F.col(lang).cast("string").alias("lang")).dropna()
    summed = rows.mapInPandas(bundle, "lang string, k int, v long").groupBy("lang", "k").agg(F.sum("v").alias("v"))
    found = summed.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("k", "v"))).alias("kv")).limit(max_languages + 1).collect()
    if len(found) > max_languages:
        raise ValueError(f"more than {max_languages} languages")
    found.sort(key=lambda r: r["lang"])
    vectors = np.array([[x["v"] for x in r["kv"]] for r in found], dtype=np.float64).reshape(len(found), dim)
    norm = np.sqrt((vectors**2).sum(axis=1, keepdims=True))
    return Profiles([r["lang"] for r in found], (vectors / np.maximum(norm, 1e-9)).astype(np.float32), dim, seed)


def trained(docs: DataFrame) -> Profiles:
    """Learned from the rows whose crc32(doc_id) mod 4 is not 2."""
    return fit(docs.where(fold("doc_id", 4) != 2))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    p = trained(docs).predicted(F.col("text"))
    return docs.select("doc_id", (fold("doc_id", 4) == 2).alias("held_out"), p.alias("p")).select("doc_id", "held_out", "p.lang_pred", "p.score", "p.n_grams")


#: A text of at least MIN_GRAMS trigrams with a cosine below MIN_SCORE belongs to no learned language: unrelated
#: vectors of 1024 dimensions have cosines of 0.03 in the mean. Shorter texts give too little evidence to reject them.
MIN_SCORE, MIN_GRAMS = 0.1, 30


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents that are written in a learned language: neither `und`, nor long and unlike all of them."""
    (p,) = fresh(docs, "lang_found")
    found = docs.withColumn(p, trained(docs).predicted(F.col("text")))
    unlike = (F.col(f"{p}.score") < MIN_SCORE) & (F.col(f"{p}.n_grams") >= MIN_GRAMS)
    return found.where((F.col(f"{p}.lang_pred") != UND) & ~unlike).drop(p)
