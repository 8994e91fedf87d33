"""Toxicity scores by a bidirectional gated recurrent network with attention pooling, trained in numpy.

A text is read as words (lower case, ASCII punctuation at their ends removed). A word's input joins a vector of the word
(by hash) and the mean of vectors of its character n-grams, ends marked. Windows of WINDOW words, each half covered by
the next, go through gated recurrent units in both directions; attention weighs the states of a window; a logistic unit
gives its score. A text's score is the largest of its windows'. All windows of all texts are scored.

Training: windows first carry the label of their text; then, as a text is toxic if any part of it is, the text's
highest window alone carries the label (multiple-instance learning). The sample is of different texts (copies with one label count once) and
bounded by MAX_ROWS and MAX_CHARS / 2 for each label; the texts come in the order of a hash. Where those of a label have
more characters together, the longest are learned from in pieces, all cut to the one length with which they fit: none is
left out for its length or another's. Scores always read whole texts. Seeds are fixed.

Defined results: null texts and texts without words get the share of label 1 among the sampled rows' population. Without
labels of both kinds every text gets that share (0 without any). Ties don't matter: equal texts get equal scores.
Rows with null label, or null text, aren't learned from. Other columns pass through untouched.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from screenweave.llm.common import bounded, chunks, fold, fresh, table, tidy
from screenweave.llm.textarrays import Words, mix64, words

WINDOW, STEP, HIDDEN, WIDTH = 32, 16, 8, 8
WORD_BITS, GRAM_BITS, GRAM_SIZES = 15, 16, (3, 4, 5)
#: Bounds of the training sample: different texts of each label, and characters in total, half of them for each label.
MAX_ROWS, MAX_CHARS = 2500, 20_000_000
#: Pieces of a text that is too long to be learned from whole.
PIECES = 16
THRESHOLD = 0.5

_PUNCTUATION = np.zeros(256, dtype=bool)
_PUNCTUATION[[c for c in range(33, 127) if not chr(c).isalnum()]] = True
_U = np.uint64


def split(texts) -> Words:
    """Words of a batch with ASCII punctuation at their ends removed; words of nothing else are left out."""
    w = words([None if t is None else t.lower() for t in texts])
    start, end = w.start.copy(), w.end.copy()
    for ends, step, at in ((start, 1, 0), (end, -1, -1)):
        on = np.arange(len(start))
        while len(on):
            on = on[(start[on] < end[on])]
            on = on[_PUNCTUATION[w.data[ends[on] + at]]]
            ends[on] += step
    keep = start < end
    return Words(w.data, start[keep], end[keep], w.doc[keep], w.n_docs)


@dataclass
class Vocabulary:
    """Distinct words of a batch: word hash slots, and slots of their character n-grams in word order for each size."""

    slots: np.ndarray
    grams: list[tuple[np.ndarray, np.ndarray, np.ndarray]]  # slots, first place of each word that has any, those words
    n_grams: np.ndarray


def vocabulary(w: Words) -> tuple[Vocabulary, np.ndarray]:
    """The distinct words of a batch, and each token's index among them."""
    h = w.hashes()
    own, first, index = np.unique(h, return_index=True, return_inverse=True)
    size = w.end[first] - w.start[first]
    framed = size + 2
    begin = np.concatenate([[0], np.cumsum(framed)[:-1]]).astype(np.int64)
    total = int(framed.sum())
    place = np.arange(total) - np.repeat(begin, framed)
    byte = np.empty(total, dtype=np.uint64)
    inner = (place > 0) & (place < np.repeat(framed, framed) - 1)
    byte[inner] = w.data[(np.repeat(w.start[first] - begin - 1, framed) + np.arange(total))[inner]]
    byte[~inner] = np.where(place[~inner] == 0, 1, 2)
    grams, count = [], np.zeros(len(own), dtype=np.int64)
    for k in GRAM_SIZES:
        code = np.zeros(max(total - k + 1, 0), dtype=np.uint64)
        for j in range(k):
            code = (code << _U(8)) | byte[j : j + len(code)]
        good = place[: len(code)] + k <= np.repeat(framed, framed)[: len(code)]
        n = np.maximum(framed - k + 1, 0)
        some = np.flatnonzero(n)
        grams.append(((mix64(code[good] + _U(k)) >> _U(64 - GRAM_BITS)).astype(np.int64), np.concatenate([[0], np.cumsum(n[some])[:-1]]).astype(np.int64), some))
        count += n
    return Vocabulary((mix64(own) >> _U(64 - WORD_BITS)).astype(np.int64), grams, np.maximum(count, 1)), index


def lexicon(texts) -> tuple[Words, np.ndarray, np.ndarray]:
    """The distinct words of the texts, each token's index among them, and the texts' numbers of words. Works by chunks: the tokens' bytes and places are never held for all texts at once."""
    data, sizes, hashes, tokens, counts, base = [np.zeros(0, np.uint8)], [np.zeros(0, np.int64)], [np.zeros(0, _U)], [np.zeros(0, np.int32)], [np.zeros(0, np.int64)], 0
    for part in chunks(texts):
        w = split(texts[part])
        own, first, index = np.unique(w.hashes(), return_index=True, return_inverse=True)
        size = w.end[first] - w.start[first]
        data.append(w.data[np.repeat(w.start[first] - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))])
        sizes.append(size)
        hashes.append(own)
        tokens.append((index + base).astype(np.int32))
        counts.append(w.counts())
        base += len(own)
    _, first, to = np.unique(np.concatenate(hashes), return_index=True, return_inverse=True)
    end = np.cumsum(np.concatenate(sizes))
    start = end - np.concatenate(sizes)
    return Words(np.concatenate(data), start[first], end[first], np.zeros(len(first), np.int64), 1), to.astype(np.int32)[np.concatenate(tokens)], np.concatenate(counts)


def cut(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, first token in the batch, length) of all windows of documents with these word counts."""
    n = np.where(counts > 0, 1 + np.maximum(0, -(-(counts - WINDOW) // STEP)), 0)
    doc = np.repeat(np.arange(len(counts)), n)
    k = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)
    base = np.concatenate([[0], np.cumsum(counts)[:-1]])[doc] if len(counts) else k
    return doc, base + k * STEP, np.minimum(WINDOW, counts[doc] - k * STEP)


def placed(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, tokens, which of them are words) of all windows of documents with these word counts."""
    doc, first, size = cut(counts)
    at = np.arange(WINDOW)
    mask = at[None, :] < size[:, None]
    return doc, np.where(mask, first[:, None].astype(np.int32) + at[None, :].astype(np.int32), 0), mask


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (np.tanh(0.5 * x) + 1)


class Network:
    """Parameters by name; one set of gate weights for each direction."""

    def __init__(self, seed: int = 5):
        r = np.random.Generator(np.random.PCG64(seed))
        normal = lambda *s, scale: (r.standard_normal(s) * scale).astype(np.float32)
        h = HIDDEN
        self.p = {"word": normal(1 << WORD_BITS, WIDTH, scale=0.1), "gram": normal(1 << GRAM_BITS, WIDTH, scale=0.1), "att": normal(2 * h, h, scale=0.3), "att_b": np.zeros(h, np.float32), "pick": normal(h, scale=0.3), "out": normal(2 * h, scale=0.3), "out_b": np.full(1, -1, np.float32)}
        for d in "fb":
            self.p |= {f"in_{d}": normal(2 * WIDTH, 3 * h, scale=0.3), f"in_b{d}": np.zeros(3 * h, np.float32), f"rec_{d}": normal(h, 3 * h, scale=0.3)}

    def inputs(self, v: Vocabulary) -> np.ndarray:
        return np.concatenate([self.p["word"][v.slots], self._grams(v)], axis=1)

    def _grams(self, v: Vocabulary, kept: list[np.ndarray] | None = None) -> np.ndarray:
        out = np.zeros((len(v.slots), WIDTH), dtype=np.float32)
        for k, (slots, first, some) in enumerate(v.grams):
            if len(some):
                rows = self.p["gram"][slots] if kept is None else self.p["gram"][slots] * kept[k][:, None]
                out[some] += np.add.reduceat(rows, first, axis=0)
        return out / v.n_grams[:, None].astype(np.float32)

    def forward(self, x: np.ndarray, token: np.ndarray, mask: np.ndarray, keep: bool = False):
        """Logits of windows; token: (windows, WINDOW) indices of the rows of x, mask: which of them are words."""
        n, h = len(token), HIDDEN
        states = np.zeros((2, WINDOW, n, h), dtype=np.float32)
        kept = {"f": [], "b": []}
        for k, d in enumerate("fb"):
            gates = x @ self.p[f"in_{d}"] + self.p[f"in_b{d}"]
            rec, s = self.p[f"rec_{d}"], np.zeros((n, h), dtype=np.float32)
            for t in range(WINDOW) if d == "f" else range(WINDOW - 1, -1, -1):
                g, u = gates[token[:, t]], s @ rec
                zr = sigmoid(g[:, : 2 * h] + u[:, : 2 * h])
                z, r = zr[:, :h], zr[:, h:]
                c = np.tanh(g[:, 2 * h :] + r * u[:, 2 * h :])
                new = np.where(mask[:, t, None], c + z * (s - c), s)
                if keep:
                    kept[d].append((t, s, z, r, c, u[:, 2 * h :]))
                states[k, t] = s = new
        both = np.concatenate([states[0], states[1]], axis=2)
        a = np.tanh(both @ self.p["att"] + self.p["att_b"])
        e = np.where(mask.T, a @ self.p["pick"], -1e9)
        e = np.exp(e - e.max(axis=0))
        e /= e.sum(axis=0)
        c = np.einsum("tn,tnh->nh", e, both)
        logit = c @ self.p["out"] + self.p["out_b"]
        return (logit, (kept, both, a, e, c)) if keep else logit

    def gradient(self, v: Vocabulary, token: np.ndarray, mask: np.ndarray, label: np.ndarray, weight: np.ndarray, kept_words: np.ndarray, kept_grams: list[np.ndarray]) -> tuple[float, dict]:
        """Loss and gradients. kept_words, kept_grams: 0, or 1 / the share kept, for each word and n-gram (dropout)."""
        p, h, x = self.p, HIDDEN, self.inputs(v)
        x[:, :WIDTH] *= kept_words[:, None]
        x[:, WIDTH:] = self._grams(v, kept_grams)
        logit, (kept, both, a, e, c) = self.forward(x, token, mask, keep=True)
        q = sigmoid(logit)
        loss = float(-(weight * (label * np.log(q + 1e-7) + (1 - label) * np.log(1 - q + 1e-7))).sum())
        g: dict[str, np.ndarray] = {}
        dl = ((q - label) * weight).astype(np.float32)
        g["out"], g["out_b"] = dl @ c, dl.sum(keepdims=True)
        dc = dl[:, None] * p["out"]
        dboth = e[:, :, None] * dc
        de = np.einsum("nh,tnh->tn", dc, both)
        de = e * (de - (e * de).sum(axis=0))
        da = de[:, :, None] * p["pick"] * (1 - a * a)
        g["pick"] = np.einsum("tn,tnh->h", de, a)
        g["att"] = np.einsum("tni,tnj->ij", both, da)
        g["att_b"] = da.sum(axis=(0, 1))
        dboth += da @ p["att"].T
        dx = np.zeros_like(x)
        for k, d in enumerate("fb"):
            rec, ds = p[f"rec_{d}"], np.zeros((len(token), h), dtype=np.float32)
            dgates = np.zeros((len(x), 3 * h), dtype=np.float32)
            drec = np.zeros_like(rec)
            for t, s, z, r, cand, un in reversed(kept[d]):
                ds = ds + dboth[t, :, k * h : (k + 1) * h]
                on = mask[:, t, None]
                dn = np.where(on, ds, 0)
                dz = dn * (s - cand) * z * (1 - z)
                dcand = dn * (1 - z) * (1 - cand * cand)
                dr = dcand * un * r * (1 - r)
                du = np.concatenate([dz, dr, dcand * r], axis=1)
                np.add.at(dgates, token[:, t], np.concatenate([dz, dr, dcand], axis=1))
                drec += s.T @ du
                ds = np.where(on, dn * z, ds) + du @ rec.T
            g[f"rec_{d}"], g[f"in_{d}"], g[f"in_b{d}"] = drec, x.T @ dgates, dgates.sum(axis=0)
            dx += dgates @ p[f"in_{d}"].T
        g["word"] = np.zeros_like(p["word"])
        np.add.at(g["word"], v.slots, dx[:, :WIDTH] * kept_words[:, None])
        g["gram"] = np.zeros_like(p["gram"])
        share = dx[:, WIDTH:] / v.n_grams[:, None]
        for k, (slots, first, some) in enumerate(v.grams):
            if len(some):
                np.add.at(g["gram"], slots, np.repeat(share[some], np.diff(np.append(first, len(slots))), axis=0) * kept_grams[k][:, None])
        return loss, g


class Adam:
    def __init__(self, p: dict, rate: float = 0.01):
        self.p, self.rate, self.t = p, rate, 0
        self.m, self.v = ({k: np.zeros_like(x) for k, x in p.items()} for _ in range(2))

    def step(self, g: dict) -> None:
        self.t += 1
        scale = self.rate * np.sqrt(1 - 0.999**self.t) / (1 - 0.9**self.t)
        for k, d in g.items():
            self.m[k] += 0.1 * (d - self.m[k])
            self.v[k] += 0.001 * (d * d - self.v[k])
            self.p[k] -= scale * self.m[k] / (np.sqrt(self.v[k]) + 1e-8)


@dataclass
class Model:
    net: Network | None
    share: float

    def _windows(self, texts):
        w = split(texts)
        return w, *placed(w.counts())

    def logits(self, texts) -> tuple[np.ndarray, np.ndarray]:
        """(document, logit) of all windows of a batch."""
        w, doc, token, mask = self._windows(texts)
        if not len(doc):
            return doc, np.zeros(0)
        v, index = vocabulary(w)
        x, out = self.net.inputs(v), np.empty(len(doc), dtype=np.float32)
        for k in range(0, len(doc), 4096):
            out[k : k + 4096] = self.net.forward(x, index[token[k : k + 4096]], mask[k : k + 4096])
        return doc, out

    def scores(self, texts) -> np.ndarray:
        out = np.full(len(texts), self.share)
        if self.net is None:
            return out
        for part in chunks(texts):
            doc, logit = self.logits(texts[part])
            top = np.full(len(texts[part]), -np.inf)
            np.maximum.at(top, doc, logit)
            out[part] = np.where(np.isfinite(top), sigmoid(top), out[part])
        return out

    def scored(self, text: Column) -> Column:
        model = self

        @F.pandas_udf("double")
        def udf(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for s in batches:
                yield pd.Series(model.scores(s.tolist()))
                tidy()

        return udf(text)


def train(texts: list[str], labels: np.ndarray, share: float, per_text: int = 10, warm: int = 5, rounds: int = 4, steps: int = 60, drop: float = 0.5, decay: float = 1e-3, seed: int = 11) -> Model:
    """A network from labelled texts. `warm` epochs over up to per_text random windows of each, then `rounds` over each text's highest windows. An epoch has about `steps` steps of 32 to 512 windows."""
    if len(set(labels.tolist())) < 2:
        return Model(None, share)
    r, model = np.random.Generator(np.random.PCG64(seed)), Model(Network(), share)
    adam = Adam(model.net.p)
    w, word, counts = lexicon(texts)
    doc, token, mask = placed(counts)
    keep = np.bincount(doc, minlength=len(texts)) > 0
    positive = (labels == 1) & keep
    weight = np.where(positive, 0.5 / max(positive.sum(), 1), 0.5 / max((keep & ~positive).sum(), 1)) * keep.sum()

    def learn(chosen: np.ndarray, each: np.ndarray) -> float:
        total, batch = 0.0, min(512, max(32, len(chosen) // steps))
        for k in range(0, len(chosen), batch):
            at = chosen[k : k + batch]
            used, where = np.unique(word[token[at]], return_inverse=True)
            part = Words(w.data, w.start[used], w.end[used], w.doc[used], w.n_docs)
            v, index = vocabulary(part)
            kept = [(r.random(n) >= drop).astype(np.float32) / np.float32(1 - drop) for n in (len(v.slots), *(len(x[0]) for x in v.grams))]
            loss, g = model.net.gradient(v, index[where].reshape(len(at), WINDOW), mask[at], labels[doc[at]].astype(np.float32), (each[k : k + batch] / len(at)).astype(np.float32), kept[0], kept[1:])
            for name in ("word", "gram"):
                g[name] += np.float32(decay) * model.net.p[name] * (g[name] != 0)
            adam.step(g)
            total += loss
        return total

    first = np.searchsorted(doc, np.arange(len(texts) + 1))
    for _ in range(warm):
        order = np.lexsort((r.random(len(doc)), doc))
        place = np.arange(len(doc)) - first[doc]
        chosen = r.permutation(order[place < per_text])
        n = np.minimum(first[1:] - first[:-1], per_text)
        learn(chosen, weight[doc[chosen]] / n[doc[chosen]] * n[keep].mean())
    for k in range(rounds):
        adam.rate = 0.01 * (1 - k / (rounds + 1))
        logit = np.concatenate([model.logits(texts[part])[1] for part in chunks(texts)])
        order = np.lexsort((-logit, doc))
        place = np.arange(len(doc)) - first[doc]
        # of a clean text all high windows are wrong; of a toxic one, the highest is right
        chosen = order[(place < 1) | ((place < 3) & ~positive[doc[order]])]
        chosen = r.permutation(chosen)
        learn(chosen, weight[doc[chosen]])
    return model


def level(sizes: list[int], room: int) -> int | None:
    """The one length to which longer texts are cut so that all fit in `room` characters; None if they fit whole."""
    n = np.sort(np.asarray(sizes, dtype=np.int64))
    if n.sum() <= room:
        return None
    share = (room - (np.cumsum(n) - n)) // np.arange(len(n), 0, -1)
    return max(1, int(share[np.argmax(n > share)]))


def excerpt(text: Column, limit: Column) -> Column:
    """The text, or if it is longer than a limit that isn't null, PIECES pieces of it from its start to its end, evenly spread."""
    n, size = F.length(text), F.greatest(F.floor(limit / PIECES), F.lit(1)).cast("int")
    pieces = F.transform(F.sequence(F.lit(0), F.lit(PIECES - 1)), lambda k: F.substring(text, (1 + F.floor(k * (n - size) / (PIECES - 1))).cast("int"), size))
    return F.when(n > limit, F.array_join(pieces, "\n")).otherwise(text)


def sampled(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", label: str = "toxic", max_rows: int = MAX_ROWS, max_chars: int = MAX_CHARS) -> tuple[DataFrame, float]:
    """(t, y) of the different labelled texts to learn from, and the share of label 1 among all labelled rows."""
    spark = docs.sparkSession
    known = labels.select(F.col(key).alias("k"), F.col(label).cast("int").alias("y")).dropna().where("y in (0, 1)")
    given = docs.select(F.col(key).alias("k"), F.col(text).cast("string").alias("t")).dropna()
    # hashes and lengths are worked out before the join, so that no text is shuffled
    rows = given.select("k", F.length("t").alias("n"), F.xxhash64("t").alias("g"), F.xxhash64("t", F.lit(1)).alias("h")).join(known, "k")
    own = rows.groupBy("y", "g", "h").agg(F.min("k").alias("k"), F.first("n").alias("n"), F.count("*").alias("of"))
    counts = {r["y"]: r for r in own.groupBy("y").agg(F.sum("of").alias("rows"), F.count("*").alias("texts")).collect()}
    total = sum(r["rows"] for r in counts.values())
    share = counts[1]["rows"] / total if 1 in counts else 0.0
    # a share of the texts by hash, somewhat larger than the bound, and then the bound
    picked, limit = [], F.lit(None).cast("int")
    for y in (0, 1):
        part = max(1, -(-counts[y]["texts"] // (2 * max_rows))) if y in counts else 1
        some = own.where((F.col("y") == y) & (F.pmod(F.col("g"), F.lit(part)) == 0)).select("k", "y", "n", "g", "h").orderBy("h", "g").limit(max_rows)
        found = some.collect()
        picked += found
        limit = F.when(F.col("y") == y, F.lit(level([r["n"] for r in found], max_chars // 2)).cast("int")).otherwise(limit)
    chosen = spark.createDataFrame(picked, some.schema).drop("n")
    # by hash as well: a repeated id may have other texts; of equal rows, one
    hashed = given.withColumns({"g": F.xxhash64("t"), "h": F.xxhash64("t", F.lit(1))}).join(F.broadcast(chosen), ["k", "g", "h"])
    return hashed.select("g", "h", "y", excerpt(F.col("t"), limit).alias("t")).dropDuplicates(["g", "h", "y"]).select("t", "y"), share


def fit(docs: DataFrame, labels: DataFrame, **how) -> Model:
    """Trains on a bounded sample of the documents that have a label."""
    bounded(docs.sparkSession)
    rows, share = sampled(docs, labels, **how)
    sample = rows.toPandas().sort_values(["t", "y"])
    model = train(sample["t"].tolist(), sample["y"].to_numpy(), share)
    tidy()
    return model


def trained(spark: SparkSession, docs: DataFrame, sf_dir: str) -> Model:
    return fit(docs.where(fold("doc_id", 5) != 0), table(spark, sf_dir, "labels"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = trained(spark, docs, sf_dir)
    scored = docs.select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), model.scored(F.col("text").cast("string")).alias("score"))
    return scored.withColumn("predicted", F.when(F.col("score") >= THRESHOLD, 1).otherwise(0))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents with a score of THRESHOLD or more."""
    model = trained(spark, docs, sf_dir)
    (s,) = fresh(docs, "toxicity")
    return docs.withColumn(s, model.scored(F.col("text").cast("string"))).where(F.col(s) < THRESHOLD).drop(s)
