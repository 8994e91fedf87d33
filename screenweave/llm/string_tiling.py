"""Benchmark decontamination by greedy string tiling.

Benchmark items and documents are sequences of lower-cased words. All runs of `seed` words get Karp-Rabin hashes; a
document's runs are looked up among those of the items. For each item that shares a seed with the document, the longest
common run is marked as a tile, again and again, where no word of either side may be in two tiles and tiles have at
least `seed` words (ties: earliest in the document, then in the item). An item's coverage is the share of its words that
are in tiles. As tiles may lie in any order, passages whose parts were moved are found too. Pairs with a coverage of
`threshold` or more are matches.

A benchmark of up to `block_words` words goes to all tasks as one index, and no document is moved. A larger one is joined
by its seeds, in one scan of the documents more: a bit table of bounded size (BITS) tells which of a document's seeds may
be in the benchmark; those join the items' seeds by hash. A match needs a certain number of an item's seed places, so
each item leaves out its most frequent seeds, one place fewer than it needs; pairs that share none of the others can't
match. Only the texts of the pairs that are left meet, to be tiled. Both ways give the same rows.

Defined results: null texts and texts without words, on either side, match nothing. Items of fewer than `seed` words
have one seed, their whole sequence. Repeated item rows (same id and text) count once; equal texts under several ids
match under each, a null id included. Ids of any type are kept as they are. Repeated documents each give their rows.
Other columns are not looked at.
"""

from __future__ import annotations

import heapq
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from screenweave.llm.common import bounded, chunks, fresh, table, tidy, written
from screenweave.llm.textarrays import windows, words

SEED, THRESHOLD, BLOCK_WORDS = 4, 0.5, 2_000_000
#: Longs of the bit table: 64 bits each.
BITS = 1 << 20
#: Rows of (document, item) keys up to this number are sent to all tasks; more are joined by a shuffle.
SENT = 500_000
FOUND = ("item_id", "matched_words", "item_words", "n_tiles", "longest_tile")


def runs(at: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document place, item place, seeds) of all longest runs on diagonals; at[i]: the document places with the seed of item place i, sorted.

    Takes one item place after the other, so that the pairs of places are never held together.
    """
    out: list[np.ndarray] = []
    live, begin = np.zeros(0, np.int64), np.zeros(0, np.int64)  # places that matched just before, and where their runs began
    for i in range(len(at) + 1):
        here = at[i] if i < len(at) else np.zeros(0, np.int64)
        goes_on = np.isin(live + 1, here, assume_unique=True)
        done = ~goes_on
        n = live[done] - begin[done] + 1
        out.append(np.stack([begin[done], i - n, n]))
        start = here.copy()
        start[np.searchsorted(here, live[goes_on] + 1)] = begin[goes_on]
        live, begin = here, start
    return tuple(np.concatenate(out, axis=1))


def tiles(found: tuple[np.ndarray, np.ndarray, np.ndarray], least: int, doc_words: int, item_words: int) -> list[tuple[int, int, int]]:
    """Greedy tiles (document place, item place, length) from the runs of `least`-word seeds.

    Runs wait in a heap by length; one that has lost words to a tile since is cut into what is left of it and put back.
    """
    heap = [(-(n + least - 1), d, i) for d, i, n in zip(*(x.tolist() for x in found))]
    heapq.heapify(heap)
    doc, item, out, free = np.zeros(doc_words, bool), np.zeros(item_words, bool), [], item_words
    while heap and free >= least:
        n, d, i = heapq.heappop(heap)
        taken = doc[d : d - n] | item[i : i - n]
        if not taken.any():
            out.append((d, i, -n))
            doc[d : d - n] = item[i : i - n] = True
            free += n
            continue
        edge = np.flatnonzero(np.diff(np.concatenate([[True], taken, [True]]).astype(np.int8)))
        for lo, hi in zip(edge[::2].tolist(), edge[1::2].tolist()):
            if hi - lo >= least:
                heapq.heappush(heap, (lo - hi, d + lo, i + lo))
    return out


class Index:
    """Seeds of a block of items: sorted hashes with item and place, for each seed length that occurs."""

    def __init__(self, ids: list, texts: list[str], seed: int):
        w = words(texts)
        h, count, first = w.hashes(), w.counts(), w.first()
        self.ids, self.count, self.seed = ids, count, seed
        self.seeds: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        for n in sorted({min(seed, int(c)) for c in count if c}):
            of = [k for k, c in enumerate(count) if min(seed, c) == n]
            item = np.concatenate([np.full(count[k] - n + 1, k) for k in of])
            place = np.concatenate([np.arange(count[k] - n + 1) for k in of])
            value = windows(h, n)[np.concatenate([first[k] + np.arange(count[k] - n + 1) for k in of])]
            order = np.argsort(value, kind="stable")
            self.seeds[n] = value[order], item[order], place[order]

    def matches(self, texts, threshold: float) -> list[list[tuple]]:
        out: list[list[tuple]] = [[] for _ in texts]
        w = words(texts)
        if not len(w.start):
            return out
        h, first, size = w.hashes(), w.first(), w.counts()
        for n, (value, item, place) in self.seeds.items():
            run = windows(h, n)
            if not len(run):
                continue
            there = np.zeros(1 << 20, dtype=bool)
            there[value & np.uint64((1 << 20) - 1)] = True
            at = np.flatnonzero(there[run & np.uint64((1 << 20) - 1)])
            lo, hi = np.searchsorted(value, run[at], side="left"), np.searchsorted(value, run[at], side="right")
            some = (hi > lo) & (w.doc[at] == w.doc[at + n - 1])
            at, lo, hi = at[some], lo[some], hi[some]
            # by document and seed: where it is in the document
            order = np.lexsort((at, lo, w.doc[at]))
            at, lo, hi = at[order], lo[order], hi[order]
            cut = np.flatnonzero(np.concatenate([[True], (lo[1:] != lo[:-1]) | (w.doc[at[1:]] != w.doc[at[:-1]]), [True]])) if len(at) else np.zeros(1, np.int64)
            places: dict[tuple[int, int], dict[int, np.ndarray]] = defaultdict(dict)
            for a, b in zip(cut[:-1], cut[1:]):
                d = int(w.doc[at[a]])
                own = at[a:b] - first[d]
                for k in range(lo[a], hi[a]):
                    places[d, int(item[k])][int(place[k])] = own
            for (d, k), hits in places.items():
                total = int(self.count[k])
                most = np.zeros(total, dtype=bool)
                for p in hits:
                    most[p : p + n] = True
                if most.sum() < threshold * total:
                    continue  # tiles can't cover more than all seeds do
                none = np.zeros(0, np.int64)
                made = tiles(runs([hits.get(p, none) for p in range(total - n + 1)]), n, int(size[d]), total)
                covered = sum(t[2] for t in made)
                if covered >= threshold * total:
                    out[d].append((self.ids[k], covered, total, len(made), max(t[2] for t in made)))
        return [sorted(x, key=lambda m: (m[0] is not None, 0 if m[0] is None else m[0], m[1:])) for x in out]


def _items(items: DataFrame, text: str, key: str) -> DataFrame:
    return items.select(F.col(key).alias("id"), F.col(text).cast("string").alias("text")).dropna(subset=["text"]).distinct()


def _size(rows: DataFrame) -> int:
    """Words of the items, about (an upper bound)."""
    return rows.agg(F.sum(F.greatest(F.size(F.split(F.trim("text"), r"[ \t-\r]+")), F.lit(1))).alias("n")).first()["n"] or 0


def matched(index: Index, text: Column, kind: str, threshold: float = THRESHOLD) -> Column:
    """Matches of a text column with the items of an index; kind: the type of their ids."""

    @F.pandas_udf(f"array<struct<item_id:{kind},matched_words:int,item_words:int,n_tiles:int,longest_tile:int>>")
    def udf(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            texts, out = s.tolist(), []
            for part in chunks(texts):
                out += [[dict(zip(FOUND, m)) for m in ms] for ms in index.matches(texts[part], threshold)]
            yield pd.Series(out, dtype=object)
            tidy()

    return udf(text)


def _seeds(batches: Iterator[pd.DataFrame], seed: int, lengths: list[int] | None = None, bits: np.ndarray | None = None) -> Iterator[pd.DataFrame]:
    """(row columns but text, words, n, value, places) of the distinct seeds of each text: of its own length, or of all `lengths` if they may be in the bit table."""
    for b in batches:
        texts = b["text"].tolist()
        for part in chunks(texts):
            own = b.iloc[part].drop(columns="text").reset_index(drop=True)
            w = words(texts[part])
            h, count = w.hashes(), w.counts()
            for n in lengths or range(1, seed + 1):
                value = windows(h, n)
                at = np.flatnonzero(w.doc[: len(value)] == w.doc[n - 1 :]) if len(value) else np.zeros(0, np.int64)
                if lengths is None:
                    at = at[np.minimum(count[w.doc[at]], seed) == n]
                if bits is not None:
                    v = value[at] ^ np.uint64(n)
                    at = at[(bits[(v % np.uint64(BITS)).astype(np.int64)] >> ((v >> np.uint64(58)))) & np.uint64(1) == 1]
                if not len(at):
                    continue
                pair, n_places = np.unique(np.rec.fromarrays([w.doc[at], value[at]], names="d,v"), return_counts=True)
                rows = own.iloc[pair["d"]].reset_index(drop=True)
                yield rows.assign(words=count[pair["d"]], n=n, value=pair["v"].view(np.int64), places=n_places)
        tidy()


def _joined(docs: DataFrame, rows: DataFrame, text: str, key: str, seed: int, threshold: float) -> DataFrame:
    """(doc_id, hash, m): the matches of each different document with a benchmark of any size."""
    known = written(rows.withColumn("item", F.monotonically_increasing_id()), "items")
    given = docs.select(F.col(key).alias("doc_id"), F.col(text).cast("string").alias("text")).dropna(subset=["text"]).withColumn("hash", F.xxhash64("text"))
    kind = given.schema["doc_id"].dataType.simpleString()
    own = written(known.select("item", "text").mapInPandas(lambda b: _seeds(b, seed), "item long, words int, n int, value long, places int"), "item-seeds")
    lengths = sorted(r["n"] for r in own.select("n").distinct().collect())
    v = F.col("value").bitwiseXOR(F.col("n").cast("long"))
    low = v.bitwiseAND(F.lit(BITS - 1))
    table_ = own.groupBy(low.alias("word")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(v, 58).cast("int"))).alias("bits")).toPandas()
    bits = np.zeros(BITS, dtype=np.uint64)
    bits[table_["word"].to_numpy(np.int64)] = table_["bits"].to_numpy(np.int64).view(np.uint64)
    theirs = written(given.mapInPandas(lambda b: _seeds(b, seed, lengths, bits), f"doc_id {kind}, hash long, words int, n int, value long, places int").select("doc_id", "hash", "n", "value").distinct(), "seeds")
    often = theirs.groupBy("n", "value").agg(F.count("*").alias("docs"))
    # an item leaves out its most frequent seeds while it has places to spare
    need = F.greatest(F.ceil(F.col("words") * threshold / F.col("n")), F.lit(1))
    by = W.partitionBy("item").orderBy(F.desc("docs"), "value").rowsBetween(W.unboundedPreceding, 0)
    rare = own.join(often, ["n", "value"]).withColumn("spared", F.sum("places").over(by)).withColumn("need", need).where("spared >= need")
    pairs_ = theirs.join(rare.select("n", "value", "item"), ["n", "value"]).select("doc_id", "hash", "item").distinct()
    pairs_ = written(pairs_, "pairs")
    few = pairs_.count() <= SENT
    small = lambda d: F.broadcast(d) if few else d
    same = given["doc_id"].eqNullSafe(pairs_["doc_id"]) & (given["hash"] == pairs_["hash"])
    both = given.join(small(pairs_), same).select(given["doc_id"], given["hash"], given["text"], "item")
    both = both.join(known.select("item", "id", F.col("text").alias("item_text")), "item")

    def tiled(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            found = []
            for k, (t, i, u) in enumerate(zip(b["text"], b["id"], b["item_text"])):
                found += [(k, *m) for m in Index([i], [u], seed).matches([t], threshold)[0]]
            out = pd.DataFrame(found, columns=["k", *FOUND])
            at = out["k"].to_numpy(np.int64)
            yield pd.DataFrame({"doc_id": b["doc_id"].to_numpy()[at], "hash": b["hash"].to_numpy()[at], **{c: out[c] for c in FOUND}})
            tidy()

    item = known.schema["id"].dataType.simpleString()
    return both.mapInPandas(tiled, f"doc_id {kind}, hash long, item_id {item}, matched_words int, item_words int, n_tiles int, longest_tile int").distinct()


def pairs(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, text: str = "text", key: str = "doc_id", item_text: str = "text", item_key: str = "item_id", seed: int = SEED, block_words: int = BLOCK_WORDS) -> DataFrame:
    """(doc_id, item_id, coverage, ...) of all matches."""
    bounded(docs.sparkSession)
    rows = _items(items, item_text, item_key)
    if _size(rows) <= block_words:
        known = rows.orderBy("id", "text").collect()
        index = Index([r["id"] for r in known], [r["text"] for r in known], seed)
        m = docs.select(F.col(key).alias("doc_id"), F.explode(matched(index, F.col(text).cast("string"), rows.schema["id"].dataType.simpleString(), threshold)).alias("m")).select("doc_id", "m.*")
    else:
        found = written(_joined(docs, rows, text, key, seed, threshold), "matches")
        slim = docs.select(F.col(key).alias("_id"), F.xxhash64(F.col(text).cast("string")).alias("_hash"))
        m = slim.join(found, slim["_id"].eqNullSafe(found["doc_id"]) & (slim["_hash"] == found["hash"])).select("doc_id", *FOUND)
    return m.select("doc_id", "item_id", (F.col("matched_words") / F.col("item_words")).alias("coverage"), *FOUND[1:])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pairs(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def clean(docs: DataFrame, items: DataFrame, seed: int = SEED, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The documents that match no item."""
    bounded(docs.sparkSession)
    rows = _items(items, "text", "item_id")
    if _size(rows) <= block_words:
        known = rows.orderBy("id", "text").collect()
        index = Index([r["id"] for r in known], [r["text"] for r in known], seed)
        (m,) = fresh(docs, "matches")
        return docs.withColumn(m, matched(index, F.col("text").cast("string"), rows.schema["id"].dataType.simpleString())).where(F.size(m) == 0).drop(m)
    gone = _joined(docs, rows, "text", "doc_id", seed, THRESHOLD).select(F.col("doc_id").alias("gone_id"), F.col("hash").alias("gone_hash")).distinct()
    h, i, j = fresh(docs, "text_hash", "gone_id", "gone_hash")
    gone, kept = gone.toDF(i, j), docs.withColumn(h, F.xxhash64(F.col("text").cast("string")))
    return kept.join(gone, kept["doc_id"].eqNullSafe(gone[i]) & (kept[h] == gone[j]), "left_anti").drop(h)


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that match an item of the benchmark."""
    return clean(docs, table(spark, sf_dir, "benchmark"))
