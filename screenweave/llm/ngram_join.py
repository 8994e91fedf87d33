"""N-gram Jaccard self-join: a blocked sparse product of the document by n-gram incidence.

Rows of the incidence are classes: documents with the same set of shingles are one class, named by the set's 128-bit
fingerprint and numbered once, when the table of classes is written. Two classes link when 100 * intersection >=
PERCENT * union.

1. A first pass over the texts gives each document's set size and fingerprint, and the shingles that are frequent
   (counted in full, the most frequent ORDERED of them kept). Frequency only orders shingles - rare ones first, any
   order gives the same links - so leaving out some affects speed alone.
2. Size-derived bounds: linked sets share a shingle within the first (100 - PERCENT) % of each, in that order. A second
   pass emits these prefixes as (shingle, class, size, place), a class once for each task. Shingles without two classes
   of near sizes drop out in a window over the shingle's few classes, GROUP rows at most: prefixes are counted by shingle, all
   of them, whatever the table's layout. The more frequent shingles go another way: linked sizes are in the same or in neighbouring bands, aggregation by (shingle, band) tells which of these
   cells have a candidate, and a cell's rows are dealt over tasks by a salt.
3. In a shingle or cell, a pair is a candidate if sizes, places and a histogram of the shingle hashes all allow a sufficient overlap
   (each is an upper bound, so no link is lost). Of the candidates only a spanning forest is emitted, never all pairs. A
   cell of more than GROUP rows is dealt over several tasks as pairs of parts.
4. Components of these forests are clusters. Each cluster's classes are cut into blocks of about BLOCK rows by size; for each
   two blocks whose sizes allow links, the product of their incidence blocks accumulates the overlap counts, and pairs
   below the bound are discarded. A product emits each class's number of links, and a spanning forest of the links.
5. Components of the links give component_id, and sums give n_links; both go from classes to their documents.

Copies cost one row of each table after step 1, however many there are. The large tables, posts and what is kept of them, are deleted once
the candidates are written, before the sets are packed.

Defined results: null texts and texts without words have no shingles, no links and themselves as component. Fewer words
than a shingle has: the whole sequence is the one shingle. Equal sets always link. Repeated rows and repeated ids are
documents of their own, with a result each. Rows without id link with nothing and have null component. Other columns are
not looked at. Shingles are told apart by 64-bit hashes, sets by 128-bit ones.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from screenweave.llm.common import bounded, chunks, dropped, fresh, table, tidy, written
from screenweave.llm.graph import components
from screenweave.llm.textarrays import mix64, shingles

#: Frequent shingles whose order by frequency is kept; what the driver gets of them is 16 bytes each at most.
ORDERED = 50_000
#: Sets of ids up to this size are sent to all tasks as a hash table; larger ones are joined by a shuffle.
SENT_IDS = 500_000
GROUP, BLOCK = 2048, 256
#: Candidate rows that one task handles, about; posts that one chunk is counted over.
TASK_ROWS, COUNTED = 20_000, 2_000_000
#: Other half of the fingerprints.
SECOND = 0x3C6EF372FE94F82B
_U = np.uint64


def _slices(doc: np.ndarray, n: int) -> np.ndarray:
    return np.searchsorted(doc, np.arange(n + 1))


def prefix_length(n: np.ndarray, percent: int) -> np.ndarray:
    """Of a set's n shingles in the common order, a linked set has one among so many first ones: n - ceil(n * percent / 100) + 1."""
    return n - -(-n * percent // 100) + 1


def needed(a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    """The least overlap that links sets of sizes a and b: the least o with 100 o >= percent (a + b - o)."""
    return -(-percent * (a + b) // (100 + percent))


def bins(n: int) -> int:
    """Bins of the histogram of a set of n hashes: a power of two, about 24 hashes in each."""
    return 1 << max(4, int(np.ceil(np.log2(max(n, 1) / 24))))


def histogram(value: np.ndarray) -> np.ndarray:
    """Counts by the top bits of sorted, mixed hashes."""
    k = bins(len(value))
    return np.bincount((value >> _U(64 - (k.bit_length() - 1))).astype(np.int64), minlength=k).astype(np.uint16)


def bound(a: np.ndarray, many: np.ndarray) -> np.ndarray:
    """Upper bound of the overlap of one histogram with each row of others: per bin, the smaller count."""
    while len(a) > many.shape[1]:
        a = a[::2] + a[1::2]
    while many.shape[1] > len(a):
        many = many[:, ::2] + many[:, 1::2]
    return np.minimum(a, many).sum(axis=1, dtype=np.int64)


class Forest:
    """Union-find over dense indices; `united` keeps the edges that joined two trees."""

    def __init__(self, n: int):
        self.up = np.arange(n)
        self.united: list[tuple[int, int]] = []

    def root(self, x: int) -> int:
        up = self.up
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return int(x)

    def unite(self, a: int, b: int) -> None:
        x, y = self.root(a), self.root(b)
        if x != y:
            self.up[max(x, y)] = min(x, y)
            self.united.append((a, b))


def fingerprints(value: np.ndarray, at: np.ndarray, seed: int = 0x6A09E667F3BCC909) -> np.ndarray:
    """A 64-bit fingerprint of each set value[at[k]:at[k + 1]], whatever the order of its members."""
    total = np.concatenate([[_U(0)], np.cumsum(mix64(value ^ _U(seed)), dtype=np.uint64)])
    return mix64(total[at[1:]] - total[at[:-1]]).view(np.int64)


def profile(docs: DataFrame, words_: int) -> DataFrame:
    """One table with a row (id, hash, n, f1, f2, null, null) for each document, and rows (null, ..., shingle, count) of shingles that a task met twice or more."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept: list[tuple[np.ndarray, np.ndarray]] = []
        waiting: list[np.ndarray] = []

        def flush() -> None:
            if waiting:
                u, c = np.unique(np.concatenate(waiting), return_counts=True)
                waiting.clear()
                kept.append((u[c > 1], c[c > 1]))

        for b in batches:
            ids, texts, hashes = b["doc_id"].to_numpy(), b["text"].tolist(), b["hash"].to_numpy()
            for part in chunks(texts):
                doc, value = shingles(texts[part], words_)
                m = len(ids[part])
                n = np.bincount(doc, minlength=m)
                at = np.concatenate([[0], np.cumsum(n)])
                none = pd.array([None] * m, dtype="Int64")
                yield pd.DataFrame({"id": ids[part], "hash": hashes[part], "n": n, "f1": fingerprints(value, at), "f2": fingerprints(value, at, SECOND), "shingle": none, "count": none})
                waiting.append(value)
                if sum(map(len, waiting)) > 2_000_000:
                    flush()
        flush()
        tidy()
        for u, c in kept:
            none = pd.array([None] * len(u), dtype="Int64")
            yield pd.DataFrame({"id": none, "hash": none, "n": none, "f1": none, "f2": none, "shingle": u.view(np.int64), "count": c})

    return docs.mapInPandas(run, "id long, hash long, n long, f1 long, f2 long, shingle long, count long")


def _of(docs: DataFrame, chosen: DataFrame, n: int) -> DataFrame:
    """(id, text, of1, of2) of the documents that represent the chosen classes (columns id, first, hash, f1, f2)."""
    small = chosen.select(F.col("first").alias("doc_id"), "hash", "id", F.col("f1").alias("of1"), F.col("f2").alias("of2"))
    return docs.join(F.broadcast(small) if n <= SENT_IDS else small, ["doc_id", "hash"]).select("id", "text", "of1", "of2")


def _unseen(seen: set, f1: np.ndarray, f2: np.ndarray) -> np.ndarray:
    """Which classes weren't in `seen` yet; they are put in."""
    out = np.zeros(len(f1), dtype=bool)
    for k, pair in enumerate(zip(f1.tolist(), f2.tolist())):
        if pair not in seen:
            seen.add(pair)
            out[k] = True
    return out


def prefixes(docs: DataFrame, frequent: pd.DataFrame, words_: int, percent: int) -> DataFrame:
    """(shingle, f1, f2, n, place, sketch) of each class's prefix, once for each task that has it; the class's histogram is with its first row."""
    ranked = np.sort(frequent["shingle"].to_numpy(np.int64).view(np.uint64)) if len(frequent) else np.zeros(0, np.uint64)
    order = np.argsort(frequent["shingle"].to_numpy(np.int64).view(np.uint64)) if len(frequent) else np.zeros(0, np.int64)
    rank = order + 1  # `frequent` comes by rising frequency; 0 is for all other shingles

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: set = set()
        for b in batches:
            texts = b["text"].tolist()
            for part in chunks(texts):
                doc, value = shingles(texts[part], words_)
                n = np.bincount(doc, minlength=len(texts[part]))
                at = _slices(doc, len(n))
                weight = np.zeros(len(value), dtype=np.int64)
                if len(ranked) and len(value):
                    where = np.minimum(np.searchsorted(ranked, value), len(ranked) - 1)
                    hit = ranked[where] == value
                    weight[hit] = rank[where[hit]]
                out: list[list[np.ndarray]] = [[], [], [], [], []]
                sketch, f1, f2 = [], fingerprints(value, at), fingerprints(value, at, SECOND)
                for d in np.flatnonzero((n > 0) & _unseen(seen, f1, f2)):
                    s = slice(at[d], at[d + 1])
                    k = int(prefix_length(n[d], percent))
                    first = np.argsort(weight[s], kind="stable")[:k]
                    out[0].append(value[s][first])
                    out[1].append(np.full(k, f1[d]))
                    out[2].append(np.full(k, f2[d]))
                    out[3].append(np.full(k, n[d]))
                    out[4].append(np.arange(k))
                    sketch += [histogram(value[s]).tobytes()] + [None] * (k - 1)
                if sketch:
                    cols = [np.concatenate(x) for x in out]
                    yield pd.DataFrame({"shingle": cols[0].view(np.int64), "f1": cols[1], "f2": cols[2], "n": cols[3], "place": cols[4], "sketch": sketch})
            tidy()

    return docs.mapInPandas(run, "shingle long, f1 long, f2 long, n long, place int, sketch binary")


def very_frequent(posts: DataFrame) -> DataFrame:
    """(shingle) of more than GROUP posts. One of some chunks of the posts must hold its share of them, so that only a few shingles are counted over tasks."""
    every = posts.select("shingle")
    parts = every.rdd.getNumPartitions() + every.count() // COUNTED  # a part's last chunk may be short
    least = GROUP // max(1, parts) + 1
    if least > 1:

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            waiting, n = [], 0

            def often() -> pd.DataFrame:
                u, c = np.unique(np.concatenate(waiting), return_counts=True)
                return pd.DataFrame({"shingle": u[c >= least]})

            for b in batches:
                values = b["shingle"].to_numpy()
                while n + len(values) >= COUNTED:
                    waiting.append(values[: COUNTED - n])
                    yield often()
                    values, waiting, n = values[COUNTED - n :], [], 0
                waiting.append(values)
                n += len(values)
            if n:
                yield often()
            waiting.clear()
            tidy()

        some = written(every.mapInPandas(run, "shingle long").distinct(), "often")
        every = every.join(F.broadcast(some) if some.count() <= SENT_IDS else some, "shingle", "left_semi")
    return every.groupBy("shingle").agg(F.count("*").alias("rows")).where(F.col("rows") > GROUP).select("shingle")


def band(n: Column, percent: int) -> Column:
    """Sets that may link are in the same band or in neighbouring ones."""
    return F.floor(F.log(n) / F.log(F.lit(100.5 / percent))).cast("int")


def cells(posts: DataFrame, percent: int) -> DataFrame:
    """(shingle, band, rows, parts, up): the cells with a row that has a candidate.

    A cell's pairs are those among its own rows, and those of its own rows with its guests, the rows of the band below.
    `parts`: over how many parts the cell is dealt, null if it has no pair; `up`: the same of the cell above, null if
    that one takes in no guests.
    """
    extremes = [f(c).alias(f"{c}_{k}") for c in ("f1", "f2", "n") for k, f in (("low", F.min), ("high", F.max))]
    own = posts.groupBy("shingle", "band").agg(F.count("*").alias("rows"), *extremes)
    bands = W.partitionBy("shingle").orderBy("band")  # a shingle has few bands: their number grows with the logarithm of a set's size
    below = F.when(F.lag("band").over(bands) == F.col("band") - 1, F.lag(F.struct("n_high", "rows")).over(bands))
    guests = F.coalesce(F.col("below.n_high") * 100 >= F.col("n_low") * percent, F.lit(False))
    # of copies that several tasks have met there is one class only: no pair
    some = (F.col("f1_low") != F.col("f1_high")) | (F.col("f2_low") != F.col("f2_high")) | F.col("guests")
    out = own.withColumn("below", below).withColumn("guests", guests)
    out = out.withColumn("parts", F.when(some, F.ceil((F.col("rows") + F.when(F.col("guests"), F.col("below.rows")).otherwise(0)) / GROUP)).cast("int"))
    up = F.when((F.lead("band").over(bands) == F.col("band") + 1) & F.lead("guests").over(bands), F.lead("parts").over(bands))
    return out.withColumn("up", up).where("parts is not null or up is not null").select("shingle", "band", "rows", "parts", "up")


def _ordinary(posts: DataFrame, percent: int) -> DataFrame:
    """The posts that have a candidate among those of their shingle: sizes are sorted, so a class has one if a neighbour's size is near enough."""
    near = W.partitionBy("shingle").orderBy("n", "f1", "f2")
    copy = F.coalesce((F.lag("f1").over(near) == F.col("f1")) & (F.lag("f2").over(near) == F.col("f2")), F.lit(False))
    once = posts.withColumn("copy", copy).where("not copy").drop("copy")
    both = once.withColumns({"before": F.lag("n").over(near), "after": F.lead("n").over(near)})
    shared = both.where((F.col("before") * 100 >= F.col("n") * percent) | (F.col("n") * 100 >= F.col("after") * percent)).drop("before", "after")
    return shared.select("shingle", "f1", "f2", "n", "place", F.lit(-1).alias("band"), F.lit(1).alias("parts"), F.lit(False).alias("guest"))


def _hot(posts: DataFrame, percent: int) -> DataFrame:
    """The posts of very frequent shingles in the cells where they have a candidate, without a window or a task for a shingle."""
    posts = posts.withColumn("band", band(F.col("n"), percent))
    found = written(cells(posts, percent), "cells")
    # posts of a large cell meet it by a salt
    salts = F.ceil(F.col("rows") / GROUP).cast("int")
    large = found.where(F.col("rows") > GROUP).select("shingle", "band", salts.alias("salts"))
    large = F.broadcast(large) if large.count() <= SENT_IDS else large
    dealt = posts.join(large, ["shingle", "band"], "left").withColumn("salt", F.coalesce(F.pmod(F.xxhash64("f1", "f2"), F.col("salts")), F.lit(0)).cast("int")).drop("salts")
    salted = found.select("shingle", "band", "parts", "up", F.explode(F.sequence(F.lit(0), salts - 1)).alias("salt"))
    kept = dealt.join(salted, ["shingle", "band", "salt"]).drop("salt").distinct()
    # own rows go to their band's cell, and as guests to the one above
    to = F.filter(F.array(F.struct("band", "parts", F.lit(False).alias("guest")), F.struct((F.col("band") + 1).alias("band"), F.col("up").alias("parts"), F.lit(True).alias("guest"))), lambda x: x["parts"].isNotNull())
    return kept.withColumn("to", F.explode(to)).select("shingle", "f1", "f2", "n", "place", "to.*")


def candidates(posts: DataFrame, classes: DataFrame, hot: DataFrame, percent: int) -> DataFrame:
    """Edges (a, b), numbers of classes, of spanning forests of the candidates in each cell, written: the posts aren't read again. hot: the shingles that are very frequent."""
    rows = posts.select("shingle", "f1", "f2", "n", "place")
    n_hot = hot.count()
    hot = F.broadcast(hot) if n_hot <= SENT_IDS else hot
    kept = _ordinary(rows.join(hot, "shingle", "left_anti") if n_hot else rows, percent)
    if n_hot:
        kept = kept.unionByName(_hot(rows.join(hot, "shingle", "left_semi"), percent))
    kept = written(kept, "kept")
    # the number and the histogram of each class that is left
    left = kept.select("f1", "f2").distinct()
    sketches = posts.where("sketch is not null").select("f1", "f2", "sketch").join(left, ["f1", "f2"], "left_semi").dropDuplicates(["f1", "f2"])
    named = sketches.join(classes.select("f1", "f2", "node"), ["f1", "f2"])
    # a row goes to all pairs of parts with its own in them
    part = F.pmod(F.xxhash64("f1", "f2"), F.col("parts")).cast("int")
    placed = kept.withColumn("part", part).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    pairs = placed.withColumn("tile", F.least("part", "other") * F.col("parts") + F.greatest("part", "other")).drop("other", "parts", "part")
    size = kept.agg(F.sum("parts").alias("rows")).first()["rows"] or 0
    tasks = max(int(posts.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // TASK_ROWS))
    tiled = pairs.join(named, ["f1", "f2"]).drop("f1", "f2").withColumn("task", F.pmod(F.xxhash64("shingle", "band", "tile"), F.lit(tasks)).cast("int"))

    def run(group: pd.DataFrame) -> pd.DataFrame:
        own, index = np.unique(group["node"].to_numpy(), return_inverse=True)
        forest = Forest(len(own))
        first = np.zeros(len(own), dtype=np.int64)
        first[index] = np.arange(len(index))
        hist = [np.frombuffer(group["sketch"].iloc[k], dtype=np.uint16) for k in first]
        wide = np.array([len(h) for h in hist])
        table_ = {int(k): np.array([h for h in hist if len(h) == k]) for k in np.unique(wide)}
        inside = np.zeros(len(own), dtype=np.int64)
        for k in table_:
            inside[wide == k] = np.arange((wide == k).sum())
        shingle, tile, of_band = group["shingle"].to_numpy(), group["tile"].to_numpy(), group["band"].to_numpy()
        size, place, guest = group["n"].to_numpy(np.int64), group["place"].to_numpy(np.int64), group["guest"].to_numpy(bool)
        order = np.lexsort((size, tile, of_band, shingle))
        shingle, tile, of_band, size, place, index, guest = (x[order] for x in (shingle, tile, of_band, size, place, index, guest))
        new = (shingle[1:] != shingle[:-1]) | (tile[1:] != tile[:-1]) | (of_band[1:] != of_band[:-1])
        cut = np.flatnonzero(np.concatenate([[True], new, [True]]))
        for lo, hi in zip(cut[:-1], cut[1:]):
            if hi - lo < 2:
                continue
            for i in range(lo, hi - 1):
                top = lo + np.searchsorted(size[lo:hi], size[i] * 100 // percent, side="right")
                j = np.arange(i + 1, top)
                if guest[i]:  # guests are paired among themselves in their own cell
                    j = j[~guest[j]]
                if not len(j):
                    continue
                j = j[index[j] != index[i]]
                mine = forest.root(index[i])
                j = j[forest.up[index[j]] != mine]
                a, b, p, q = size[i], size[j], place[i], place[j]
                must = needed(a, b, percent)
                j = j[np.minimum(p, q) + 1 + np.minimum(a - p - 1, b - q - 1) >= must]
                for k in np.unique(wide[index[j]]):
                    of = j[wide[index[j]] == k]
                    good = bound(hist[index[i]], table_[int(k)][inside[index[of]]]) >= needed(a, size[of], percent)
                    for x in of[good]:
                        forest.unite(int(index[i]), int(index[x]))
        e = np.array(forest.united, dtype=np.int64).reshape(-1, 2)
        tidy()
        return pd.DataFrame({"a": own[e[:, 0]], "b": own[e[:, 1]]})

    edges = written(tiled.groupBy("task").applyInPandas(run, "a long, b long"), "candidates")
    dropped(kept)
    return edges


def product(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Overlap counts of two blocks of sorted sets: the incidence blocks' sparse product, column by column."""
    out = np.zeros((len(left), len(right)), dtype=np.int64)
    if not left or not right:
        return out
    value = np.concatenate([*left, *right])
    row = np.repeat(np.arange(len(left) + len(right)), [len(x) for x in [*left, *right]])
    column = np.unique(value, return_inverse=True)[1]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    # a shingle of one set adds nothing
    shared = np.bincount(column)[column] > 1
    row, column = row[shared], np.cumsum(np.diff(column[shared], prepend=-1) != 0) - 1
    n = int(column[-1]) + 1 if len(column) else 0
    for begin in range(0, n, 4096):
        lo, hi = np.searchsorted(column, [begin, begin + 4096])
        dense = np.zeros((len(left) + len(right), min(4096, n - begin)), dtype=np.float32)
        dense[row[lo:hi], column[lo:hi] - begin] = 1
        out += np.rint(dense[: len(left)] @ dense[len(left) :].T).astype(np.int64)
    return out


def links(sets: DataFrame, members: DataFrame, percent: int) -> DataFrame:
    """Rows (a, b, n): b null: class a has n more links; b not null: an edge of a spanning forest of the links.

    members: (id, cluster, n, of), of being the number of documents in the class.
    """
    # a cluster of up to BLOCK classes is one part; larger ones are cut by bands of sizes, and bands by a hash
    many = members.groupBy("cluster", F.floor(F.log("n") / F.log(F.lit(1.1))).cast("int").alias("band")).agg(F.count("*").alias("c"))
    total = many.groupBy("cluster").agg(F.sum("c").alias("all")).where(F.col("all") > BLOCK)
    cuts = many.join(total, "cluster").select("cluster", "band", F.ceil(F.col("c") / BLOCK).alias("cuts"))
    # one row for each band of the few large clusters: sent to all tasks if the table is small, so that no cluster meets in one
    cuts = written(cuts, "cuts")
    cuts = F.broadcast(cuts) if cuts.count() <= SENT_IDS else cuts
    banded = members.withColumn("band", F.floor(F.log("n") / F.log(F.lit(1.1))).cast("int")).join(cuts, ["cluster", "band"], "left")
    part = F.when(F.col("cuts").isNull(), F.lit(0)).otherwise((F.col("band") + 1) * (1 << 32) + F.pmod(F.xxhash64("id"), F.col("cuts"))).cast("long")
    blocked = banded.withColumn("part", part).drop("band", "cuts")
    ranges = blocked.groupBy("cluster", "part").agg(F.min("n").alias("low"), F.max("n").alias("high"))
    x, y = ranges.alias("x"), ranges.alias("y")
    tiles = x.join(y, (F.col("x.cluster") == F.col("y.cluster")) & (F.col("x.part") <= F.col("y.part")) & (F.col("y.low") * percent <= F.col("x.high") * 100) & (F.col("x.low") * percent <= F.col("y.high") * 100)).select("x.cluster", F.col("x.part").alias("i"), F.col("y.part").alias("j"))
    ends = tiles.withColumn("part", F.explode(F.array_distinct(F.array("i", "j"))))
    rows = blocked.join(ends, ["cluster", "part"]).join(sets, "id").select("cluster", "i", "j", "part", "id", "of", "data")

    def run(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        _, i, j = key
        side = [group[group["part"] == p].drop_duplicates("id").sort_values("id") for p in (i, j)]
        data = [[np.frombuffer(d, dtype=np.uint64) for d in s["data"]] for s in side]
        size = [np.array([len(d) for d in x]) for x in data]
        overlap = product(*data)
        good = 100 * overlap >= percent * (size[0][:, None] + size[1][None, :] - overlap)
        if i == j:
            np.fill_diagonal(good, False)
        weight = [s["of"].to_numpy(np.int64) for s in side]
        ids = [s["id"].to_numpy(np.int64) for s in side]
        out = [(ids[0], good @ weight[1])] + ([(ids[1], good.T @ weight[0])] if i != j else [])
        counts = pd.concat([pd.DataFrame({"a": k, "b": pd.array([None] * len(k), dtype="Int64"), "n": v}) for k, v in out])
        own, index = np.unique(np.concatenate(ids), return_inverse=True)
        forest = Forest(len(own))
        for r, c in zip(*np.nonzero(good)):
            forest.unite(int(index[r]), int(index[len(ids[0]) + c]))
        e = np.array(forest.united, dtype=np.int64).reshape(-1, 2)
        tidy()
        edges = pd.DataFrame({"a": own[e[:, 0]], "b": pd.array(own[e[:, 1]], dtype="Int64"), "n": 0})
        return pd.concat([counts[counts["n"] > 0], edges])

    return rows.groupBy("cluster", "i", "j").applyInPandas(run, "a long, b long, n long")


def packed(docs: DataFrame, words_: int) -> DataFrame:
    """(id, data): each class with its sorted shingles as a binary, of documents by _of()."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: set = set()
        for b in batches:
            ids, texts, of1, of2 = b["id"].to_numpy(), b["text"].tolist(), b["of1"].to_numpy(), b["of2"].to_numpy()
            for part in chunks(texts):
                doc, value = shingles(texts[part], words_)
                at = _slices(doc, len(texts[part]))
                # texts of one id and hash may be of several classes
                own = (fingerprints(value, at) == of1[part]) & (fingerprints(value, at, SECOND) == of2[part])
                new = {i: k for k, i in enumerate(ids[part].tolist()) if own[k] and i not in seen}
                seen.update(new)
                yield pd.DataFrame({"id": pd.array(list(new), dtype="Int64"), "data": [value[at[k] : at[k + 1]].tobytes() for k in new.values()]})
            tidy()

    # a repeated row may be met by several tasks
    return docs.mapInPandas(run, "id long, data binary").dropDuplicates(["id"])


def joined(docs: DataFrame, text: str = "text", key: str = "doc_id", words_: int = 4, percent: int = 85, named: bool = False) -> DataFrame:
    """(doc_id, n_shingles, n_links, component_id) of every row. n_links counts the other documents that link with it, copies included. If `named`, also the hash of the row's text, and a number of its component (null for rows without id or shingles) that no other component has, which component_id is only if ids are unique."""
    bounded(docs.sparkSession)
    body = F.col(text).cast("string")
    texts = docs.select(F.col(key).cast("long").alias("doc_id"), body.alias("text"), F.xxhash64(body).alias("hash"))
    found = written(profile(texts, words_), "profile")
    rows = found.where("shingle is null").select("id", "hash", "n", "f1", "f2")
    frequent = found.where("shingle is not null").groupBy("shingle").agg(F.sum("count").alias("count"))
    ordered = frequent.orderBy(F.desc("count"), "shingle").limit(ORDERED).toPandas().sort_values(["count", "shingle"]).reset_index(drop=True)
    # the row that represents a class is told by its id and the hash of its text
    classes = rows.where("n > 0 and id is not null").groupBy("n", "f1", "f2").agg(F.min("id").alias("first"), F.min_by("hash", F.struct("id", "hash")).alias("hash"), F.count("*").alias("of"))
    classes = written(classes.withColumn("node", F.monotonically_increasing_id()), "classes")
    posts = written(prefixes(texts.where("doc_id is not null"), ordered, words_, percent), "posts")
    hot = written(very_frequent(posts), "hot")
    near = candidates(posts, classes, hot, percent)
    dropped(posts)
    near = components(near).withColumnRenamed("component", "cluster")
    members = written(near.join(classes, "node").select(F.col("node").alias("id"), "cluster", "n", "f1", "f2", "of", "first", "hash"), "members")
    sets = packed(_of(texts, members, members.count()), words_)
    out = written(links(sets, members.select("id", "cluster", "n", "of"), percent), "links")
    groups = components(out.where("b is not null").select("a", "b"))
    counts = out.where("b is null").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("links"))
    grouped = classes.join(groups, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = grouped.groupBy("component").agg(F.min("first").alias("component_id"))
    by_class = grouped.join(least, "component").join(counts, "node", "left")
    by_class = by_class.select("n", "f1", "f2", *["component"] * named, "component_id", (F.coalesce("links", F.lit(0)) + F.col("of") - 1).alias("n_links"))
    whole = rows.join(by_class, ["n", "f1", "f2"], "left")
    alone = F.col("component_id").isNull() | F.col("id").isNull()
    return whole.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.when(alone, 0).otherwise(F.col("n_links")).alias("n_links"), F.when(alone, F.col("id")).otherwise(F.col("component_id")).alias("component_id"), *["hash", F.when(~alone, F.col("component")).alias("component")] * named)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joined(table(spark, sf_dir, "documents"))


#: The same in DuckDB's SQL, by counting all common shingles.
ORACLE = r"""
WITH RECURSIVE t AS (SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT row, doc_id, unnest(CASE WHEN len(w) >= 4 THEN [array_to_string(w[i:i + 3], ' ') FOR i IN range(1, len(w) - 2)] WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS g FROM t),
n AS (SELECT row, count(*) AS n FROM s GROUP BY 1),
o AS (SELECT a.row AS a, b.row AS b, count(*) AS o FROM s a JOIN s b ON a.g = b.g AND a.row <> b.row GROUP BY 1, 2),
l AS (SELECT a, b FROM o JOIN n x ON x.row = a JOIN n y ON y.row = b WHERE 100 * o >= 85 * (x.n + y.n - o)),
r(row, root) AS (SELECT row, doc_id FROM t UNION SELECT l.b, r.root FROM r JOIN l ON l.a = r.row),
c AS (SELECT row, min(root) AS component_id FROM r GROUP BY 1)
SELECT t.doc_id, coalesce(n.n, 0) AS n_shingles, (SELECT count(*) FROM l WHERE l.a = t.row) AS n_links, c.component_id FROM t LEFT JOIN n USING (row) JOIN c USING (row)"""


#: Near duplicates in the pipeline: five words and a similarity of 0.8.
STAGE_WORDS, STAGE_PERCENT = 5, 80


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each group of near duplicates, the one with the smallest id (of rows with that id, the smallest hash of the text; of rows equal in both, the smallest); rows without id or shingles stay."""
    found = joined(docs, words_=STAGE_WORDS, percent=STAGE_PERCENT, named=True).where("component is not null")
    keys = written(found.groupBy("component", "doc_id", "hash").agg(F.count("*").alias("of")), "keys")
    own = F.struct("doc_id", "hash")
    first = keys.groupBy("component").agg(F.min(own).alias("first"), F.count("*").alias("keys")).where("keys > 1").drop("keys")
    gone = written(keys.join(first, "component").where(own != F.col("first")).select("doc_id", "hash"), "gone")
    n = gone.count()
    i, h = fresh(docs, "id_as_long", "text_hash")
    named = lambda rows: rows.select(F.col("doc_id").alias(i), F.col("hash").alias(h))
    gone = F.broadcast(named(gone)) if n <= SENT_IDS else named(gone)
    kept = docs.withColumns({i: F.col("doc_id").cast("long"), h: F.xxhash64(F.col("text").cast("string"))}).join(gone, [i, h], "left_anti")
    equal = named(keys.where("of > 1"))
    if equal.isEmpty():
        return kept.select(*docs.columns)
    least = kept.join(equal, [i, h], "left_semi").groupBy(i, h).agg(F.min(F.struct(*docs.columns)).alias("row"))
    return kept.join(equal, [i, h], "left_anti").select(*docs.columns).unionAll(least.select("row.*"))
