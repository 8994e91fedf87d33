"""Language-model scoring by context-tree weighting over bytes.

A text's words, lower-cased and joined by single blanks, and one end byte are the symbols. Each byte is eight binary
decisions; every decision has its own context tree whose contexts are the 0 to DEPTH preceding bytes. A node has
Krichevsky-Trofimov counts of the training texts; its weighted probability is half that estimate and half the product
over its children, so that all tree depths are mixed. Scoring freezes the trees: a byte's probability is the product of
its bits' posterior-weighted estimates along the context path (the log-probabilities below depend on all depths).

Layout. Documents are dealt into blocks by a hash of the id. A block sends to each shard of the contexts (by the two
nearest bytes) its distinct (DEPTH + 1)-grams with their training counts, packed in one binary; words go the same way
by their hash. A shard adds the counts of all blocks, builds its subtrees and answers each block with one number for
each gram that it asked for. So a block gets just the part of the model that its texts need; the model as a whole is
never collected or broadcast, however much it grows with the corpus. A shard's task reads its part of the model and then
the requests one by one as they come from the shuffle: neither is held twice, and nothing is sent more than once. Only the nodes of depth 0 and 1 (at most 257 x 255
of them) depend on all shards; those are summed up and sent to every task.

Grams are exact (the bytes themselves, DEPTH + 1 of them in 64 bits). Words are told apart by 64-bit hashes.

Blocks hold BLOCK_BYTES of text or one longer text; repeats of a row beyond that are dealt to several blocks. The table is read
twice and must be the same both times.

Defined results: null texts are empty; an empty text has one token, the end. Without training rows every bit has
probability 1/2. Equal texts get equal scores. Repeated rows count each time. Other columns are not looked at.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from screenweave.llm.common import bounded, chunks, fold, table, tidy, written
from screenweave.llm.textarrays import words

DEPTH = 5
BLOCK_BYTES = 8_000_000
MIN_BLOCKS = 48
SHARDS = 48
#: Beyond so much text the size of a block and the number of shards grow, each with the square root of the text, so that their product, the number of requests, grows in proportion to it.
EVEN_BYTES = 32_000_000_000
END = 10
_U = np.uint64
LN2, LN10 = float(np.log(2)), float(np.log(10))


def pack(*arrays: np.ndarray) -> bytes:
    """Equally long arrays, the first sorted: differences of the first, then the others, deflated by byte planes."""
    out = [len(arrays[0]).to_bytes(8, "little")]
    for k, a in enumerate(arrays):
        a = np.diff(a, prepend=a.dtype.type(0)) if k == 0 else a
        out.append(np.ascontiguousarray(a.view(np.uint8).reshape(len(a), a.dtype.itemsize).T).tobytes())
    return zlib.compress(b"".join(out), 1)


def unpack(data: bytes, *kinds) -> list[np.ndarray]:
    raw = zlib.decompress(data)
    n, at, out = int.from_bytes(raw[:8], "little"), 8, []
    for k, kind in enumerate(map(np.dtype, kinds)):
        a = np.ascontiguousarray(np.frombuffer(raw, np.uint8, n * kind.itemsize, at).reshape(kind.itemsize, n).T).view(kind).ravel()
        out.append(np.cumsum(a, dtype=kind) if k == 0 else a)
        at += n * kind.itemsize
    return out


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, sorted, and the sums of their counts."""
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts


def symbols(texts) -> tuple[np.ndarray, np.ndarray]:
    """The symbols of a batch, DEPTH end bytes before each text as its first context, and the end of each text in them."""
    raw = [b"\n" * DEPTH + b" ".join((t or "").encode("utf-8", "surrogatepass").lower().split()) + b"\n" for t in texts]
    return np.frombuffer(b"".join(raw), dtype=np.uint8), np.cumsum(np.fromiter(map(len, raw), dtype=np.int64, count=len(raw)))


def grams(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes of all grams, and the document of each. From the top: the nearest context byte, ..., the farthest, the symbol."""
    n = len(data) - DEPTH
    code = np.zeros(max(n, 0), dtype=np.uint64)
    for k in range(DEPTH - 1, -1, -1):
        code = (code << _U(8)) | data[k : k + n]
    code = (code << _U(8)) | data[DEPTH:]
    size = np.diff(ends, prepend=0)
    at = np.arange(n) + DEPTH
    start = np.repeat(ends - size, size)[DEPTH:]
    keep = at - start >= DEPTH
    return code[keep], np.repeat(np.arange(len(ends)), size - DEPTH)


def gram_shard(code: np.ndarray, shards: int) -> np.ndarray:
    near = code >> _U(8 * (DEPTH - 1))
    return ((near * _U(0x9E3779B97F4A7C15)) >> _U(33)) % _U(shards)


def word_shard(h: np.ndarray, shards: int) -> np.ndarray:
    return (h >> _U(20)) % _U(shards)


_half = np.concatenate([[0.0], np.cumsum(np.log(np.arange(1 << 16) + 0.5))])
_full = np.concatenate([[0.0], np.cumsum(np.log(np.arange(1 << 16) + 1.0))])


def _stirling(x: np.ndarray) -> np.ndarray:
    return (x - 0.5) * np.log(x) - x + 0.9189385332046727 + 1 / (12 * x) - 1 / (360 * x**3)


_BASE_HALF = float(_stirling(np.array(0.5 + 60)) - np.log(np.arange(60) + 0.5).sum())


def log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Natural log of the Krichevsky-Trofimov block probability."""

    def rising(n: np.ndarray, known: np.ndarray, base: float, start: float) -> np.ndarray:
        small = known[np.minimum(n, len(known) - 1)]
        large = _stirling(np.maximum(n, 1) + start) - base
        return np.where(n < len(known), small, large)

    return rising(zeros, _half, _BASE_HALF, 0.5) + rising(ones, _half, _BASE_HALF, 0.5) - rising(zeros + ones, _full, 0.0, 1.0)


def bit_nodes(context: np.ndarray, symbol: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(node, zeros, ones) of (context, symbol, count) rows sorted by both; a node is context << 8 | its place 1..255 among the symbol's bits."""
    keys, zeros, ones = [], [], []
    full = (context << _U(8)) | symbol
    for bit in range(8):
        prefix = full >> _U(8 - bit)  # context and the bits before
        first = np.flatnonzero(np.concatenate([[True], prefix[1:] != prefix[:-1]]))
        one = (symbol >> _U(7 - bit)) & _U(1)
        keys.append(((prefix[first] >> _U(bit)) << _U(8)) | (_U(1 << bit) | (prefix[first] & _U((1 << bit) - 1))))
        ones.append(np.add.reduceat(np.where(one == 1, count, 0), first))
        zeros.append(np.add.reduceat(np.where(one == 0, count, 0), first))
    key = np.concatenate(keys)
    order = np.argsort(key)
    return key[order], np.concatenate(zeros)[order], np.concatenate(ones)[order]


class Tree:
    """Subtrees of the contexts of depth `top` or more. Arrays by depth: node keys, counts, log weighted probabilities."""

    def __init__(self, codes: np.ndarray, counts: np.ndarray, top: int):
        self.codes, self.top = codes, top
        symbol, context = codes & _U(255), codes >> _U(8)
        self.levels: dict[int, list[np.ndarray]] = {}
        for depth in range(DEPTH, top - 1, -1):
            level = (context >> _U(8 * (DEPTH - depth))) << _U(8) | symbol
            key, n = summed(level, counts)
            nodes, zeros, ones = bit_nodes(key >> _U(8), key & _U(255), n)
            own = log_kt(zeros, ones)
            if depth == DEPTH:
                weighted = own
            else:
                below, _, _, _, deep = self.levels[depth + 1]
                parent = ((below >> _U(16)) << _U(8)) | (below & _U(255))
                kids = np.zeros(len(nodes))
                np.add.at(kids, np.searchsorted(nodes, parent), deep)
                weighted = np.logaddexp(own, kids) - LN2
            self.levels[depth] = [nodes, zeros, ones, own, weighted]

    def roots(self) -> tuple[np.ndarray, ...]:
        """(node, zeros, ones, log weighted probability) of the contexts of depth `top`."""
        nodes, zeros, ones, _, weighted = self.levels[self.top]
        return nodes, zeros, ones, weighted

    def mixed(self, start) -> None:
        """Turns the levels into (node, mixed, rest): the chance of a one that the depths so far give, and the weight that is left for deeper ones.

        `start` gives both for a node of depth top - 1, or None if top is 0.
        """
        self.mix: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        for depth in range(self.top, DEPTH + 1):
            nodes, zeros, ones, own, weighted = self.levels[depth]
            stop = np.ones(len(nodes)) if depth == DEPTH else np.exp(np.minimum(own - LN2 - weighted, 0))
            if depth == 0:
                before, rest = np.zeros(len(nodes)), np.ones(len(nodes))
            else:
                parent = ((nodes >> _U(16)) << _U(8)) | (nodes & _U(255))
                if depth == self.top:
                    before, rest = start(parent)
                else:
                    up, m, r = self.mix[depth - 1]
                    at = np.searchsorted(up, parent)
                    before, rest = m[at], r[at]
            kt = (ones + 0.5) / (zeros + ones + 1.0)
            self.mix[depth] = nodes, before + rest * stop * kt, rest * (1 - stop)

    def chance(self, codes: np.ndarray, start) -> np.ndarray:
        """log10 of the probability of each gram's symbol after its context."""
        total = np.zeros(len(codes))
        symbol, context = codes & _U(255), codes >> _U(8)
        for bit in range(8):
            place = (_U(1 << bit)) | (symbol >> _U(8 - bit))
            m, r = start((context >> _U(8 * (DEPTH - self.top + 1)) << _U(8)) | place) if self.top else (np.zeros(len(codes)), np.ones(len(codes)))
            m, r = m.copy(), r.copy()
            alive = np.arange(len(codes))
            for depth in range(self.top, DEPTH + 1):
                nodes, mixed, rest = self.mix[depth]
                if not len(nodes) or not len(alive):
                    break
                key = ((context[alive] >> _U(8 * (DEPTH - depth))) << _U(8)) | place[alive]
                at = np.minimum(np.searchsorted(nodes, key), len(nodes) - 1)
                hit = nodes[at] == key
                alive, at = alive[hit], at[hit]
                m[alive], r[alive] = mixed[at], rest[at]
            one = m + 0.5 * r
            total += np.log10(np.where((symbol >> _U(7 - bit)) & _U(1) == 1, one, 1 - one))
        return total


class Top:
    """The nodes of depth 0 and 1, from the sums over all shards of the contexts of depth 2."""

    def __init__(self, rows: list):
        """rows: (node of depth 1, zeros, ones, sum of the children's log weighted probabilities)."""
        one = sorted((int(n), int(z), int(o), float(w)) for n, z, o, w in rows)
        nodes = np.array([x[0] for x in one], dtype=np.uint64)
        zeros, ones = (np.array([x[k] for x in one], dtype=np.int64) for k in (1, 2))
        own = log_kt(zeros, ones)
        weighted = np.logaddexp(own, np.array([x[3] for x in one], dtype=np.float64)) - LN2
        place = nodes & _U(255)
        n0 = np.zeros((3, 256))
        for k, v in enumerate((zeros, ones, weighted)):
            np.add.at(n0[k], place.astype(np.int64), v)
        own0 = log_kt(n0[0].astype(np.int64), n0[1].astype(np.int64))
        whole = np.logaddexp(own0, n0[2]) - LN2
        stop0 = np.exp(np.minimum(own0 - LN2 - whole, 0))
        self.m0, self.r0 = stop0 * (n0[1] + 0.5) / (n0[0] + n0[1] + 1), 1 - stop0
        p = place.astype(np.int64)
        stop = np.exp(np.minimum(own - LN2 - weighted, 0))
        self.nodes = nodes
        self.m1 = self.m0[p] + self.r0[p] * stop * (ones + 0.5) / (zeros + ones + 1.0)
        self.r1 = self.r0[p] * (1 - stop)

    def __call__(self, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Mixed chance and rest of nodes of depth 1; of depth 0 where that context was never seen."""
        place = (key & _U(255)).astype(np.int64)
        m, r = self.m0[place].copy(), self.r0[place].copy()
        if len(self.nodes):
            at = np.minimum(np.searchsorted(self.nodes, key), len(self.nodes) - 1)
            hit = self.nodes[at] == key
            m[hit], r[hit] = self.m1[at[hit]], self.r1[at[hit]]
        return m, r


def _distinct(texts, train: np.ndarray, of) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys of the texts and their counts in those to be learned from; of(texts): key and document of each symbol."""
    keys, counts, size = [], [], 0
    for part in chunks(texts):
        key, doc = of(texts[part])
        learn = train[part][doc]
        own = []
        for which in (True, False):
            u, n = np.unique(key[learn == which], return_counts=True)
            own.append((u, n if which else np.zeros(len(u), dtype=np.int64)))
        keys += [o[0] for o in own]
        counts += [o[1] for o in own]
        size += sum(len(o[0]) for o in own)
        if size > 4_000_000:
            k, c = summed(np.concatenate(keys), np.concatenate(counts))
            keys, counts, size = [k], [c], 0
    return summed(np.concatenate(keys), np.concatenate(counts)) if keys else (np.zeros(0, np.uint64), np.zeros(0, np.int64))


def _gram_keys(texts):
    return grams(*symbols(texts))


def _word_keys(texts):
    w = words(texts)
    return w.hashes(), w.doc


_KINDS = {"g": (_gram_keys, gram_shard), "w": (_word_keys, word_shard)}


def _sorted(df: DataFrame, *order: str) -> DataFrame:
    """The rows of a (kind, shard) in one task, one group after the other."""
    return df.repartition("kind", "shard").sortWithinPartitions("kind", "shard", *order)


def scored(docs: DataFrame, learn, text: str = "text", key: str = "doc_id", shards: int = SHARDS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Scores of all rows of `docs`, the model learned from those where `learn` holds.

    Columns: doc_id, learned, n_tokens, n_known, train_tokens, base_score, score (log10), n_bytes, bits_per_byte.
    """
    bounded(docs.sparkSession)
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"), F.coalesce(learn, F.lit(False)).alias("learn"))
    total = rows.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    growth = max(1.0, total / EVEN_BYTES) ** 0.5
    blocks, shards = max(MIN_BLOCKS, int(-(-total // (block_bytes * growth)))), int(shards * growth)
    # a text's own hash spreads a hot id
    rows = rows.withColumns({"row": F.monotonically_increasing_id(), "hash": F.xxhash64("doc_id", "text")})
    # repeats that would overfill a block are dealt to several: at most as many as there are blocks' worth of text
    of, salt = F.count("*") * F.max(F.octet_length("text") + 64), F.lit(0)
    many = written(rows.groupBy("hash").agg(F.count("*").alias("of"), F.ceil(of / block_bytes).cast("int").alias("salts")).where("of > 1 AND salts > 1").select("hash", "salts"), "repeats")
    if not many.isEmpty():
        rows = rows.join(many, "hash", "left")
        salt = F.coalesce(F.pmod("row", F.col("salts")), F.lit(0))
    rows = rows.select("doc_id", "text", "learn", F.pmod(F.xxhash64("hash", salt), F.lit(blocks)).cast("int").alias("block"))

    def ask(block: pd.DataFrame) -> pd.DataFrame:
        texts, train, out = block["text"].tolist(), block["learn"].to_numpy(bool), []
        for name, (of, shard) in _KINDS.items():
            keys, counts = _distinct(texts, train, of)
            where = shard(keys, shards)
            order = np.argsort(where, kind="stable")
            cut = np.searchsorted(where[order], np.arange(shards + 1))
            for s in range(shards):
                at = order[cut[s] : cut[s + 1]]
                if len(at):
                    out.append((name, s, int(block["block"].iloc[0]), pack(keys[at], counts[at].astype(np.uint32))))
        tidy()
        return pd.DataFrame(out, columns=["kind", "shard", "block", "data"])

    asked = written(rows.groupBy("block").applyInPandas(ask, "kind string, shard int, block int, data binary"), "asked")

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, kept = None, []

        def total_of() -> pd.DataFrame:
            keys, counts = summed(np.concatenate([x[0] for x in kept]), np.concatenate([x[1] for x in kept]))
            return pd.DataFrame({"kind": [now[0]], "shard": [now[1]], "data": [pack(keys, counts)]})

        for b in batches:
            for name, s, d in zip(b["kind"], b["shard"], b["data"]):
                if (name, s) != now:
                    if now:
                        yield total_of()
                    now, kept = (name, s), [(np.zeros(0, np.uint64), np.zeros(0, np.int64))]
                k, c = unpack(d, np.uint64, np.uint32)
                some = c > 0
                kept.append((k[some], c[some].astype(np.int64)))
                if sum(len(x[0]) for x in kept[1:]) > max(2_000_000, len(kept[0][0])):
                    kept = [summed(np.concatenate([x[0] for x in kept]), np.concatenate([x[1] for x in kept]))]
        if now:
            yield total_of()
        tidy()

    model = written(_sorted(asked).mapInPandas(add, "kind string, shard int, data binary"), "model")

    def roots(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for name, d in zip(b["kind"], b["data"]):
                keys, n = unpack(d, np.uint64, np.int64)
                if name == "w":
                    yield pd.DataFrame({"kind": ["w"], "node": [0], "zeros": [int(n.sum())], "ones": [len(keys)], "weighted": [0.0]})
                elif len(keys):
                    node, zeros, ones, weighted = Tree(keys, n, 2).roots()
                    parent = ((node >> _U(16)) << _U(8)) | (node & _U(255))
                    own, first = np.unique(parent, return_inverse=True)
                    add_up = lambda v: np.bincount(first, weights=v, minlength=len(own))  # noqa: E731, B023
                    yield pd.DataFrame({"kind": "g", "node": own.astype(np.int64), "zeros": add_up(zeros).astype(np.int64), "ones": add_up(ones).astype(np.int64), "weighted": add_up(weighted)})

    found = model.mapInPandas(roots, "kind string, node long, zeros long, ones long, weighted double")
    found = found.groupBy("kind", "node").agg(F.sum("zeros"), F.sum("ones"), F.sum("weighted")).collect()
    top = Top([r[1:] for r in found if r["kind"] == "g"])
    n_train, n_distinct = next(((r[2], r[3]) for r in found if r["kind"] == "w"), (0, 0))
    sums = rows.where("learn").agg(F.count("*").alias("n")).first()["n"]
    train_tokens, distinct = n_train + sums, n_distinct + (sums > 0)

    def answer(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        keys = n = value = tree = None
        for b in batches:
            out = []
            for name, block, d in zip(b["kind"], b["block"], b["data"]):
                if block < 0:  # the shard's part of the model comes before its requests
                    keys, n = unpack(d, np.uint64, np.int64)
                    if name == "g":
                        tree = Tree(keys, n, 2) if len(keys) else None
                        if tree:
                            tree.mixed(top)
                        value = tree.chance(keys, top) if tree else np.zeros(0)
                    continue
                want, _ = unpack(d, np.uint64, np.uint32)
                at = np.minimum(np.searchsorted(keys, want), max(len(keys) - 1, 0))
                hit = keys[at] == want if len(keys) else np.zeros(len(want), bool)
                if name == "w":
                    got = np.zeros(len(want))
                    got[hit] = n[at[hit]]
                else:
                    got = np.empty(len(want))
                    got[hit] = value[at[hit]]
                    if not hit.all():
                        got[~hit] = (tree or _empty()).chance(want[~hit], top)
                out.append((name, block, pack(want, got)))
            yield pd.DataFrame(out, columns=["kind", "block", "data"])
        tidy()

    known = model.select("kind", "shard", F.lit(-1).alias("block"), "data")
    answers = _sorted(asked.unionByName(known), "block").mapInPandas(answer, "kind string, block int, data binary")

    def score(key: tuple, block: pd.DataFrame, given: pd.DataFrame) -> pd.DataFrame:
        texts, tables = block["text"].tolist(), {}
        for name in _KINDS:
            parts = [unpack(d, np.uint64, np.float64) for d in given["data"][given["kind"] == name]]
            keys = np.concatenate([p[0] for p in parts]) if parts else np.zeros(0, np.uint64)
            order = np.argsort(keys)
            tables[name] = keys[order], np.concatenate([p[1] for p in parts])[order] if parts else np.zeros(0)
        log_all = np.log10(train_tokens + distinct + 1.0)
        n_tokens, n_known, base, total, size = (np.zeros(len(texts)) for _ in range(5))
        for part in chunks(texts):
            n = len(texts[part])
            code, doc = _gram_keys(texts[part])
            total[part] = np.bincount(doc, weights=_at(tables["g"], code), minlength=n)
            size[part] = np.bincount(doc, minlength=n)
            h, doc = _word_keys(texts[part])
            c = _at(tables["w"], h)
            n_tokens[part] = np.bincount(doc, minlength=n) + 1
            n_known[part] = np.bincount(doc, weights=c > 0, minlength=n) + (sums > 0)
            base[part] = np.bincount(doc, weights=np.log10(c + 1) - log_all, minlength=n) + np.log10(sums + 1) - log_all
        out = {"doc_id": block["doc_id"], "learned": block["learn"], "n_tokens": n_tokens.astype(np.int64), "n_known": n_known.astype(np.int64), "train_tokens": train_tokens, "base_score": base, "score": total, "n_bytes": size.astype(np.int64), "bits_per_byte": -total * LN10 / LN2 / np.maximum(size, 1)}
        tidy()
        return pd.DataFrame(out)

    schema = f"doc_id {kind}, learned boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, n_bytes long, bits_per_byte double"
    return rows.groupBy("block").cogroup(answers.groupBy("block")).applyInPandas(score, schema)


def _at(table_: tuple[np.ndarray, np.ndarray], keys: np.ndarray) -> np.ndarray:
    """Values of keys that are all in the table; a hash table of places first, binary search for those that collide in it."""
    own, value = table_
    if not len(keys):
        return np.zeros(0)
    bits = _U(64 - max(10, int(len(own)).bit_length() + 1))
    factor = _U(0x9E3779B97F4A7C15)
    slots = np.zeros(1 << (64 - int(bits)), dtype=np.int32)
    slots[(own * factor) >> bits] = np.arange(len(own), dtype=np.int32)
    at = slots[(keys * factor) >> bits]
    wrong = np.flatnonzero(own[at] != keys)
    at[wrong] = np.minimum(np.searchsorted(own, keys[wrong]), len(own) - 1)
    if (own[at[wrong]] != keys[wrong]).any():
        raise RuntimeError("a block has texts for which it didn't ask: the table has changed between its two scans")
    return value[at]


def _empty() -> Tree:
    tree = Tree.__new__(Tree)
    tree.top, tree.codes = 2, np.zeros(0, np.uint64)
    tree.mix = {d: (np.zeros(0, np.uint64), np.zeros(0), np.zeros(0)) for d in range(2, DEPTH + 1)}
    return tree


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scored(table(spark, sf_dir, "documents"), fold("doc_id", 7) != 2)
    return out.select("doc_id", (fold("doc_id", 7) == 2).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score", "n_bytes", "bits_per_byte")
