"""Phrase mining: how much more often words stand together than their parts would, per language.

1. Texts are cut at punctuation and line ends into pieces, equal pieces of a language are folded into one with a
   multiplicity (`pieces`), and these are packed into blocks of BLOCK_BYTES that stay as they are (`blocks`).
2. Each block sends the hashes of its words and pairs, with weighted counts that stop at the threshold, to hash buckets;
   duckdb counts a bucket and answers each block with those of its hashes that reach the threshold (`_frequent`). A hash
   that two pairs share only lets more through.
3. Blocks count the phrases all of whose pairs were let through, as text, and send them to the bucket of their hash, where
   duckdb adds the exact counts (`counts`). No phrase is missed: each pair in it is at least as frequent.
4. Candidates ask for the counts of their parts: a row for each part goes where its count is, and back (`scored`).

Nothing is broadcast. A block sends a hash or phrase once, whatever its count, so no bucket is hot. duckdb works out of
core: beyond DUCK_MB it spills to a temporary folder of its task, which no one else reads and which goes with the task.
The buckets' number grows with the words. Scores are exact: decimals of 38 digits hold the products.

Defined results: null or empty texts have no pieces; a null language is `und`, together with rows that say so. Repeated
rows count each time. Ties go to the smaller k, and in the report to the larger count, then to the phrase that is first by
bytes. Phrases don't cross punctuation or lines. No rows give no rows. Other columns, whatever their names, aren't looked at.
Within a block, 64-bit hashes tell phrases apart.
"""

from __future__ import annotations

import hashlib
import math
import re
import shutil
import tempfile
from collections import Counter
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from screenweave.llm.common import chunks, table, tidy, written
from screenweave.llm.textarrays import Words, mix64, windows

MIN_COUNT = 30
MAX_WORDS = 4
TOP = 2000
#: A candidate goes if a longer one that holds it has at least this share, in hundredths, of its count.
SHARE = 80
SCALE = 2_000_000
#: Bytes of a block's text.
BLOCK_BYTES = 4 << 20
#: Words, after folding, that fall to one bucket.
BUCKET_WORDS = 2_000_000
#: Memory of one bucket's duckdb, beyond which it spills.
DUCK_MB = 256
_CUT = re.compile(rb"[.,;:!?\n-\r]+")
_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def pieces(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """(lang, piece, m): the different pieces, their words joined by one space, and how often each occurs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            langs, texts = b.column(0).to_pylist(), b.column(1).to_pylist()
            for part in chunks(texts):
                found: Counter = Counter()
                for name, t in zip(langs[part], texts[part]):
                    found.update((name, w) for p in _CUT.split((t or "").encode().translate(_LOWER)) if (w := b" ".join(p.split())))
                names, bodies = zip(*found) if found else ((), ())
                yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(bodies, pa.binary()).cast(pa.string()), pa.array(found.values(), pa.int64())], names=["lang", "piece", "m"])
        tidy()

    rows = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, "lang string, piece string, m long").groupBy("lang", "piece").agg(F.sum("m").alias("m"))


def blocks(found: DataFrame) -> DataFrame:
    """(block, lang, n_words, n_occurrences, text, weights): pieces of a language, joined by line ends, with their multiplicities."""
    schema = pa.schema([("block", pa.int64()), ("lang", pa.string()), ("n_words", pa.int64()), ("n_occurrences", pa.int64()), ("text", pa.binary()), ("weights", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, made = TaskContext.get().partitionId() << 32, 0
        held: dict[str, tuple[list, list, list]] = {}
        size = 0

        def packed(lang: str) -> pa.RecordBatch:
            nonlocal made, size
            texts, weights, _ = held.pop(lang)
            text, m = b"\n".join(texts), np.array(weights, dtype="<i8")
            size -= sum(map(len, texts))
            words = np.array([1 + t.count(b" ") for t in texts])
            made += 1
            return pa.RecordBatch.from_pylist([{"block": first | made, "lang": lang, "n_words": int(words.sum()), "n_occurrences": int((words * m).sum()), "text": text, "weights": m.tobytes()}], schema)

        for b in batches:
            for lang, piece, m in zip(b.column(0).to_pylist(), b.column(1).cast(pa.binary()).to_pylist(), b.column(2).to_pylist()):
                texts, weights, n = held.setdefault(lang, ([], [], [0]))
                texts.append(piece)
                weights.append(m)
                n[0] += len(piece)
                size += len(piece)
                if n[0] >= BLOCK_BYTES:
                    yield packed(lang)
                elif size >= 4 * BLOCK_BYTES:
                    yield packed(max(held, key=lambda x: held[x][2][0]))
        for lang in list(held):
            yield packed(lang)
        tidy()

    return found.mapInArrow(run, "block long, lang string, n_words long, n_occurrences long, text binary, weights binary")


class Block:
    """A block's words as spans of its text, their hashes, and how often each word's piece occurs."""

    def __init__(self, lang: str, text: bytes, weights: bytes):
        self.text, data = text, np.frombuffer(text, dtype=np.uint8)
        ends = np.flatnonzero((data == 32) | (data == 10))
        self.start, self.end = np.concatenate([[0], ends + 1]), np.concatenate([ends, [len(data)]])
        self.piece = np.concatenate([[0], np.cumsum(data[ends] == 10)])
        self.weight = np.frombuffer(weights, dtype="<i8")[self.piece]
        seed = np.frombuffer(hashlib.blake2b(lang.encode(), digest_size=8).digest(), dtype="<u8")
        step = 50_000
        hashes = [Words(data, self.start[i : i + step], self.end[i : i + step], self.piece[i : i + step], 0).hashes() for i in range(0, len(self.start), step)]
        self.hash = mix64(np.concatenate(hashes) ^ seed)

    def grams(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """The first words of all n-word phrases, and the phrases' hashes."""
        at = np.arange(max(0, len(self.start) - n + 1))
        at = at[self.piece[at] == self.piece[at + n - 1]]
        return at, windows(self.hash, n)[at]


def _keys(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """The bucket in the upper half, 32 bits of the hash in the lower."""
    return (hashes % np.uint64(buckets)) << np.uint64(32) | hashes >> np.uint64(32)


def _summed(keys: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The different keys, sorted, a place of each, and the sum of its weights."""
    if not len(keys):
        return keys, np.zeros(0, np.int64), np.zeros(0, np.int64)
    order = np.argsort(keys)
    keys = keys[order]
    new = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[new], order[new], np.add.reduceat(weights[order], new)


def _by_bucket(keys: np.ndarray) -> list[tuple[int, int, int]]:
    """(bucket, begin, end) of sorted keys."""
    bucket = (keys >> np.uint64(32)).astype(np.int64)
    edge = np.flatnonzero(np.diff(bucket)) + 1
    begin = np.concatenate([[0], edge]) if len(keys) else edge
    return list(zip(bucket[begin].tolist(), begin.tolist(), [*edge.tolist(), len(keys)]))


@contextmanager
def _duck():
    """A duckdb for one task: one thread, bounded memory, a spill folder that goes with it."""
    import duckdb

    folder = tempfile.mkdtemp(prefix="phrases-")
    db = duckdb.connect(":memory:", config={"threads": 1, "memory_limit": f"{DUCK_MB}MB", "temp_directory": folder, "preserve_insertion_order": False})
    try:
        yield db
    finally:
        db.close()
        shutil.rmtree(folder, ignore_errors=True)
        tidy()


def _inserted(db, tables: Iterator[pa.Table], rows: int = 500_000) -> None:
    """Adds the tables to duckdb's table t, some together."""
    held, size = [], 0

    def put() -> None:
        if held:
            arrived = pa.concat_tables(held)  # noqa: F841  duckdb finds it by its name
            db.execute("INSERT INTO t SELECT * FROM arrived")

    for x in tables:
        held.append(x)
        size += len(x)
        if size >= rows:
            put()
            held, size = [], 0
    put()


def _frequent(packed: DataFrame, buckets: int, least: int) -> DataFrame:
    """(block, keys): for each block, the keys of its words and pairs that reach the threshold among all blocks."""
    kind = np.min_scalar_type(least)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in b.to_pylist():
                block = Block(row["lang"], row["text"], row["weights"])
                grams = [block.grams(n) for n in (1, 2)]
                keys, _, count = _summed(_keys(np.concatenate([h for _, h in grams]), buckets), np.concatenate([block.weight[at] for at, _ in grams]))
                count, low = np.minimum(count, least).astype(kind), keys.astype("<u4")
                parts = _by_bucket(keys)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([p[0] for p in parts], pa.int32()), pa.array([row["block"]] * len(parts), pa.int64()), pa.array([low[i:j].tobytes() for _, i, j in parts], pa.binary()), pa.array([count[i:j].tobytes() for _, i, j in parts], pa.binary())],
                    names=["bucket", "block", "keys", "counts"],
                )
        tidy()

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def tables() -> Iterator[pa.Table]:
            for b in batches:
                for bucket, block, keys, counts in zip(*(c.to_pylist() for c in b.columns)):
                    k = np.frombuffer(keys, dtype="<u4").astype(np.uint64) | np.uint64(bucket << 32)
                    yield pa.table({"block": np.full(len(k), block), "k": k, "c": np.frombuffer(counts, dtype=kind).astype(np.int32)})

        with _duck() as db:
            db.execute("CREATE TABLE t (block BIGINT, k UBIGINT, c INTEGER)")
            _inserted(db, tables())
            db.execute(f"CREATE TABLE often AS SELECT k FROM t GROUP BY k HAVING sum(c) >= {int(least)}")
            for x in db.sql("SELECT block, k FROM t SEMI JOIN often USING (k) ORDER BY block, k").to_arrow_reader(100_000):
                block, keys = x.column(0).to_numpy(), x.column(1).to_numpy()
                edge = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), len(block)]
                spans = list(zip(edge[:-1], edge[1:])) if len(block) else []
                yield pa.RecordBatch.from_arrays([pa.array([int(block[i]) for i, _ in spans], pa.int64()), pa.array([keys[i:j].astype("<u8").tobytes() for i, j in spans], pa.binary())], names=["block", "keys"])

    asked = packed.select("block", "lang", "text", "weights").mapInArrow(ask, "bucket int, block long, keys binary, counts binary")
    return asked.repartition(buckets, "bucket").mapInArrow(answer, "block long, keys binary")


def counts(packed: DataFrame, least: int = MIN_COUNT, most_words: int = MAX_WORDS) -> DataFrame:
    """(lang, phrase, n, f): all phrases of 1 to `most_words` words that occur at least `least` times in a language."""
    total = packed.agg(F.sum("n_words")).first()[0] or 0
    buckets = max(1, math.ceil(total / BUCKET_WORDS))
    allowed = _frequent(packed, buckets, least).groupBy("block").agg(F.collect_list("keys").alias("allowed"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in b.to_pylist():
                block, keys = Block(row["lang"], row["text"], row["weights"]), np.sort(np.frombuffer(b"".join(row["allowed"]), dtype="<u8"))
                good = np.zeros(len(block.start), dtype=bool)
                for n in range(1, most_words + 1):
                    at, hashes = block.grams(n)
                    if n <= 2:
                        wanted = _keys(hashes, buckets)
                        place = np.minimum(np.searchsorted(keys, wanted), max(len(keys) - 1, 0))
                        good[:] = False
                        good[at] = keys[place] == wanted if len(keys) else False
                        pick, pair = good[at], good
                    else:
                        pick = np.logical_and.reduce([pair[at + k] for k in range(n - 1)])
                    at, hashes = at[pick], hashes[pick]
                    hashes, first, f = _summed(hashes, block.weight[at])
                    at = at[first]
                    order = np.argsort(key := _keys(hashes, buckets))
                    at, f = at[order], f[order].astype("<i8")
                    parts = _by_bucket(key[order])
                    text = [block.text[i:j] for i, j in zip(block.start[at].tolist(), block.end[at + n - 1].tolist())]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([p[0] for p in parts], pa.int32()), pa.array([row["lang"]] * len(parts), pa.string()), pa.array([n] * len(parts), pa.int32()), pa.array([b"\n".join(text[i:j]) for _, i, j in parts], pa.binary()), pa.array([f[i:j].tobytes() for _, i, j in parts], pa.binary())],
                        names=["bucket", "lang", "n", "phrases", "counts"],
                    )
        tidy()

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def tables() -> Iterator[pa.Table]:
            for b in batches:
                for _, lang, n, phrases, c in zip(*(x.to_pylist() for x in b.columns)):
                    text, f = phrases.split(b"\n"), np.frombuffer(c, dtype="<i8")
                    yield pa.table({"lang": pa.array([lang] * len(text), pa.string()), "phrase": pa.array(text, pa.binary()).cast(pa.string()), "n": pa.array(np.full(len(text), n, np.int32)), "f": f})

        with _duck() as db:
            db.execute("CREATE TABLE t (lang VARCHAR, phrase VARCHAR, n INTEGER, f BIGINT)")
            _inserted(db, tables())
            yield from db.sql(f"SELECT lang, phrase, n, sum(f)::BIGINT AS f FROM t GROUP BY ALL HAVING sum(f) >= {int(least)}").to_arrow_reader(50_000)

    joined = packed.select("block", "lang", "text", "weights").join(allowed, "block").select("lang", "text", "weights", "allowed")
    sent = joined.mapInArrow(count, "bucket int, lang string, n int, phrases binary, counts binary")
    return sent.repartition(buckets, "bucket").mapInArrow(add, "lang string, phrase string, n int, f long")


def scored(found: DataFrame, share: int = SHARE) -> DataFrame:
    """(lang, phrase, a, l, r, score): the candidates, each at its lowest-scoring cut, without those that a longer one explains."""
    candidates = found.where("n >= 2").select("lang", "phrase", "n", F.col("f").alias("a"), F.split("phrase", " ").alias("w"))
    cuts = F.transform(F.sequence(F.lit(1), F.col("n") - 1), lambda k: F.struct(k.alias("k"), F.array(F.array_join(F.slice("w", F.lit(1), k), " "), F.array_join(F.slice("w", k + 1, F.col("n") - k), " ")).alias("parts")))
    asked = candidates.select("lang", "phrase", "a", F.explode(cuts).alias("cut")).select("lang", "phrase", "a", "cut.k", F.posexplode("cut.parts").alias("side", "part"))
    parts = found.select("lang", F.col("phrase").alias("part"), "f")
    told = asked.join(parts, ["lang", "part"])
    by_cut = told.groupBy("lang", "phrase", "a", "k").agg(F.max(F.when(F.col("side") == 0, F.col("f"))).alias("l"), F.max(F.when(F.col("side") == 1, F.col("f"))).alias("r"))
    score = F.expr(f"(cast({SCALE} as decimal(10,0)) * cast(a as decimal(20,0))) div (cast(l as decimal(20,0)) + cast(r as decimal(20,0)))")
    best = by_cut.withColumn("score", score).groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("best"))
    spans = F.flatten(F.transform(F.sequence(F.lit(2), F.col("n") - 1), lambda n: F.transform(F.sequence(F.lit(1), F.col("n") - n + 1), lambda i: F.array_join(F.slice("w", i, n), " "))))
    inner = candidates.where("n > 2").select("lang", F.explode(spans).alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    kept = best.join(inner, ["lang", "phrase"], "left").where(F.col("longer").isNull() | (F.lit(100).cast("decimal(20,0)") * F.col("longer").cast("decimal(20,0)") < F.lit(share).cast("decimal(20,0)") * F.col("a").cast("decimal(20,0)")))
    return kept.select("lang", "phrase", "a", "best.l", "best.r", "best.score")


def mined(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = MIN_COUNT, most_words: int = MAX_WORDS, top: int = TOP, share: int = SHARE) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's first `top` phrases; n counts all its words."""
    packed = written(blocks(pieces(docs, text, lang)), "phrase_blocks")
    found = written(counts(packed, least, most_words), "phrase_counts")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    ranked = scored(found, share).withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)
    totals = packed.groupBy("lang").agg(F.sum("n_occurrences").alias("n"))
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mined(table(spark, sf_dir, "documents"))


ORACLE = f"""
WITH t AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
p AS (SELECT lang, unnest(string_split_regex(t, '[.,;:!?\\x0A-\\x0D]')) AS p FROM t),
w AS (SELECT lang, count(*) AS m, list_filter(string_split_regex(p, '[\\x20\\x09]+'), lambda x: x <> '') AS w FROM p GROUP BY lang, p),
g AS (SELECT lang, k, m, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase FROM w, (VALUES (1), (2), (3), ({MAX_WORDS})) AS v(k) WHERE len(w) >= k),
f AS (SELECT lang, k, phrase, sum(m)::BIGINT AS f FROM g GROUP BY ALL HAVING sum(m) >= {MIN_COUNT}),
n AS (SELECT lang, sum(m * len(w))::BIGINT AS n FROM w GROUP BY lang),
c AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k >= 2),
cut AS (SELECT c.*, j, array_to_string(w[1:j], ' ') AS first, array_to_string(w[j + 1:], ' ') AS rest FROM c, (VALUES (1), (2), (3)) AS v(j) WHERE j < k),
s AS (SELECT cut.lang, cut.phrase, a, j, x.f AS l, y.f AS r, (({SCALE}::HUGEINT * a) // (x.f + y.f))::BIGINT AS score
  FROM cut JOIN f AS x ON x.lang = cut.lang AND x.phrase = first JOIN f AS y ON y.lang = cut.lang AND y.phrase = rest),
b AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) AS o FROM s),
i AS (SELECT lang, unnest(flatten([[array_to_string(w[x:x + y - 1], ' ') for x in range(1, k - y + 2)] for y in range(2, k)])) AS phrase, a FROM c WHERE k > 2),
d AS (SELECT lang, phrase, max(a) AS longer FROM i GROUP BY ALL),
z AS (SELECT b.lang, b.phrase, a, l, r, score, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, b.phrase) AS rank
  FROM b LEFT JOIN d ON d.lang = b.lang AND d.phrase = b.phrase WHERE o = 1 AND (longer IS NULL OR 100 * longer < {SHARE} * a))
SELECT z.lang, rank, phrase, a, l, r, n, score FROM z JOIN n ON n.lang = z.lang WHERE rank <= {TOP}"""
