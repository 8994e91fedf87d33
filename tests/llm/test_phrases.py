"""Phrase mining against brute force, the SQL and awkward rows."""

import os
import random
import re
from collections import Counter, defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from screenweave.llm import phrases

SCHEMA = "doc_id long, text string, lang string, phrase string, n int, block long"


def brute(rows, least, most_words, top, share):
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = "".join(c.lower() if c.isascii() else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", low):
            w = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, most_words + 1):
                f[lang].update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, c in f.items():
        often = {p: a for p, a in c.items() if len(p) > 1 and a >= least}
        rows = []
        for p, a in often.items():
            if any(100 * b >= share * a for q, b in often.items() if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q)))):
                continue
            score, k = min((phrases.SCALE * a // (c[p[:k]] + c[p[k:]]), k) for k in range(1, len(p)))
            rows.append((-score, -a, " ".join(p).encode(), c[p[:k]], c[p[k:]]))
        rows.sort()
        out += [(lang, i + 1, p.decode(), -a, left, right, n[lang], -s) for i, (s, a, p, left, right) in enumerate(rows[:top])]
    return sorted(out)


def texts(seed, n):
    r = random.Random(seed)
    vocabulary = ["a", "B", "cc", "dd", "é", "É", "the", "of", "x-y", "文字", "\x1c", "q\xa0q"]
    return ["".join(r.choice(vocabulary) + r.choice([" ", " ", "  ", "\t", ". ", ",", "\n", "\r\n", "\x0b"]) for _ in range(r.randint(0, 60))) for _ in range(n)]


def frame(spark, rows):
    return spark.createDataFrame([(k, t, lang, "clash", 7, 9) for k, (lang, t) in enumerate(rows)], SCHEMA)


@pytest.mark.parametrize("least,top,share,size", [(2, 10_000, 80, 1 << 20), (3, 7, 80, 200), (1, 10_000, 120, 64)])
def test_against_brute_force(spark, monkeypatch, least, top, share, size):
    monkeypatch.setattr(phrases, "BLOCK_BYTES", size)
    monkeypatch.setattr(phrases, "BUCKET_WORDS", 300)
    rows = [(["en", "de", None, "und"][i % 4], t) for i, t in enumerate(texts(least, 40))]
    rows += rows[:5] * 9 + [("en", None), ("en", ""), (None, " \t\n"), ("fr", "one"), ("en", "the of " * 3000)]
    got = phrases.mined(frame(spark, rows).repartition(5), least=least, top=top, share=share)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    want = brute(rows, least, 4, top, share)
    assert sorted(map(tuple, got.collect())) == want
    assert len(want) >= 20


def test_counts_of_all_phrases(spark):
    rows = [("en", "a b a b. A B"), ("en", "a b"), ("de", "a b")]
    packed = phrases.blocks(phrases.pieces(frame(spark, rows)))
    found = {(r.lang, r.phrase): (r.n, r.f) for r in phrases.counts(packed, 1).collect()}
    assert found[("en", "a b")] == (2, 4) and found[("en", "a")] == (1, 4) and found[("en", "a b a b")] == (4, 1) and found[("de", "a b")] == (2, 1)
    assert ("en", "b a b a") not in found
    assert {(r.piece, r.m) for r in phrases.pieces(frame(spark, rows)).where("lang = 'en'").collect()} == {("a b a b", 1), ("a b", 2)}


def test_scores_pass_64_bits(spark):
    big = 3 * 10**15
    found = spark.createDataFrame([("en", "a b", 2, big), ("en", "a", 1, big + 1), ("en", "b", 1, 2 * big + 12345)], "lang string, phrase string, n int, f long")
    row = phrases.scored(found).first()
    assert row.score == phrases.SCALE * big // (3 * big + 12346)
    found = spark.createDataFrame([("en", "a b c", 3, 80), ("en", "a b", 2, 100), ("en", "b c", 2, 101), ("en", "a", 1, 200), ("en", "b", 1, 200), ("en", "c", 1, 200)], "lang string, phrase string, n int, f long")
    assert {r.phrase for r in phrases.scored(found).collect()} == {"a b c", "b c"}  # 80 of 100 is enough, 80 of 101 isn't


def test_empty(spark):
    assert not phrases.mined(frame(spark, [("en", "x")]).limit(0)).collect()
    assert not phrases.mined(frame(spark, [("en", None), (None, " . ")])).collect()


def test_spill_folder_goes(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(phrases.tempfile, "tempdir", str(tmp_path))
    with phrases._duck() as db:
        assert db.execute("SELECT current_setting('temp_directory')").fetchone()[0].startswith(str(tmp_path))
        assert os.listdir(tmp_path)
    assert not os.listdir(tmp_path)


def test_query_against_sql(spark):
    d = "/root/testdata/sf0.01"
    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM '{d}/documents.parquet'")
    want = db.execute(phrases.ORACLE)
    names, want = [c[0] for c in want.description], want.fetchall()
    got = phrases.query(spark, d)
    assert sorted(map(tuple, got.select(*names).collect())) == sorted(want)
    assert got.select(F.max("rank")).first()[0] <= phrases.TOP and len(want) > 50
