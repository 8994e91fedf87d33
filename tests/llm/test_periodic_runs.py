"""Periodic runs against brute force and awkward rows."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from screenweave.llm import periodic_runs
from screenweave.llm.periodic_runs import planted

SCHEMA = "doc_id long, text string, runs string, start int, key string"


def brute(w, min_length, exponent):
    n, out = len(w), []
    for q in range(1, n // exponent + 1):
        i = 0
        while i < n - q:
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j < n - q and w[j] == w[j + q]:
                j += 1
            length = j - i + q
            if length >= max(min_length, exponent * q) and not any(w[i : i + length - d] == w[i + d : i + length] for d in range(1, q)):
                out.append((i, length, q))
            i = j
    return sorted(out, key=lambda x: (x[0], x[2]))


def drawn(seed):
    r = random.Random(seed)
    kind = seed % 6
    n = r.randint(0, 60)
    if kind == 0:
        return [r.choice("ab") for _ in range(n)]
    if kind == 1:
        return [r.choice("abc") for _ in range(n)]
    if kind == 2:  # Fibonacci and Thue-Morse words
        a, b = ["a"], ["a", "b"]
        while len(b) < n:
            a, b = b, b + a
        return b[:n] if seed % 4 else [str(bin(i).count("1") % 2) for i in range(n)]
    if kind == 3:
        return ["a"] * n
    if kind == 4:
        unit = [r.choice("abcdefgh") for _ in range(r.randint(1, 9))]
        return [str(k) for k in range(5)] + unit * r.randint(1, 8) + unit[:1] + [r.choice("xyz") for _ in range(n)]
    return [w for _ in range(6) for w in [r.choice("abcd") for _ in range(r.randint(1, 4))] * r.randint(1, 6)]


def listed(found):
    return [tuple(map(int, x)) for x in found]


@pytest.mark.parametrize("least,exponent", [(2, 2), (6, 4), (1, 3), (9, 2)])
def test_runs_of_many_texts_at_once(least, exponent):
    texts = [drawn(s) for s in range(240)]
    got = periodic_runs.runs([[w.encode() for w in t] for t in texts], least, exponent)
    for t, found in zip(texts, got):
        assert listed(found) == brute(t, least, exponent), t
    assert sum(map(len, got)) > 100


def test_located_without_stretches():
    for s in range(120):
        w = drawn(s)
        if len(w) > 1:
            code = {x: i for i, x in enumerate(dict.fromkeys(w))}
            found = periodic_runs.located(np.array([code[x] for x in w] + [len(code)]))
            assert listed(found) == brute(w, 2, 2), w


def test_blocks_are_lempel_ziv():
    for s in range(60):
        w = "".join(drawn(s))
        f = periodic_runs.Factors(np.array([*map(ord, w), 10**6]))
        h = 0
        for begin in periodic_runs._blocks(f):
            assert begin == h
            size = 1
            while h + size < len(w) and w.find(w[h : h + size + 1]) < h:
                size += 1
            h += size
        assert h == len(w) + 1


def test_stretches_hold_all_runs():
    for exponent in (2, 4):
        texts = [drawn(s) for s in range(80)]
        ids = np.array([ord(w[0]) for t in texts for w in t])
        doc = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
        where = periodic_runs.stretches(ids, doc, 6, exponent)
        assert all(a[1] <= b[0] for a, b in zip(where[:-1], where[1:]))
        first = np.cumsum([0, *map(len, texts)])
        for t, at in zip(texts, first):
            for start, length, _ in brute([w[0] for w in t], 6, exponent):
                assert any(b <= at + start and at + start + length <= e for b, e in where)
    prose = np.array(list(range(50)) * 1 + [3, 9, 3, 9] + list(range(50, 90)))
    assert periodic_runs.stretches(prose, np.zeros(len(prose), int), 6, 4) == []


def test_long_texts():
    r = random.Random(1)
    noise = [str(r.randint(0, 400)) for _ in range(40_000)]
    unit = [str(r.randint(0, 30)) for _ in range(3000)]
    words = [w.encode() for w in noise[:20_000] + unit * 4 + unit[:7] + noise[20_000:] + ["z"] * 30_000]
    assert listed(periodic_runs.runs([words])[0])[-2:] == [(20_000, 12_007, 3000), (52_007, 30_000, 1)]


def expected(name, text):
    w = [x.decode() for x in planted(name, (text or "").encode().split())]
    rows = brute(w, 6, 4)
    gone = {i for s, length, q in rows for i in range(s + q, s + length)}
    best = max(rows, key=lambda x: (x[1] / x[2], -x[0], -x[2]), default=None)
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in rows)
    kept = " ".join(x for i, x in enumerate(w) if i not in gone)
    return (len(rows), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())


def test_frames(spark):
    texts = [None, "", " \t\n", "a", "a " * 50, "x y\nx y\tx y\x0bx y\x0cx y", "É É É É É É é", "a\xa0b " * 8, "a\x1cb " * 8, *(" ".join(drawn(s)) for s in range(40)), "a " * 50]
    rows = [(k, t, "clash", 1, "x") for k, t in enumerate(texts)] + [(None, "b b b b b b b", None, None, None), (4, "a " * 50, None, None, None)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = periodic_runs.found(docs)
    assert got.columns == ["doc_id", "n_words", "runs", "collapsed"]
    want = []
    for r in rows:
        w = [x.decode() for x in (r[1] or "").encode().split()]
        spans = brute(w, 6, 4)
        gone = {i for s, length, q in spans for i in range(s + q, s + length)}
        want.append((str(r[0]), len(w), spans, " ".join(x for i, x in enumerate(w) if i not in gone)))
    assert sorted((str(r.doc_id), r.n_words, [(x.start, x.length, x.period) for x in r.runs], r.collapsed) for r in got.collect()) == sorted(want)
    assert not periodic_runs.found(docs.limit(0)).collect()


def test_planted():
    for k in range(300):
        w = [b"w%d" % i for i in range(k % 40)]
        h, n = zlib.crc32(str(k).encode()), len(w)
        g = h // 10
        want = list(w)
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            want = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        assert planted(str(k), w) == want


def test_query(spark):
    d = "/root/testdata/sf0.001"
    got = {r.doc_id: tuple(r)[1:] for r in periodic_runs.query(spark, d).collect()}
    docs = spark.read.parquet(f"{d}/documents.parquet").collect()
    assert len(got) == len(docs)
    for r in docs:
        if len(r.text or "") < 12_000:
            assert got[r.doc_id] == expected(str(r.doc_id), r.text)
    assert sum(x[0] > 0 for x in got.values()) > 5
