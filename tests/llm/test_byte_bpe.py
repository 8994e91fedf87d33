"""Byte-level BPE against the reference encoder, round trips and awkward rows."""

import hashlib
import random

import pytest
import tiktoken

from screenweave.llm import byte_bpe

SCHEMA = "doc_id long, text string, ids int, key string, decoded string"


@pytest.fixture(scope="module")
def own():
    return byte_bpe.codec(byte_bpe.VOCABULARY)


def usual(ranks):
    return tiktoken.Encoding("own", pat_str=byte_bpe.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def encoder():
    return usual(byte_bpe.ranks_of(byte_bpe.VOCABULARY))


def mixed(seed, n):
    r = random.Random(seed)
    parts = ["the ", "don't", "  ", "\n\n", "naïve", " 文字", "🤖", "\x00", "\t", " 1234567", "!!!", "​", "\x85", "\x1c", "<|endoftext|>", "Ünï", "x" * 50, " we'll"]
    return "".join(r.choices(parts, k=n))


TEXTS = [None, "", " ", "\n", "  a  b  ", "it's they'll I'd", "<|endoftext|>", "é" * 300, " " * 5000, "a" * 3000, "\x1c \x85　x", *(mixed(s, 60) for s in range(40)), mixed(1, 60), mixed(99, 60_000)]


def test_ids_are_the_usual_encoders(own, encoder):
    for t in TEXTS:
        assert own.encode(t or "").tolist() == encoder.encode_ordinary(t or "")
    assert not own.unreached


def test_parts_end_with_pretokens(own, encoder):
    for t in TEXTS[-3:]:
        for limit in (1, 7, 100):
            parts = list(own.parts(t, limit))
            assert "".join(parts) == t
            assert [w for p in parts for w in own.pretoken.findall(p)] == own.pretoken.findall(t)


def test_round_trip(own):
    for t in TEXTS:
        assert own.decode(own.encode(t or "")) == (t or "").encode()


def test_tokens_that_merges_do_not_reach():
    ranks = {bytes([b]): b for b in range(256)} | {b"abc": 300, b"xy": 301, b"xyz": 400}
    ours, theirs = byte_bpe.Codec(ranks), usual(ranks)
    assert set(ours.unreached) == {b"abc"}
    for t in ("abc", "abcd", "xyz", "xyzz", " abc", "abc abc"):
        assert ours.encode(t).tolist() == theirs.encode_ordinary(t)
    with pytest.raises(ValueError):
        ours.decode(ours.encode("a") + 280)
    with pytest.raises(ValueError):
        byte_bpe.Codec({b"a": 0})


def test_cache_is_emptied(own, encoder, monkeypatch):
    monkeypatch.setattr(byte_bpe, "MEMO", 3)
    for t in TEXTS[-6:]:
        assert own.encode(t).tolist() == encoder.encode_ordinary(t)


def test_frames(spark, encoder):
    rows = [(k, t, 5, "key", "x") for k, t in enumerate(TEXTS)] + [(None, "null id", 1, None, None), (3, "\n", 5, "key", "x")]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    ids = byte_bpe.encoded(docs)
    assert ids.columns == ["doc_id", "ids"]
    want = sorted((str(r[0]), encoder.encode_ordinary(r[1] or "")) for r in rows)
    assert sorted((str(r.doc_id), list(r.ids)) for r in ids.collect()) == want
    back = byte_bpe.decoded(ids, keep=("doc_id",)).collect()
    assert sorted((str(r.doc_id), bytes(r.decoded)) for r in back) == sorted((str(r[0]), (r[1] or "").encode()) for r in rows)
    assert not byte_bpe.encoded(docs.limit(0)).collect()
    nothing = spark.createDataFrame([(1, None), (2, [])], "doc_id long, ids array<int>")
    assert {r.doc_id: r.decoded and bytes(r.decoded) for r in byte_bpe.decoded(nothing, keep=("doc_id",)).collect()} == {1: None, 2: b""}


def test_query(spark, encoder):
    d = "/root/testdata/sf0.001"
    got = {r.doc_id: r for r in byte_bpe.query(spark, d).collect()}
    docs = spark.read.parquet(f"{d}/documents.parquet").collect()
    assert len(got) == len(docs)
    for r in docs:
        ids = encoder.encode_ordinary(r.text or "")
        row = got[r.doc_id]
        assert (row.n_tokens, row.ids_sha256) == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest())
        assert row.decoded_sha256 == hashlib.sha256((r.text or "").encode()).hexdigest()
