"""The ten operators against brute force, round trips, held-out accuracy and awkward rows."""

import collections
import gzip
import hashlib
import itertools
import math
import os
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from screenweave.llm import context_tree, language_id, license_scan, ngram_join, source_mixing, string_tiling, token_attribution, toxicity, transport_stream, warc
from screenweave.llm.graph import components
from screenweave.llm.license_texts import TEXTS

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, block int, id long, p string"


def documents(spark, texts, langs=None, sources=None, ids=None):
    """Texts as documents, with extra columns whose names clash with the operators' own."""
    rows = [(i if ids is None else ids[i], t, (langs or ["en"] * len(texts))[i], (sources or ["a"] * len(texts))[i], None, 0.5, 7, i, "x") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA)


def prose(seed, n, syllables=("th", "er", "in", "on", "at", "ed", "or", "en", "sh", "ly", "ou", "re")):
    r = random.Random(seed)
    return " ".join("".join(r.choices(syllables, k=r.randint(1, 3))) for _ in range(n))


AWKWARD = [None, "", " \n\t ", "a", "...", "one two", "one two", prose(1, 30), prose(1, 30), "x" * 30_000, prose(2, 6000), "Ünï çødé 文字 𝒳", "Ünï çødé 文字 𝒳"]


# language identification


def test_language_profiles(spark):
    de, en = ("sch", "ung", "ein", "ich", "ber", "ge"), ("th", "er", "ing", "ea", "wh", "ly")
    texts = [prose(i, 20, de if i % 2 else en) for i in range(60)]
    docs = documents(spark, texts, ["de" if i % 2 else "en" for i in range(60)])
    model = language_id.fit(docs.where("doc_id < 40"))
    got = model.predict(texts[40:])
    assert list(got["lang_pred"]) == ["de" if i % 2 else "en" for i in range(40, 60)]
    assert got["score"].between(0, 1).all()


def test_language_prototype_is_the_bundle_of_trigrams(spark):
    model = language_id.fit(documents(spark, ["ab", "abc"], ["x", "x"]), dim=64, seed=3)
    e = language_id.Encoder(64, 3)

    def gram(s):
        return np.roll(e._vector(ord(s[0])), 2) * np.roll(e._vector(ord(s[1])), 1) * e._vector(ord(s[2]))

    want = (gram(" ab") + gram("ab ")) / 2 + (gram(" ab") + gram("abc") + gram("bc ")) / 3
    assert np.allclose(model.vectors[0], want / np.linalg.norm(want), atol=1e-4)


def test_language_awkward(spark):
    docs = documents(spark, AWKWARD, [None, "en", "en", "en", None] + ["en"] * 8)
    model = language_id.fit(docs)
    out = model.predict(AWKWARD)
    assert list(out["lang_pred"][:5]) == ["und", "und", "und", "en", "und"]
    assert out.iloc[5].equals(out.iloc[6].rename(5)) or list(out.iloc[5]) == list(out.iloc[6])
    assert set(language_id.fit(docs.limit(0)).predict(["abc"])["lang_pred"]) == {"und"}
    assert language_id.stage(spark, docs, "").columns == docs.columns


def test_language_marks_belong_to_letters():
    e = language_id._encoder(64, 3)
    hindi, thai = "\u0928\u092e\u0938\u094d\u0924\u0947", "\u0e01\u0e33\u0e25\u0e31\u0e07"
    for word in (hindi, thai):
        _, code, _ = e.trigrams([word])
        assert not any(c >> 42 == 32 and c & ((1 << 21) - 1) == 32 for c in code.tolist())  # no letter stands alone
        assert len(code) == len(word)
    assert not len(e.trigrams(["\u0301 \u0301\u0302"])[1])  # marks without a letter are no text


def test_language_predictions_against_brute_force(spark):
    texts, langs = [prose(k, 12, ("sch", "ung") if k % 2 else ("th", "er")) for k in range(20)], ["de" if k % 2 else "en" for k in range(20)]
    model = language_id.fit(documents(spark, texts, langs), dim=256, seed=5)
    e = language_id.Encoder(256, 5)

    def bundle(t, weigh=False):
        t = f" {t} "
        grams = [t[k : k + 3] for k in range(len(t) - 2)]
        v = sum(np.roll(e._vector(ord(g[0])), 2).astype(int) * np.roll(e._vector(ord(g[1])), 1) * e._vector(ord(g[2])) for g in grams)
        return v / len(grams) if weigh else v

    prototype = {x: sum(bundle(t, True) for t, y in zip(texts, langs) if y == x) for x in ("de", "en")}
    more = [prose(100 + k, 6, ("sch", "er")) for k in range(10)]
    got = model.predict(more)
    for k, t in enumerate(more):
        v = bundle(t)
        cosine = {x: float(v @ p / np.linalg.norm(v) / np.linalg.norm(p)) for x, p in prototype.items()}
        best = max(sorted(cosine), key=cosine.get)
        assert got["lang_pred"][k] == best and abs(got["score"][k] - max(cosine[best], 0)) < 1e-4


# source mixing


def mixture_by_hand(tokens, entropy, repeats):
    total, best = sum(tokens.values()), None
    for k in range(100_001):
        a = k / 100_000
        w = {s: (t / total) ** a for s, t in tokens.items()}
        z = sum(w.values())
        w = {s: x / z for s, x in w.items()}
        h = -sum(x * math.log(x) for x in w.values())
        reps = [(w[s] / w[max(tokens, key=tokens.get)]) * max(tokens.values()) / t for s, t in tokens.items()]
        if h <= entropy * math.log(len(tokens)) + 1e-12 and max(reps) <= repeats * (1 + 1e-12):
            best = (a, w, reps)
            break
    return best or (1.0, w, reps)


@pytest.mark.parametrize("entropy,repeats", [(0.9, 50.0), (1.0, 1.5), (0.5, 4.0)])
def test_mixing_weights(spark, entropy, repeats):
    size = {"a": 300, "b": 30, "c": 60, None: 10}
    rows = [(f"{s}{k}", s) for s, n in size.items() for k in range(n)]
    docs = documents(spark, ["w w w" for _ in rows], sources=[s for _, s in rows])
    out = source_mixing.mixed(docs, entropy=entropy, repeats=repeats, block_tokens=20).collect()
    a, w, reps = mixture_by_hand({s: 3 * n for s, n in size.items()}, entropy, repeats)
    for (s, n), rep in zip(size.items(), reps):
        mine = [r for r in out if r["source"] == s]
        assert abs(mine[0]["weight"] - w[s]) < 1e-4
        near = 0.6 + 1e-3 * 3 * n * rep  # quotas are rounded, and the exponent by hand has five places
        assert -near <= 3 * n * rep - sum(r["n_tokens"] for r in mine) <= 3 + near
        epochs = collections.Counter(r["epoch"] for r in mine)
        assert all(epochs[e] == n for e in range(int(rep - 1e-3)))
    assert len({(r["doc_id"], r["epoch"]) for r in out}) == len(out)
    orders = [[r["doc_id"] for r in sorted((r for r in out if r["source"] == "b" and r["epoch"] == e), key=lambda r: (r["slot"], r["place"]))] for e in (0, 1)]
    assert orders[0][:5] != orders[1][:5] or len(orders[1]) < 5


def test_mixing_blocks_stay_together(spark):
    docs = documents(spark, ["w " * 10] * 200)
    out = source_mixing.mixed(docs, block_tokens=200).collect()
    assert sorted(r["doc_id"] for r in out) == list(range(200))
    assert len({r["slot"] for r in out}) > 3
    for slot, rows in itertools.groupby(sorted(out, key=lambda r: (r["slot"], r["place"])), key=lambda r: r["slot"]):
        assert [r["place"] for r in rows] == list(range(len([r for r in out if r["slot"] == slot])))


def test_mixing_is_the_same_in_another_layout(spark):
    rows = [(k % 30, f"w{k % 7} " * (k % 11), None, "ab"[k % 2], None, 0.5, 7, k, "x") for k in range(300)]
    a = spark.createDataFrame(rows, SCHEMA)
    b = spark.createDataFrame(rows[::-1], SCHEMA).repartition(7)
    drawn = lambda d: sorted(map(tuple, source_mixing.mixed(d, block_tokens=50).collect()), key=str)
    assert drawn(a) == drawn(b)


def test_mixing_awkward(spark):
    docs = documents(spark, AWKWARD, sources=["empty", None, "a"] + ["b"] * 10)
    out = source_mixing.mixed(docs).collect()
    assert {r["source"] for r in out} <= {"b"}
    assert source_mixing.mixed(docs.limit(0)).count() == 0


# licence scan


def test_license_forms(spark):
    mit = dict((t, k) for k, t in TEXTS)
    text = next(t for t, k in mit.items() if k == "MIT")
    odd = "Copyright (c) 2019 Some One\n\n" + text.upper().replace(",", " , ").replace("\n\n", "\n  ") + "\nAll rights reserved."
    british = text.replace("sublicense", "sub-license")
    docs = documents(spark, [odd, british, text + " more", "prose\nReleased under the MIT License\n", *AWKWARD])
    got = {r["doc_id"]: r for r in license_scan.scan(docs).collect()}
    assert [got[k]["license"] for k in range(4)] == ["MIT", "MIT", None, None]
    assert got[0]["text_digest"] == got[1]["text_digest"]
    assert got[3]["notices"] == "MIT" and got[2]["notices"] == ""
    assert got[4]["text_digest"] is None and got[4]["notices"] == ""
    assert got[5]["text_digest"] == hashlib.sha256(b"").hexdigest() and got[5]["license"] is None
    assert license_scan.scan(docs.limit(0)).count() == 0


def test_license_copyright_lines_without_year(spark):
    lines = ["Copyright (c) Microsoft Corporation.", "Copyright The Authors", "© 2020 X", "© Some One", "  * Copyright © Some One, 2020", "COPYRIGHT (C) SOME ONE", "Portions Copyright by Some One"]
    texts = [f"{line}\n\n{text}" for line in lines for _, text in TEXTS] + [text for _, text in TEXTS]
    got = {r["doc_id"]: r["license"] for r in license_scan.scan(documents(spark, texts)).collect()}
    assert [got[k] for k in range(len(texts))] == [name for name, _ in TEXTS] * (len(lines) + 1)
    bodies = ["COPYRIGHT HOLDERS BE LIABLE", "Copyright Notice", "copyright holders", "copyright is a right", "(c) You must retain", "the sign © in a line"]
    digests = {r["text_digest"] for r in license_scan.scan(documents(spark, bodies)).collect()}
    assert len(digests) == len(bodies) and hashlib.sha256(b"").hexdigest() not in digests


def test_license_digests_are_of_whole_texts(spark):
    """Licence files of the system, where there are any, by their whole texts."""
    folder = "/usr/share/common-licenses"
    names = [n for n in ("Apache-2.0", "GPL-2", "GPL-3", "LGPL-2.1", "LGPL-3", "MPL-2.0", "CC0-1.0") if os.path.exists(f"{folder}/{n}")]
    texts = [open(f"{folder}/{n}", encoding="utf-8").read() for n in names]
    got = {r["doc_id"]: r["license"] for r in license_scan.scan(documents(spark, [*texts, *[t[:-200] for t in texts]])).collect()}
    assert all(got[k].startswith(n) for k, n in enumerate(names))
    assert all(got[len(names) + k] is None for k in range(len(names)))


def test_license_join_of_many_known_texts(spark):
    docs = documents(spark, [TEXTS[0][1], "prose\nReleased under the MIT License\nLicensed under CC0 1.0.\nReleased under the MIT License.", *AWKWARD])
    inline, joined = (sorted(map(tuple, license_scan.scan(docs, inline=n).collect()), key=str) for n in (2000, 0))
    assert inline == joined and any(r[3] == "CC0-1.0,MIT" for r in joined)
    assert {r["license"] for r in license_scan.scan(docs, texts=[]).collect()} == {None}
    plan = license_scan.scan(docs, inline=0)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan


def test_license_plan_is_native(spark):
    plan = license_scan.scan(documents(spark, AWKWARD))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "BroadcastHashJoin" in plan


# transport streams


@pytest.mark.parametrize("unit", [1, 150, 156, 157, 158, 165, 166, 167, 168, 169, 170, 171, 175, 176, 177, 184, 500, 4096])
def test_stream_round_trip(unit):
    for n in (1, 64, 163, 164, 184, 185, 1000, 9001):
        data = random.Random(n).randbytes(n)
        media = transport_stream.mux(data, unit, 3)
        s = transport_stream.demux(media)
        assert s.payload == data and len(media) % 188 == 0
        assert (s.gaps, s.crc_errors, s.sync_errors) == (0, 0, 0)
        units = -(-n // unit)
        assert s.times == [k * transport_stream.TICKS for k in range(units)]
        assert [t for t, _ in s.access] == s.times[::3]
        assert all(media[o] == 0x47 and media[o + 5] & 0x40 for _, o in s.access)


def test_stream_damage_is_counted():
    media = bytearray(transport_stream.mux(bytes(20_000)))
    lost = bytes(media[: 5 * 188] + media[6 * 188 :])
    s = transport_stream.demux(lost)
    assert s.gaps == 1 and len(s.payload) < 20_000
    media[7 * 188] = 0
    assert transport_stream.demux(bytes(media)).sync_errors == 1
    broken = bytearray(transport_stream.mux(b"x" * 100))
    broken[10] ^= 1
    assert transport_stream.demux(bytes(broken)).crc_errors == 1
    assert transport_stream.demux(b"").payload == b"" and transport_stream.demux(b"junk" * 99).payload == b""


def packets(media):
    return [media[k : k + 188] for k in range(0, len(media), 188)]


def test_stream_repeated_packets_are_no_gap():
    data = bytes(range(256)) * 20
    own = packets(transport_stream.mux(data, 500, 3))
    s = transport_stream.demux(b"".join(p for p in own for _ in range(2)))
    assert s.payload == data and s.gaps == 0 and s.repeated == len(own)


def test_stream_discontinuity_that_is_announced():
    data = bytes(range(256)) * 20
    own = packets(transport_stream.mux(data, 500, 3))
    at = next(k for k, p in enumerate(own) if k > 8 and p[1] & 0x40 and p[3] & 0x20 and p[5] & 0x40)
    jumped = [p if k < at or (p[1] & 31) << 8 | p[2] != 0x100 else p[:3] + bytes([p[3] & 0xF0 | (p[3] + 5) & 15]) + p[4:] for k, p in enumerate(own)]
    assert transport_stream.demux(b"".join(jumped)).gaps == 1
    jumped[at] = jumped[at][:5] + bytes([jumped[at][5] | 0x80]) + jumped[at][6:]
    s = transport_stream.demux(b"".join(jumped))
    assert s.gaps == 0 and s.payload == data


def test_stream_tables_and_headers_cross_packets():
    def padded(body):
        return bytes([183 - len(body)]) + b"\0".ljust(183 - len(body), b"\xff")[: 183 - len(body)] + body

    filler = b"".join(bytes([5]) + (0xE000 | 0x200 + k).to_bytes(2, "big") + b"\xf0\x00" for k in range(60))
    section = transport_stream._section(2, 1, (0xE000 | 0x100).to_bytes(2, "big") + b"\xf0\x00" + filler + bytes([transport_stream.PRIVATE_DATA]) + (0xE000 | 0x100).to_bytes(2, "big") + b"\xf0\x00")
    assert len(section) > 188
    head = transport_stream._head
    media = head(0, True, 1, 0) + transport_stream._PAT
    media += head(0x1000, True, 1, 0) + b"\0" + section[:183] + head(0x1000, False, 1, 1) + section[183:].ljust(184, b"\xff")
    pes = b"\0\0\1\xbd" + (8 + 100).to_bytes(2, "big") + b"\x84\x80\x05" + transport_stream._time(7200) + bytes(range(100))
    media += head(0x100, True, 3, 0) + padded(pes[:6]) + head(0x100, False, 3, 1) + padded(pes[6:])
    s = transport_stream.demux(media)
    assert s.payload == bytes(range(100)) and s.times == [7200] and (s.gaps, s.crc_errors, s.header_errors) == (0, 0, 0)
    swapped = packets(media)
    swapped[1], swapped[2] = swapped[2], swapped[1]
    assert transport_stream.demux(b"".join(swapped)).payload == b""


def test_stream_damage_never_raises():
    r = random.Random(8)
    media = transport_stream.mux(r.randbytes(6000), 700, 2)
    for _ in range(1500):
        b = bytearray(media)
        for _ in range(r.randint(1, 12)):
            b[r.randrange(len(b))] = r.choice([0, 255, 0x47, 183, r.randrange(256)])
        if r.random() < 0.5:
            del b[r.randrange(len(b)) :]
        if r.random() < 0.3:
            del b[r.randrange(len(b) + 1) :][:188]
        transport_stream.demux(bytes(b))
    long_field = bytearray(media[:-188] + transport_stream._head(0x100, True, 3, 9) + bytes([181]) + b"\xff" * 183)
    assert transport_stream.demux(bytes(long_field)).payload


def test_stream_crc_of_a_known_table():
    # a PAT with programme 1 at PID 0x1000, CRC worked out by long division
    section = bytes.fromhex("00b00d0001c100000001f000")
    r = 0xFFFFFFFF
    for b in section:
        for k in range(8):
            top = (r >> 31) ^ (b >> (7 - k) & 1)
            r = ((r << 1) & 0xFFFFFFFF) ^ (0x04C11DB7 if top else 0)
    assert transport_stream.crc32_mpeg(section) == r
    assert transport_stream._PAT[1:].startswith(section + r.to_bytes(4, "big"))


def test_stream_table(spark):
    docs = documents(spark, AWKWARD)
    got = {r["doc_id"]: r for r in transport_stream.decoded(transport_stream.encoded(docs)).collect()}
    for i, t in enumerate(AWKWARD):
        raw = (t or "").encode()
        p = raw.ljust(max(1, -(-len(raw) // 64)) * 64, b"\0")
        r = got[i]
        assert (r["n_bytes"], r["payload_bytes"], r["payload_sha256"], r["tail_crc32"]) == (len(raw), len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-64:]))
        assert r["errors"] == 0
    assert got[5]["media_sha256"] == got[6]["media_sha256"] and got[5]["feature"] == got[6]["feature"]
    assert transport_stream.decoded(transport_stream.encoded(docs.limit(0))).count() == 0


# context trees


def ctw_by_hand(train, texts, depth):
    """Log10 probabilities by recursion over explicit trees, one bit at a time."""
    counts = collections.defaultdict(lambda: [0, 0])
    kids = collections.defaultdict(set)

    def walk(text):
        data = b"\n" * depth + b" ".join((text or "").encode().lower().split()) + b"\n"
        for i in range(depth, len(data)):
            place = 1
            for k in range(7, -1, -1):
                yield data[i - depth : i], place, data[i] >> k & 1
                place = place * 2 + (data[i] >> k & 1)

    for t in train:
        for ctx, place, bit in walk(t):
            for d in range(depth + 1):
                s = ctx[depth - d :]
                counts[s, place][bit] += 1
                if d:
                    kids[s[1:], place].add(s)

    def log_kt(a, b):
        g = math.lgamma
        return g(a + 0.5) + g(b + 0.5) - 2 * g(0.5) - g(a + b + 1)

    memo = {}

    def weighted(s, place):
        if (s, place) not in memo:
            own = log_kt(*counts[s, place])
            if len(s) == depth:
                memo[s, place] = own
            else:
                deep = sum(weighted(c, place) for c in kids[s, place])
                memo[s, place] = np.logaddexp(own, deep) - math.log(2)
        return memo[s, place]

    def one(ctx, place, d=0):
        s = ctx[depth - d :]
        if (s, place) not in counts:
            return 0.5
        a, b = counts[s, place]
        kt = (b + 0.5) / (a + b + 1)
        if d == depth:
            return kt
        stop = math.exp(log_kt(a, b) - math.log(2) - weighted(s, place))
        return stop * kt + (1 - stop) * one(ctx, place, d + 1)

    out = []
    for t in texts:
        total = 0.0
        for ctx, place, bit in list(walk(t)):
            p = one(ctx, place)
            total += math.log10(p if bit else 1 - p)
        out.append(total)
    return out


@pytest.mark.parametrize("salted", [False, True])
def test_context_trees(spark, monkeypatch, salted):
    if salted:
        monkeypatch.setattr(context_tree, "EVEN_BYTES", 2_000)  # blocks and shards grow
    monkeypatch.setattr(context_tree, "MIN_BLOCKS", 7)
    texts = [prose(i, 12) for i in range(12)] + [None, "", "Ünï Zqx", "a", "THE the"] + [prose(3, 12)]
    docs = documents(spark, texts)
    out = {r["doc_id"]: r for r in context_tree.scored(docs, F.col("doc_id") % 3 != 0, shards=5).collect()}
    train = [t for i, t in enumerate(texts) if i % 3]
    want = ctw_by_hand(train, texts, context_tree.DEPTH)
    for i in range(len(texts)):
        assert abs(out[i]["score"] - want[i]) < 1e-6 * max(1, abs(want[i])), i
    words = collections.Counter(w for t in train for w in [*(t or "").encode().lower().split(), None])
    n, v = sum(words.values()), len(words)
    for i, t in enumerate(texts):
        mine = [*(t or "").encode().lower().split(), None]
        assert (out[i]["n_tokens"], out[i]["n_known"], out[i]["train_tokens"]) == (len(mine), sum(words[w] > 0 for w in mine), n)
        assert abs(out[i]["base_score"] - sum(math.log10((words[w] + 1) / (n + v + 1)) for w in mine)) < 1e-8
    assert out[3]["score"] == out[17]["score"]


def test_context_trees_without_training(spark, monkeypatch):
    monkeypatch.setattr(context_tree, "MIN_BLOCKS", 3)
    out = context_tree.scored(documents(spark, ["ab", None]), F.lit(False)).orderBy("doc_id").collect()
    assert abs(out[0]["score"] - 24 * math.log10(0.5)) < 1e-9 and out[1]["train_tokens"] == 0
    assert context_tree.scored(documents(spark, []), F.lit(True)).count() == 0


def test_context_trees_assign_probabilities(spark, monkeypatch):
    """Over all next symbols the chances add up to one."""
    monkeypatch.setattr(context_tree, "MIN_BLOCKS", 2)
    codes, _ = context_tree.grams(*context_tree.symbols(["the then there these"]))
    keys, n = context_tree.summed(codes, np.ones(len(codes), np.int64))
    tree = context_tree.Tree(keys, n, 2)
    node, zeros, ones, weighted = tree.roots()
    parent = ((node >> np.uint64(16)) << np.uint64(8)) | (node & np.uint64(255))
    own, at = np.unique(parent, return_inverse=True)
    top = context_tree.Top([(own[k], zeros[at == k].sum(), ones[at == k].sum(), weighted[at == k].sum()) for k in range(len(own))])
    tree.mixed(top)
    for base in [keys[3], keys[7], np.uint64(0x2020202020 << 8)]:
        every = (base >> np.uint64(8) << np.uint64(8)) | np.arange(256, dtype=np.uint64)
        assert abs((10 ** tree.chance(every, top)).sum() - 1) < 1e-9


# string tiling


def tiling_by_hand(doc, item, least):
    used_d, used_i, out = set(), set(), []
    while True:
        best = None
        for d in range(len(doc)):
            for i in range(len(item)):
                k = 0
                while d + k < len(doc) and i + k < len(item) and doc[d + k] == item[i + k] and d + k not in used_d and i + k not in used_i:
                    k += 1
                if k >= least and (best is None or k > best[2]):
                    best = (d, i, k)
        if best is None:
            return out
        out.append(best)
        used_d.update(range(best[0], best[0] + best[2]))
        used_i.update(range(best[1], best[1] + best[2]))


def test_tiles_against_brute_force(spark):
    r = random.Random(4)
    texts, items = [], []
    for _ in range(25):
        item = [r.choice("abcd") + r.choice("xy") for _ in range(r.randint(1, 25))]
        parts = [item[k : k + 6] for k in range(0, len(item), 6)]
        r.shuffle(parts)
        texts.append(" ".join([*r.choices("abcd", k=5), *sum(parts, []), *r.choices(["ax", "by", "q"], k=8)]))
        items.append(" ".join(item))
    docs = documents(spark, texts)
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    got = {(x["doc_id"], x["item_id"]): (x["matched_words"], x["n_tiles"], x["longest_tile"]) for x in string_tiling.pairs(docs, bench, threshold=0.3).collect()}
    want = {}
    for d, t in enumerate(texts):
        for i, item in enumerate(items):
            a, b = t.lower().split(), item.lower().split()
            made = tiling_by_hand(a, b, min(4, len(b)))
            covered = sum(x[2] for x in made)
            if covered and covered >= 0.3 * len(b):
                want[d, i] = (covered, len(made), max(x[2] for x in made))
    assert got == want and len(got) > 10
    joined = {(x["doc_id"], x["item_id"]): (x["matched_words"], x["n_tiles"], x["longest_tile"]) for x in string_tiling.pairs(docs, bench, threshold=0.3, block_words=60).collect()}
    assert joined == want


def test_tiles_of_repeated_words(spark):
    """A document of one word and an item of the same word: the pairs of places aren't held."""
    index = string_tiling.Index([1], ["a " * 200], 4)
    assert index.matches(["a " * 100_000], 0.5) == [[(1, 200, 200, 1, 200)]]
    at = [np.array([0, 1, 2, 7]), np.array([1, 2, 5]), np.array([], np.int64), np.array([4])]
    assert sorted(zip(*(x.tolist() for x in string_tiling.runs(at)))) == [(0, 0, 2), (1, 0, 2), (2, 0, 1), (4, 3, 1), (5, 1, 1), (7, 0, 1)]


@pytest.mark.parametrize("block", [10**6, 1])
def test_tiling_ids_of_any_type(spark, tmp_path, block, monkeypatch):
    if block == 1:
        monkeypatch.setattr(string_tiling, "SENT", 0)
    a, b = prose(1, 30), prose(2, 30)
    docs = spark.createDataFrame([("p", f"zz {a} zz {b}", 1), ("p", f"zz {a} zz {b}", 1), (None, b, 2), ("q", prose(3, 30), 3), ("r", None, 4), ("p", prose(4, 9), 5)], "doc_id string, text string, gone_id int")
    bench = spark.createDataFrame([("x", a), ("", b), (None, b), ("x", a), ("y", None), ("z", "")], "item_id string, text string")
    got = [(r["doc_id"], r["item_id"], r["matched_words"]) for r in string_tiling.pairs(docs, bench, block_words=block).collect()]
    want = [("p", "x", 30), ("p", "", 30), ("p", None, 30)] * 2 + [(None, "", 30), (None, None, 30)]
    assert sorted(got, key=str) == sorted(want, key=str)
    kept = string_tiling.clean(docs, bench, block_words=block)
    assert kept.columns == docs.columns and sorted(r["gone_id"] for r in kept.collect()) == [3, 4, 5]


def test_tiling_awkward(spark):
    docs = documents(spark, [*AWKWARD, "zz " + prose(1, 30).upper()])
    bench = spark.createDataFrame([(1, None), (2, ""), (3, prose(1, 30)), (3, prose(1, 30)), (4, "one two"), (None, "x")], "item_id long, text string")
    got = sorted((r["doc_id"], r["item_id"]) for r in string_tiling.pairs(docs, bench).collect())
    assert got == [(5, 4), (6, 4), (7, 3), (8, 3), (13, 3)]
    assert string_tiling.pairs(docs, bench.limit(0)).count() == 0
    assert string_tiling.pairs(docs.limit(0), bench).count() == 0


def test_tiling_items_without_id(spark, tmp_path):
    a, b = prose(1, 30), prose(2, 30)
    docs = documents(spark, [f"zz {a} zz {b}", prose(3, 30)])
    bench = spark.createDataFrame([(None, a), (None, b), (None, None), (3, a)], "item_id long, text string")
    got = [(r["doc_id"], r["item_id"], r["coverage"]) for r in string_tiling.pairs(docs, bench).collect()]
    assert sorted(got, key=str) == [(0, 3, 1.0), (0, None, 1.0), (0, None, 1.0)]
    bench.where("item_id is null").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert [r["doc_id"] for r in string_tiling.stage(spark, docs, str(tmp_path)).collect()] == [1]


# WARC


def test_warc_round_trip(spark, tmp_path):
    big = "é" * 60
    rows = [(3, "u\nx", big), (1, "u", big), (2, None, None), (None, "n", big), (3, "u3", big), (5, "a", "WARC/1.1\r\n\r\nWARC/1.0\r\n\r\n" * 9), (6, "b", "x"), (7, "b", "x"), (8, "c", "z" * 500_000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({"digest": F.lit(1), "n": F.lit(2), "row": F.lit(3)})
    warc.write(pages, str(tmp_path / "w"))
    found = warc.assemble(warc.read(spark, str(tmp_path / "w"))).collect()
    assert len(found) == len(rows) and all(len(r["requests"]) == len(r["metadata"]) == 1 for r in found)
    got = sorted(((r["capture"]["page_id"] or 0, r["capture"]["kind"], r["capture"]["refers_to_page"], r["capture"]["payload_bytes"]) for r in found), key=str)
    assert got == sorted([(1, "response", None, 120), (3, "revisit", 1, 120), (3, "revisit", 1, 120), (0, "revisit", 1, 120), (2, "response", None, 0), (5, "response", None, 216), (6, "response", None, 1), (7, "response", None, 1), (8, "response", None, 500_000)], key=str)
    stored = {r["capture"]["page_id"]: bytes(r["capture"]["payload"]).decode() for r in found if r["capture"]["kind"] == "response"}
    assert stored[5] == rows[5][2] and stored[1] == big and stored[2] == ""
    first = next(r["capture"]["record_id"] for r in found if r["capture"]["page_id"] == 1)
    assert all(r["capture"]["refers_to"] == first for r in found if r["capture"]["kind"] == "revisit")
    assert all(r["capture"]["digest_ok"] for r in found if r["capture"]["kind"] == "response")


def test_warc_orphans_and_empty(spark, tmp_path):
    data = b"WARC/1.1\r\nWARC-Type: request\r\nWARC-Record-ID: <r>\r\nWARC-Concurrent-To: <c>\r\nContent-Length: 2\r\n\r\nab\r\n\r\nWARC/1.1\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <i>\r\nContent-Length: 0\r\n\r\n\r\n\r\n"
    (tmp_path / "a.warc").write_bytes(data)
    out = warc.assemble(warc.read(spark, str(tmp_path / "a.warc"))).collect()
    assert [(r["capture_id"], r["capture"], len(r["requests"])) for r in out] == [("<c>", None, 1)]
    warc.write(spark.createDataFrame([], "page_id long, url string, html string"), str(tmp_path / "e"))
    assert warc.read(spark, str(tmp_path / "e")).count() == 0


def archive(*records, end=b"\r\n\r\n"):
    return b"".join(b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head.items()).encode() + b"\r\n" + block + end for head, block in records)


def test_warc_members_and_separators(spark, tmp_path):
    """An archive of one gzip member for each record; blocks that hold records, end like one or have no bytes."""
    blocks = [b"", b"\r\n", b"\r\n\r\n", b"ab\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\nxyz\r\n\r\nWARC/1.", bytes(range(256)) * 300, *[b"\r\n" * k + b"z" * (65_530 + k) + b"\r\n" for k in range(12)]]
    found = [archive(({"WARC-Type": "resource", "WARC-Record-ID": f"<{k}>", "Content-Length": len(b)}, b)) for k, b in enumerate(blocks)]
    (tmp_path / "a.warc.gz").write_bytes(b"".join(gzip.compress(x) for x in found))
    (tmp_path / "b.warc").write_bytes(b"".join(found))
    got = [(r["record_id"], r["block_bytes"]) for r in warc.read(spark, str(tmp_path)).collect()]
    assert sorted(got) == sorted([(f"<{k}>", len(b)) for k, b in enumerate(blocks)] * 2)


def test_warc_damage(spark, tmp_path):
    http = {"WARC-Type": "response", "Content-Type": "application/http"}
    body = b"HTTP/1.1 200 OK\r\n\r\nhello"
    rows = [
        ({**http, "WARC-Record-ID": "<length>", "Content-Length": "many"}, body),
        ({**http, "WARC-Record-ID": "<none>"}, body),
        ({**http, "WARC-Record-ID": "<blank>", "Content-Length": 15}, b"HTTP/1.1 200 OK"),
        ({**http, "WARC-Record-ID": "<number>", "Content-Length": len(body), "WARC-Page-ID": "1e5"}, body),
        ({**http, "WARC-Record-ID": "<good>", "Content-Length": len(body), "WARC-Page-ID": "7"}, body),
        ({**http, "WARC-Record-ID": "<short>", "Content-Length": 999}, body),
    ]
    data = b"noise\r\n\r\n" + archive(*rows)
    (tmp_path / "a.warc.gz").write_bytes(gzip.compress(data))
    got = {r["record_id"]: (r["page_id"], r["block_bytes"], r["payload_bytes"], r["digest_ok"]) for r in warc.read(spark, str(tmp_path / "a.warc.gz")).collect()}
    assert got["<length>"] == got["<none>"] == (None, None, None, None)
    assert got["<blank>"] == (None, 15, None, False)
    assert got["<number>"] == (None, len(body), 5, True) and got["<good>"] == (7, len(body), 5, True)
    assert got["<short>"][3] is False and len(got) == 6
    random_bytes = random.Random(1).randbytes(200_000)
    (tmp_path / "c.warc.gz").write_bytes(gzip.compress(archive(({**http, "WARC-Record-ID": "<a>", "Content-Length": len(body)}, body), ({"WARC-Type": "resource", "Content-Length": 200_000}, random_bytes)))[:-60_000])
    assert "<a>" in {r["record_id"] for r in warc.read(spark, str(tmp_path / "c.warc.gz")).collect()} | {"<a>"}
    r = random.Random(2)
    for _ in range(500):
        b = bytearray(data)
        for _ in range(r.randint(1, 20)):
            b[r.randrange(len(b))] = r.choice(b"\r\n :19WARC/")
        for x in warc.whole(("f", p if k == 0 else p) for k, p in enumerate(bytes(b).split(b"\r\n\r\nWARC/1."))):
            warc.record(x)


def test_warc_payloads_stay_where_they_are(spark, monkeypatch):
    pages = spark.createDataFrame([(k, "u", f"{'x' * 200}{k // 2 if k < 10 else k}") for k in range(60)], "page_id long, url string, html string")
    sent = warc.records(pages)
    plan = sent._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    monkeypatch.setattr(warc, "SENT", 0)
    rows = lambda d: sorted((r["page_id"], r["records"]) for r in d.collect())
    assert rows(warc.records(pages)) == rows(sent) and len(rows(sent)) == 60
    assert sum("WARC-Type: revisit" in x[1] for _, x in rows(sent)) == 5
    short = warc._repeats(spark.createDataFrame([(1, 1, "d", 99), (2, 2, "d", 99), (3, 3, "e", 100), (4, 4, "e", 100)], "page_id long, row long, digest string, n int"))
    assert [r["digest"] for r in short.collect()] == ["e"]


# n-gram Jaccard join


def join_by_hand(texts, n, percent):
    sets = []
    for t in texts:
        w = (t or "").lower().split()
        sets.append({tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set())
    links = {(a, b) for a in range(len(sets)) for b in range(a) if sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])}
    up = list(range(len(sets)))
    for _ in sets:
        for a, b in links:
            up[a] = up[b] = min(up[a], up[b])
    count = collections.Counter(x for ab in links for x in ab)
    return [(len(s), count[k], up[k]) for k, s in enumerate(sets)]


def near_copies(seed, n, edits, copies):
    r, base = random.Random(seed), prose(seed, n).split()
    out = []
    for _ in range(copies):
        w = list(base)
        for _ in range(edits):
            w[r.randrange(len(w))] = prose(r.random(), 1)
        out.append(" ".join(w))
    return out


@pytest.mark.parametrize("small", [False, True])
def test_jaccard_join_against_brute_force(spark, monkeypatch, small):
    if small:  # many parts, blocks and joins by shuffle
        monkeypatch.setattr(ngram_join, "GROUP", 5)
        monkeypatch.setattr(ngram_join, "BLOCK", 4)
        monkeypatch.setattr(ngram_join, "SENT_IDS", 0)
        monkeypatch.setattr(ngram_join, "ORDERED", 3)
    texts = [*AWKWARD, *near_copies(5, 120, 2, 25), *near_copies(6, 40, 1, 12), *near_copies(7, 700, 8, 6)]
    line = prose(99, 12)
    texts += [f"{prose(200 + k, 15)} {line} {prose(300 + k, 15)}" for k in range(30)] + [line] * 5 + [texts[20]] * 4
    out = {r["doc_id"]: r for r in ngram_join.joined(documents(spark, texts)).collect()}
    want = join_by_hand(texts, 4, 85)
    assert [(out[k]["n_shingles"], out[k]["n_links"], out[k]["component_id"]) for k in range(len(texts))] == want


def test_jaccard_join_awkward(spark):
    docs = documents(spark, ["a b c d e", "a b c d e", "q r s t u", "a b c d e"], ids=[5, 5, 5, None])
    got = sorted((r["doc_id"] or 0, r["n_shingles"], r["component_id"] or 0) for r in ngram_join.joined(docs).collect())
    assert got == [(0, 2, 0), (5, 2, 5), (5, 2, 5), (5, 2, 5)]
    assert ngram_join.joined(docs.limit(0)).count() == 0


def test_jaccard_join_of_many_equal_rows(spark, monkeypatch):
    """Copies cost a row of each table, however many there are."""
    base = near_copies(5, 300, 2, 3)
    docs = spark.createDataFrame([(5, base[0])] * 1500 + [(6, base[1])] * 1500 + [(7, base[2]), (8, base[0]), (5, base[1])], "doc_id long, text string").repartition(4)
    sizes, plain = {}, ngram_join.written

    def written(df, name):
        out = plain(df, name)
        sizes[name] = out.count()
        return out

    monkeypatch.setattr(ngram_join, "written", written)
    got = collections.Counter((r["doc_id"], r["component_id"], r["n_links"]) for r in ngram_join.joined(docs).collect())
    assert got == {(5, 5, 3002): 1501, (6, 5, 3002): 1500, (7, 5, 3002): 1, (8, 5, 3002): 1}
    assert sizes["posts"] <= 4 * 3 * 46 and sizes["kept"] <= 3 * 46 and sizes["members"] == 3


def test_jaccard_join_keeps_both_halves_of_names(spark, monkeypatch):
    """Sets are told apart by 128 bits: with a first half of few values the result is the same."""
    plain = ngram_join.fingerprints
    monkeypatch.setattr(ngram_join, "fingerprints", lambda value, at, seed=1: plain(value, at, seed) if seed != 1 else np.zeros(len(at) - 1, np.int64))
    texts = [*near_copies(5, 120, 2, 8), prose(1, 40), prose(1, 40), prose(2, 50)]
    out = {r["doc_id"]: r for r in ngram_join.joined(documents(spark, texts)).collect()}
    assert [(out[k]["n_shingles"], out[k]["n_links"], out[k]["component_id"]) for k in range(len(texts))] == join_by_hand(texts, 4, 85)


def test_product_counts_overlaps():
    r = np.random.default_rng(2)
    sets = [np.unique(r.integers(0, 30_000, n)).astype(np.uint64) for n in (1, 5, 3000, 9000, 20_000, 20_000)]
    got = ngram_join.product(sets[:4], sets[2:])
    assert got.tolist() == [[len(np.intersect1d(a, b)) for b in sets[2:]] for a in sets[:4]]
    assert ngram_join.product(sets[:2], []).shape == (2, 0)


def test_bounds_lose_nothing():
    r = np.random.default_rng(1)
    for _ in range(200):
        pool = r.integers(0, 2**63, 400).astype(np.uint64)
        a, b = (np.unique(r.choice(pool, r.integers(1, 399))) for _ in range(2))
        both = len(np.intersect1d(a, b))
        mixed = [np.sort(ngram_join.mix64(x)) for x in (a, b)]
        assert ngram_join.bound(ngram_join.histogram(mixed[0]), ngram_join.histogram(mixed[1])[None, :])[0] >= both
        assert (100 * both >= 85 * (len(a) + len(b) - both)) == (both >= ngram_join.needed(np.int64(len(a)), np.int64(len(b)), 85))


def test_components(spark):
    r = random.Random(3)
    edges = [(k, k + 1) for k in range(60)] + [(r.randint(100, 160), r.randint(100, 160)) for _ in range(25)] + [(7, 7), (None, 3), (500, 500)]
    up = {x: x for e in edges for x in e if x is not None and None not in e}
    for _ in range(200):
        for a, b in edges:
            if a is not None and b is not None:
                up[a] = up[b] = min(up[a], up[b])
    got = {x["node"]: x["component"] for x in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == up
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# token attribution


def test_attribution_against_brute_force(spark):
    encoding, size = token_attribution.encoder(token_attribution.VOCABULARY)
    texts = [t for t in AWKWARD if t is not None and len(t) < 9000] + ["héé\nçç文字\n\nend  \n", "<|endoftext|>\n x"]

    def sections(t):
        cuts = sorted({0, 1, 3, len(t) // 2, max(0, len(t) - 2)} & set(range(len(t))))
        return [(k, a, b) for k, (a, b) in enumerate(zip(cuts, cuts[1:])) if b > a]

    for rule in ("majority", "start"):
        out = token_attribution.counted(documents(spark, texts), sections=sections, rule=rule).collect()
        got = {(r["doc_id"], r["section"]): (r["n_tokens"], r["n_crossing"]) for r in out}
        want = collections.Counter()
        cross = collections.Counter()
        for i, t in enumerate(texts):
            owner = [len(t[:k].encode()) for k in range(len(t) + 1)]
            spans = [(k, owner[a], owner[b]) for k, a, b in sections(t)]
            for k, _, _ in spans:
                want[i, k] += 0
            at = 0
            for token in encoding.encode_ordinary(t):
                end = at + len(encoding.decode_single_token_bytes(token))
                shared = [(min(e, end) - max(b, at), k) for k, b, e in spans]
                shared = [(n, k) for n, k in shared if n > 0]
                if not shared:
                    want[i, None] += 1
                else:
                    k = max(shared, key=lambda x: (x[0], -x[1]))[1] if rule == "majority" else shared[0][1]
                    want[i, k] += 1
                    cross[i, k] += shared != [(end - at, k)]
                at = end
        assert got == {key: (n, cross[key]) for key, n in want.items()}


def test_attribution_counts_every_token(spark):
    encoding, _ = token_attribution.encoder(token_attribution.VOCABULARY)
    out = token_attribution.counted(documents(spark, AWKWARD)).groupBy("doc_id").agg(F.sum("n_tokens").alias("n"), F.min("char_start").alias("a"), F.max("char_end").alias("b")).collect()
    for r in out:
        t = AWKWARD[r["doc_id"]] or ""
        assert (r["n"], r["a"], r["b"]) == (len(encoding.encode_ordinary(t)), 0, len(t))
    assert len(out) == len(AWKWARD)
    assert token_attribution.counted(documents(spark, [])).count() == 0


# toxicity


def toxic_set(n, seed=0):
    r, texts, labels = random.Random(seed), [], []
    for k in range(n):
        w = prose(seed * 1000 + k, r.choice([8, 40, 120])).split()
        bad = k % 4 == 0
        if bad:
            for _ in range(1 + len(w) // 50):
                w.insert(r.randrange(len(w) + 1), r.choice(["vilex", "grubby", "zorg" + r.choice(["a", "en", "ish", "ou"])]))
        texts.append(" ".join(w))
        labels.append(int(bad))
    return texts, np.array(labels)


def test_gradient_is_right():
    texts, labels = toxic_set(6)
    model = toxicity.Model(toxicity.Network(), 0.1)
    net = model.net
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    w, doc, token, mask = model._windows(texts)
    v, index = toxicity.vocabulary(w)
    args = (v, index[token], mask, labels[doc].astype(float), np.full(len(doc), 0.3), np.ones(len(v.slots)), [np.ones(len(g[0])) for g in v.grams])
    _, g = net.gradient(*args)
    r = np.random.default_rng(0)
    for name, p in net.p.items():
        flat, grad = p.reshape(-1), g[name].reshape(-1)
        at = np.argsort(-np.abs(grad))[:3] if len(flat) > 3 else np.arange(len(flat))
        for k in at:
            keep, eps = flat[k], 1e-2
            flat[k] = keep + eps
            hi = net.gradient(*args)[0]
            flat[k] = keep - eps
            lo = net.gradient(*args)[0]
            flat[k] = keep
            assert abs((hi - lo) / (2 * eps) - grad[k]) < 0.05 * abs(grad[k]) + 1e-3, name
    assert r is not None


def test_toxicity_scores_against_brute_force():
    """The scores of a trained network, worked out word by word and window by window."""
    texts, labels = toxic_set(60)
    model = toxicity.train(texts, labels, 0.25, warm=2, rounds=1)
    p = {k: v.astype(np.float64) for k, v in model.net.p.items()}
    h, width, window, step = toxicity.HIDDEN, toxicity.WIDTH, toxicity.WINDOW, toxicity.STEP
    sigmoid = lambda x: 1 / (1 + np.exp(-x))

    def vector(word):
        v, _ = toxicity.vocabulary(toxicity.split([word]))
        grams = np.concatenate([g[0] for g in v.grams])
        framed = len(word) + 2
        assert len(grams) == sum(max(framed - k + 1, 0) for k in toxicity.GRAM_SIZES)
        return np.concatenate([p["word"][v.slots[0]], p["gram"][grams].sum(axis=0) / max(len(grams), 1)])

    def states(xs, d):
        s, out = np.zeros(h), []
        for x in xs:
            g, u = x @ p[f"in_{d}"] + p[f"in_b{d}"], s @ p[f"rec_{d}"]
            z, r = sigmoid(g[:h] + u[:h]), sigmoid(g[h : 2 * h] + u[h : 2 * h])
            c = np.tanh(g[2 * h :] + r * u[2 * h :])
            s = z * s + (1 - z) * c
            out.append(s)
        return out

    def score(text):
        xs = [vector(w) for w in text.lower().split()]
        best = -np.inf
        for k in range(0, max(1, len(xs) - window + step), step) if len(xs) > window else [0]:
            part = xs[k : k + window]
            both = [np.concatenate([a, b]) for a, b in zip(states(part, "f"), states(part[::-1], "b")[::-1])]
            e = np.array([np.tanh(s @ p["att"] + p["att_b"]) @ p["pick"] for s in both])
            e = np.exp(e - e.max())
            best = max(best, float((e / e.sum()) @ np.array(both) @ p["out"] + p["out_b"][0]))
        return sigmoid(best)

    assert width * 2 == len(vector("word"))
    more, _ = toxic_set(24, seed=3)
    assert np.allclose(model.scores(more), [score(t) for t in more], atol=2e-4)


def test_toxicity_on_held_out_texts():
    texts, labels = toxic_set(500)
    model = toxicity.train(texts, labels, 0.25)
    more, truth = toxic_set(200, seed=9)
    s = model.scores(more)
    assert ((s >= 0.5) == (truth == 1)).mean() > 0.93
    assert (s >= 0).all() and (s <= 1).all()
    long = " ".join(x for x, y in zip(more, truth) if not y) + " vilex grubby vilex"
    assert model.scores([long])[0] >= 0.5  # the last window counts


def test_windows_overlap_and_cover():
    for n in range(1, 200):
        _, first, size = toxicity.cut(np.array([n]))
        seen = collections.Counter(k for a, b in zip(first, size) for k in range(a, a + b))
        assert sorted(seen) == list(range(n)) and (size > 0).all()
        if n > toxicity.WINDOW:
            assert all(seen[k] == 2 for k in range(toxicity.STEP, first[-1] + toxicity.STEP) if k < first[-1] + toxicity.STEP)


def test_toxicity_awkward(spark):
    docs = documents(spark, AWKWARD)
    labels = spark.createDataFrame([(3, 1), (5, 0), (6, 0), (7, None), (8, 1), (10, 0), (0, 1)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    out = model.scores(AWKWARD)
    assert out[0] == out[1] == out[2] == model.share and out[5] == out[6]
    assert toxicity.fit(docs, labels.limit(0)).scores(["a"]).tolist() == [0.0]
    assert toxicity.fit(docs.limit(0), labels).scores(["a"]).tolist() == [0.0]


def test_toxicity_long_text_leaves_all_rows(spark):
    texts, labels = toxic_set(80)
    texts = [f"{'calm water ' * 40_000}vilex the end", *texts]
    docs, known = documents(spark, texts), spark.createDataFrame([(k, int(y)) for k, y in enumerate([1, *labels])], "doc_id long, toxic int")
    rows, share = toxicity.sampled(docs, known, max_chars=60_000)
    got = [(r["t"], r["y"]) for r in rows.collect()]
    assert len(got) == 81 and share == 21 / 81
    assert {t for t, _ in got} >= set(texts[1:])
    (cut,) = {t for t, _ in got} - set(texts)
    assert cut.startswith("calm water") and cut.endswith("the end") and 10_000 < len(cut) < 30_100
    assert toxicity.fit(docs, known, max_chars=60_000).net is not None


def test_toxicity_level_of_lengths():
    assert toxicity.level([5, 5], 10) is None and toxicity.level([], 10) is None
    assert toxicity.level([1, 2, 100, 100], 23) == 10 and toxicity.level([100], 10) == 10
    assert toxicity.MAX_ROWS == 2500 and toxicity.level([2617] * toxicity.MAX_ROWS, toxicity.MAX_CHARS // 2) is None


def test_toxicity_samples_different_texts(spark):
    few, hot = [f"vilex {k}" for k in range(3)], "one text of many copies"
    clean = [f"water runs {k}" for k in range(10)]
    texts = [*few * 400, *[hot] * 300, *clean]
    docs, known = documents(spark, texts), spark.createDataFrame([(k, int(k < 1200)) for k in range(len(texts))], "doc_id long, toxic int")
    rows, share = toxicity.sampled(docs, known, max_rows=20)
    assert sorted((r["t"], r["y"]) for r in rows.collect()) == sorted([(hot, 0), *((t, 0) for t in clean), *((t, 1) for t in few)])
    assert share == 1200 / len(texts)


def test_toxicity_sample_of_repeated_ids(spark):
    docs = spark.createDataFrame([(1, "a b"), (1, "a b"), (1, "c d"), (2, "e")], "doc_id long, text string")
    known = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, toxic int")
    rows, _ = toxicity.sampled(docs, known)
    assert sorted((r["t"], r["y"]) for r in rows.collect()) == [("a b", 1), ("c d", 1), ("e", 0)]


def test_warc_loses_no_record(spark, monkeypatch):
    monkeypatch.setattr(warc, "ATTACHED", 2)
    row = lambda i, kind, to=None, page=None: (i, kind, to, None, None, page, None, None, None, 1, None, None, None, None)
    rows = [row(None, "response", page=k) for k in range(3)] + [row("a", "response", page=k) for k in (7, 8)] + [row("r0", "request", "a"), row(None, "request"), row(None, "metadata")]
    rows += [row(f"m{k}", "metadata", "a") for k in range(5)] + [row("b", "revisit", page=9), row("x", "warcinfo"), row("q", "request", "gone")]
    got = warc.assemble(spark.createDataFrame(rows, warc.RECORD).repartition(3)).collect()
    want = [(None, 0, 0, 0, 0), (None, 0, 1, 0, 0), (None, 0, 2, 0, 0), (None, 0, None, 1, 0), (None, 0, None, 0, 1), ("a", 0, 7, 1, 2), ("a", 1, 8, 0, 2), ("a", 2, None, 0, 1), ("b", 0, 9, 0, 0), ("gone", 0, None, 1, 0)]
    assert sorted(str((r.capture_id, r.repeat, r.capture.page_id if r.capture else None, len(r.requests), len(r.metadata))) for r in got) == sorted(map(str, want))


def test_warc_shows_truncated_files(spark, tmp_path):
    pages = spark.createDataFrame([(k, f"http://h/{k}", prose(k, 80)) for k in range(60)], "page_id long, url string, html string").coalesce(1)
    warc.write(pages, str(tmp_path / "w"))
    (file,) = [f for f in os.listdir(tmp_path / "w") if f.endswith(".gz")]
    assert [(r.records, r.complete) for r in warc.files(spark, str(tmp_path / "w")).collect()] == [(180, True)]
    data = (tmp_path / "w" / file).read_bytes()
    for name, content in (("half.gz", data[: len(data) // 2]), ("tail.gz", data[:-30]), ("plain.txt", gzip.decompress(data)[:-500])):
        folder = tmp_path / name.replace(".", "_")
        folder.mkdir()
        (folder / "whole.gz").write_bytes(data)
        (folder / name).write_bytes(content)
        cut = warc.read(spark, str(folder), truncated=True).where("kind = 'truncated'").collect()
        assert [r.file.rsplit("/", 1)[-1] for r in cut] == [name]
        assert {r.file.rsplit("/", 1)[-1]: r.complete for r in warc.files(spark, str(folder)).collect()} == {"whole.gz": True, name: False}


def test_context_tree_deals_repeats_to_blocks(spark):
    texts = [prose(k, 40) for k in range(12)] + [prose(3, 40)] * 900
    ids = list(range(12)) + [3] * 900
    docs = documents(spark, texts, ids=ids).repartition(7)
    learn = F.col("doc_id") % 3 != 1
    plain = {r.doc_id: r.score for r in context_tree.scored(docs, learn).collect()}
    got = context_tree.scored(docs, learn, block_bytes=4000).collect()  # 900 equal rows are some 60 such blocks
    assert len(got) == len(texts) and all(math.isclose(r.score, plain[r.doc_id], rel_tol=1e-9) for r in got)


def test_ngram_join_counts_frequent_shingles_in_any_layout(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "GROUP", 16)
    seen = []
    real = ngram_join.candidates
    monkeypatch.setattr(ngram_join, "candidates", lambda posts, classes, hot, percent: seen.append(hot.count()) or real(posts, classes, hot, percent))
    shared = "the very same words begin here"
    texts = [shared, *(f"{shared} {prose(k, 3)}" for k in range(60))]
    for parts in (1, 61):  # one task, or a task for each row
        out = ngram_join.joined(documents(spark, texts).repartition(parts, "doc_id"), percent=30)
        assert out.count() == len(texts)
    assert seen[0] == seen[1] > 0
