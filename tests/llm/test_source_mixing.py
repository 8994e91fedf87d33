"""The mixture's draws against a plain realisation from the same hashes, draw by draw."""

import math
import random
import re
import struct
from collections import defaultdict

import pytest
import xxhash

from screenweave.llm import source_mixing


def hashed(*parts):
    """Spark's xxhash64 of (kind, value) pairs: each is hashed with the one before as seed; nulls leave it as it is."""
    h = 42
    for kind, v in parts:
        if v is not None:
            data = v.encode() if kind == "s" else struct.pack("<i" if kind == "i" else "<q", v)
            h = xxhash.xxh64_intdigest(data, seed=h)
    return h - 2**64 if h >= 2**63 else h


def plain(rows, entropy, repeats, block_tokens, budget=None):
    own, seen = [], defaultdict(int)
    for i, source, text in rows:
        key = (i, source, len(re.findall("[^\x20\x09-\x0d]+", text or "")), hashed(("s", text)))
        seen[key] += 1
        own.append((*key, seen[key]))
    name = lambda s: "" if s is None else f"={s}"
    t = defaultdict(int)
    for r in own:
        t[name(r[1])] += r[2]
    t = {k: v for k, v in t.items() if v}
    total, most = sum(t.values()), max(t.values())
    p = {k: v / total for k, v in t.items()}

    def given(a, z):
        return budget if budget is not None else total * (most / total) ** (1 - a) * z

    def bad(a):
        z = sum(x**a for x in p.values())
        h = -sum(x**a / z * math.log(x**a / z) for x in p.values())
        return len(p) > 1 and h > entropy * math.log(len(p)) + 1e-12 or max(x ** (a - 1) for x in p.values()) / z * given(a, z) / total > repeats * (1 + 1e-12)

    lo, hi = 0.0, 1.0
    if not bad(0.0):
        hi = 0.0
    elif not bad(1.0):
        for _ in range(60):
            mid = (lo + hi) / 2
            lo, hi = (mid, hi) if bad(mid) else (lo, mid)
    z = sum(x**hi for x in p.values())
    out = []
    for k in t:
        weight = p[k] ** hi / z
        quota = math.floor(weight * given(hi, z) + 0.5)
        whole, blocks = quota // t[k], -(-t[k] // block_tokens)
        of = defaultdict(list)
        for i, source, n, h, row in own:
            if name(source) == k:
                of[hashed(("i", source_mixing.SEED), ("l", i), ("l", h), ("i", row)) % blocks].append((i, source, n, h, row))
        for epoch in range(whole + 1):
            before = 0
            order = sorted(of, key=lambda b: (hashed(("i", source_mixing.SEED), ("i", epoch), ("s", k), ("i", b)), b))
            for slot, b in enumerate(order):
                size = sum(r[2] for r in of[b])
                left = size if epoch < whole else min(size, quota - whole * t[k] - before)
                before += size
                if left < 0 or left == 0 and epoch == whole:
                    continue
                used = 0
                for place, (i, source, n, h, row) in enumerate(sorted(of[b], key=lambda r: (hashed(("i", source_mixing.SEED), ("i", epoch), ("l", r[0]), ("l", r[3]), ("i", r[4])), r[0], r[3], r[4]))):
                    used += n
                    if used <= left:
                        out.append((i, source, n, round(weight, 6), epoch, slot, place))
    return out


@pytest.mark.parametrize("entropy,repeats,block_tokens,budget", [(0.95, 4.0, 30, None), (0.7, 3.0, 12, 900), (1.0, 50.0, 1000, None)])
def test_draws_one_by_one(spark, entropy, repeats, block_tokens, budget):
    r = random.Random(7)
    rows = [(k, ["big"] * 7 + ["mid", "mid", "small"], " ".join("w" * r.randint(1, 4) for _ in range(r.randint(1, 15)))) for k in range(90)]
    rows = [(k, r.choice(s), t) for k, s, t in rows] + [(200, None, "a b c"), (201, "mid", ""), (202, "mid", None), (203, "big", "x y"), (203, "big", "x y"), (203, "big", "x y"), (None, "small", "no id here")]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string").repartition(3)
    got = source_mixing.mixed(docs, entropy=entropy, repeats=repeats, block_tokens=block_tokens, budget=budget)
    got = [(x.doc_id, x.source, x.n_tokens, round(x.weight, 6), x.epoch, x.slot, x.place) for x in got.collect()]
    assert sorted(got, key=str) == sorted(plain(rows, entropy, repeats, block_tokens, budget), key=str)
    assert len(got) > 50
