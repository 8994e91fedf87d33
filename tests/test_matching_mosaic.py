"""Matching by shape and neighbourhood, and mosaics."""

import numpy as np
from pyspark.sql import functions as F
from test_operators import tile_rows, whole

from screenweave.operators import matching, mosaic


def shapes():
    out = []
    for h, w in [(3, 9), (6, 6), (2, 12)]:
        m = np.zeros((16, 16))
        m[1 : 1 + h, 2 : 2 + w] = 1
        out.append(m)
    return out


def test_log_moments():
    for m in shapes():
        a, b = matching.log_moments(m), matching.log_moments(np.roll(np.rot90(m), 2, 0))
        assert np.allclose(a[:2], b[:2], atol=1e-6)
    first = [matching.log_moments(m)[0] for m in shapes()]
    assert len({round(x, 3) for x in first}) == 3 and matching.log_moments(np.zeros((3, 3))) == [0.0] * 7


def test_descriptor_match(spark):
    v = [matching.log_moments(m) for m in shapes()]
    a = spark.createDataFrame([(k, 0.0, float(k), v[k]) for k in range(3)], "id int, y double, x double, vector array<double>")
    b = spark.createDataFrame([(10 + k, 0.0, float(2 - k), v[k]) for k in range(3)], "id int, y double, x double, vector array<double>")
    assert sorted((r["id_a"], r["id_b"]) for r in matching.by_descriptor(a, b, 5.0, "vector").collect()) == [(0, 10), (1, 11), (2, 12)]
    z = matching.standardised(a, ["y", "x"]).orderBy("id").collect()
    assert [r["vector"][0] for r in z] == [0.0] * 3 and abs(z[2]["vector"][1] - 1.2247) < 1e-3


def test_graph_match(spark):
    p = np.random.default_rng(0).random((40, 2)) * 100
    a = spark.createDataFrame([(k, float(y), float(x)) for k, (y, x) in enumerate(p)], "id int, y double, x double")
    b = spark.createDataFrame([(k, float(y) + 6, float(x) - 5) for k, (y, x) in enumerate(p)], "id int, y double, x double")
    got = [(r["id_a"], r["id_b"]) for r in matching.graph_consistent(a, b, 30.0, tolerance=0.5).collect()]
    assert sum(x == y for x, y in got) >= 38
    sa, sb = matching.grid_subsample(a, b, 20.0, 2)
    cells = {(int(r["y"] // 20), int(r["x"] // 20)) for r in sa.collect()}
    assert len(cells) == 2 and cells == {(int(r["y"] // 20), int(r["x"] // 20)) for r in sb.collect()}


def test_tilt_fit(spark):
    rows = [("A", float(r), 2 * np.exp(0.03 * r) + 1) for r in range(0, 60, 3)]
    f = matching.tilt_fit(spark.createDataFrame([(k, r, float(z)) for k, r, z in rows], "well string, r double, zenith double"), ["well"]).collect()[0]
    assert abs(f["a"] - 2) < 0.05 and abs(f["b"] - 0.03) < 1e-3 and abs(f["c"] - 1) < 0.1


def test_mosaic(spark):
    image = np.random.default_rng(1).random((20, 20)).astype(np.float32)
    parts = tile_rows(spark, image[:12], 20, tile=0).unionAll(tile_rows(spark, image[8:], 20, tile=1))
    shifts = spark.createDataFrame([(1, 8, 0)], "tile int, dy int, dx int")
    out = mosaic.assembled(mosaic.placed(parts, shifts, ["tile"]).drop("tile"), [], 10)
    assert np.allclose(whole(out, image.shape), image, atol=1e-6)


def test_focus_blank_and_samples(spark):
    v = np.random.default_rng(2).random((8, 8)).astype(np.float32)
    stack = tile_rows(spark, v * 0 + 0.5, 8, z=0).unionAll(tile_rows(spark, v, 8, z=1)).unionAll(tile_rows(spark, v * 0, 8, z=2))
    assert [r["z"] for r in mosaic.best_focus(stack, []).collect()] == [1]
    assert {r["z"]: r["blank"] for r in mosaic.blank(stack, ["z"]).collect()} == {0: False, 1: False, 2: True}
    s = {r["z"]: r for r in mosaic.sampled_stats(stack, ["z"], spacing=1).collect()}
    assert abs(s[1]["mean"] - v.mean()) < 1e-6 and s[None]["n"] == 192 and s[0]["iqr"] == 0
    e = spark.createDataFrame([("A", 0.9), ("A", 0.2), ("A", 0.8)], "well string, confidence double")
    r = mosaic.stitch_confidence(e, ["well"]).collect()[0]
    assert r["median"] == 0.8 and r["sufficient"] and F is not None
