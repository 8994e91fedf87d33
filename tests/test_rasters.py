"""Tiles of rasters against whole planes."""

import numpy as np
import pytest

from screenweave.operators import basecalling, rasters, signals
from screenweave.plans import images

SF = "/root/testdata/sf0.001"
BIG = 1 << 40


def tiles_of(spark, planes, size, keys="k string"):
    rows = []
    for key, plane in planes.items():
        for y in range(0, plane.shape[0], size):
            for x in range(0, plane.shape[1], size):
                part = np.ascontiguousarray(plane[y : y + size, x : x + size])
                rows.append((*np.atleast_1d(key).tolist(), y, x, *part.shape, part.dtype.str, part.tobytes()))
    return spark.createDataFrame(rows, f"{keys}, y0 long, x0 long, h int, w int, dtype string, data binary")


@pytest.fixture(scope="module")
def planes():
    r = np.random.default_rng(1)
    return {k: np.kron(r.integers(0, 9, (7, 6)), np.ones((5, 7), int)) * (BIG if k == "b" else 1) + 0 for k in "ab"}


@pytest.mark.parametrize("limit", [500_000, 7])
def test_values_under_points(spark, planes, monkeypatch, limit):
    monkeypatch.setattr(rasters, "POINTS", limit)
    r = np.random.default_rng(2)
    points = [(k, float(y), float(x), n, "w") for n, (k, y, x) in enumerate(zip(r.choice(["a", "b", "c"], 300), r.uniform(-3, 40, 300), r.uniform(-3, 50, 300)))]
    points += [("a", 1.0, 1.0, 1000 + n, "w") for n in range(40)] + [("a", None, 3.0, 2000, "n"), (None, 1.0, 1.0, 2001, None)]
    df = spark.createDataFrame(points, "k string, y double, x double, id long, h string")  # h: also a tile's column
    got = {x.id: x for x in rasters.gathered(df, tiles_of(spark, planes, 16), ["k"], size=16).collect()}
    assert len(got) == len(points)
    for k, y, x, n, h in points:
        plane = planes.get(k)
        inside = plane is not None and y is not None and 0 <= int(y) < plane.shape[0] and 0 <= int(x) < plane.shape[1] and int(y) >= 0
        assert got[n].value == (plane[int(y), int(x)] if inside else None) and got[n].h == h


def test_planes_under_points(spark):
    r = np.random.default_rng(3)
    cube = {(c, ch): r.uniform(0, 9, (20, 20)).astype(np.float32) for c in (1, 2, 3) for ch in "AC"}
    t = tiles_of(spark, cube, 8, "cycle string, channel string").withColumn("cycle", rasters.F.col("cycle").cast("int"))
    df = spark.createDataFrame([(n, n * 1.7 % 20, n * 2.3 % 23) for n in range(50)], "id long, y double, x double")
    got = {(x.id, x.cycle, x.channel): x.intensity for x in rasters.intensities(df, t, size=8).collect()}
    want = {(n, c, ch): float(p[int(n * 1.7 % 20), int(n * 2.3 % 23)]) for n in range(50) for (c, ch), p in cube.items() if n * 2.3 % 23 < 20}
    assert got == want
    assert "Generate explode(sequence" in rasters.intensities(df, t, size=8)._jdf.queryExecution().executedPlan().toString()  # parts of tiles, never pixels


def dense_stats(plane):
    return {int(v): (y.mean(), x.mean(), len(y), y.min(), x.min(), y.max() + 1, x.max() + 1) for v in np.unique(plane[plane > 0]) for y, x in [np.nonzero(plane == v)]}


def test_labels_by_tiles(spark, planes):
    t = tiles_of(spark, planes, 16)
    got = {(x.k, x.label): (x.y, x.x, x.area, x.min_row, x.min_col, x.max_row, x.max_col) for x in rasters.label_stats(t, ["k"]).collect()}
    want = {(k, v): s for k, p in planes.items() for v, s in dense_stats(p).items()}
    assert set(got) == set(want) and all(np.allclose(got[k], want[k]) for k in want)
    cells = {(x.k, x.row, x.column): x.labels for x in rasters.confluency(t, 10, ["k"]).collect()}
    assert cells == {(k, i, j): len(set(p[10 * i : 10 * i + 10, 10 * j : 10 * j + 10].ravel().tolist()) - {0}) for k, p in planes.items() for i in range(4) for j in range(5)}
    boxes = rasters.boxes_at(spark.createDataFrame([("a", 2.0, 3.0), ("a", 90.0, 500.0), (None, 1.0, 1.0)], "k string, y double, x double"), t, ["k"], 16).collect()
    label = planes["a"][2, 3]
    assert [tuple(b)[-4:] for b in boxes if b.y == 2.0] == [dense_stats(planes["a"])[label][3:] if label else (0, 0, 102, 103)]
    assert [tuple(b)[-4:] for b in boxes if b.y != 2.0 and b.k] == [(0, 400, 190, 600)]


def test_overlaps_by_tiles(spark, planes):
    r = np.random.default_rng(5)
    other = {k: np.where(r.uniform(size=p.shape) < 0.7, p // (BIG if k == "b" else 1) + 100, 0) for k, p in planes.items()}
    other["a"] = other["a"][:20]  # tiles that only one raster has
    got = {(x.k, x.label_a, x.label_b): (x.shared, x.iou) for x in rasters.overlaps(tiles_of(spark, planes, 16), tiles_of(spark, other, 16), 0.05, ["k"]).collect()}
    want = {}
    for k, p in planes.items():
        q = np.zeros_like(p)
        q[: len(other[k])] = other[k]
        for a in np.unique(p[p > 0]):
            for b in np.unique(q[q > 0]):
                n = int(((p == a) & (q == b)).sum())
                iou = n / ((p == a).sum() + (q == b).sum() - n)
                if n and iou > 0.05:
                    want[(k, int(a), int(b))] = (n, iou)
    assert set(got) == set(want) and all(np.allclose(got[k], want[k]) for k in want)


def test_packing_and_empty(spark):
    pixels = spark.createDataFrame([("a", 0, 0, 5), ("a", 33, 2, 2**60 + 1), ("a", 33, 2, 1), ("a", None, 1, 1), (None, 1, 1, 3)], "k string, y long, x long, label long")
    t = rasters.packed(pixels, ["k"], 32)
    assert sorted((str(x.k), x.y0, x.x0, x.h, x.w) for x in t.collect()) == [("None", 0, 0, 2, 2), ("a", 0, 0, 1, 1), ("a", 32, 0, 2, 3)]
    assert {x.label for x in rasters.label_stats(t, ["k"]).collect()} == {5, 2**60 + 1, 3}
    empty = rasters.packed(pixels.limit(0), ["k"], 32)
    assert not rasters.label_stats(empty, ["k"]).collect() and not rasters.overlaps(empty, empty, 0.1, ["k"]).collect()
    assert [x.value for x in rasters.gathered(pixels.select("k", "y", "x").limit(1), empty, ["k"], size=32).collect()] == [None]


def test_base_calls(spark):
    got = {x["read"]: x for x in images.base_calls.__wrapped__(spark, SF).collect()} if hasattr(images.base_calls, "__wrapped__") else {x["read"]: x for x in images.base_calls(images.query.__globals__["Tables"](spark, SF)).collect()}
    li, orders = spark.read.parquet(f"{SF}/lineitem.parquet").toPandas(), spark.read.parquet(f"{SF}/orders.parquet").toPandas()
    cube, cells = {}, np.full((60, 60), 10**9)
    for r in li.itertuples():
        y, x = r.l_partkey % 60, r.l_orderkey % 60
        plane = cube.setdefault((r.l_linenumber, "ACGT"[r.l_suppkey % 4]), np.zeros((60, 60)))
        plane[y, x] = max(plane[y, x], r.l_extendedprice)
        cells[y, x] = min(cells[y, x], r.l_suppkey % 40)
    cells[cells == 10**9] = 0
    cycles = sorted({c for c, _ in cube})
    spots = orders.assign(y=orders.o_custkey % 60, x=orders.o_orderkey % 60)
    spots["tile"] = spots.y // 30 * 2 + spots.x // 30
    for tile, s in spots.groupby("tile"):
        v = np.stack([[cube[(c, ch)][s.y, s.x] for ch in "ACGT"] for c in cycles]).transpose(2, 0, 1)
        inside = cells[s.y, s.x] > 0
        w = basecalling.median_transform(v[inside].reshape(-1, 4))
        fixed = np.trunc(v.reshape(-1, 4) @ w.T).reshape(v.shape)
        for read, values, cell in zip(s.o_orderkey, fixed, cells[s.y, s.x]):
            assert got[read].tile == tile and got[read].cell == cell
            assert got[read].barcode == "".join("ACGT"[k] for k in values.argmax(axis=1))
    assert len(got) == len(spots)


def test_tile_signals(spark):
    r = np.random.default_rng(11)
    cube = {(c, ch): r.uniform(0, 100, (40, 30)).astype(np.float32) for c in (1, 2) for ch in "GT"}
    t = tiles_of(spark, cube, 20, "cycle string, channel string").withColumn("cycle", rasters.F.col("cycle").cast("int"))
    y, x = r.uniform(-2, 41, 60), r.uniform(-2, 31, 60)
    spots = spark.createDataFrame([(k, float(a), float(b)) for k, (a, b) in enumerate(zip(y, x))] + [(99, None, 1.0)], "id long, y double, x double")
    got = {(q.y0, q.x0, q.cycle, q.channel, q.type): q for q in signals.tile_stats(spots, t, size=20, radius=3, width=4).collect()}
    snr = {(q.y0, q.x0, q.cycle, q.channel): q.snr for q in signals.tile_snr(signals.tile_stats(spots, t, size=20, radius=3, width=4)).collect()}
    for (c, ch), plane in cube.items():
        for y0 in (0, 20):
            for x0 in (0, 20):
                tile = plane[y0 : y0 + 20, x0 : x0 + 20].astype(float)
                a, b = np.round(y).astype(int) - y0, np.round(x).astype(int) - x0
                ok = (a >= 0) & (b >= 0) & (a < tile.shape[0]) & (b < tile.shape[1])
                a, b = a[ok], b[ok]
                wide = np.array([[tile[max(i - 2, 0) : i + 2, max(j - 2, 0) : j + 2].max() for j in range(tile.shape[1])] for i in range(tile.shape[0])])
                sig = wide[a, b]
                i, j = np.indices(tile.shape)
                back = tile[np.all([(i - p) ** 2 + (j - q) ** 2 > 9 for p, q in zip(a, b)], axis=0)]
                k = max(1, len(sig) // 10)
                s, n = got[(y0, x0, c, ch, "Signal")], got[(y0, x0, c, ch, "Background")]
                assert np.allclose([s.mean, s.median, s.std, s["count"], s.median_top], [sig.mean(), np.median(sig), sig.std(), len(sig), np.median(np.sort(sig)[-k:])])
                assert np.allclose([n.mean, n.median, n.std, n["count"]], [back.mean(), np.median(back), back.std(), len(back)]) and n.median_top is None
                assert snr[(y0, x0, c, ch)] == pytest.approx(max(0, (sig.mean() - back.mean()) / back.std()))


def test_snr_by_round_across_tiles(spark):
    r = np.random.default_rng(12)
    cube = {(c, ch): r.gamma(2, 50, (50, 50)).astype(np.float32) for c in (1, 2) for ch in "GT"}
    t = tiles_of(spark, cube, 16, "cycle string, channel string").withColumn("cycle", rasters.F.col("cycle").cast("int"))
    at = [(k, float(a), float(b)) for k, (a, b) in enumerate(r.uniform(0, 50, (30, 2)))]
    got = {(q.cycle, q.channel): q for q in signals.snr_by_round(spark.createDataFrame(at, "id long, y double, x double"), t, size=16, samples=100, near=3, around=9).collect()}
    for key, plane in cube.items():
        ratio = []
        for _, a, b in at:
            i, j = int(a), int(b)
            crop = plane[max(i - 9, 0) : i + 9, max(j - 9, 0) : j + 9].astype(float)
            low = crop[crop < np.percentile(crop, 80)]
            ratio.append(plane[max(i - 3, 0) : i + 3, max(j - 3, 0) : j + 3].max() / low.std())
        assert got[key].spots == 30 and got[key].snr == pytest.approx(np.mean(ratio))
    few = signals.snr_by_round(spark.createDataFrame(at, "id long, y double, x double"), t, size=16, samples=7, near=3, around=9)
    assert {q.spots for q in few.collect()} == {7}
