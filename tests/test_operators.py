"""Operators on hand-made cases."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from screenweave.functions import expressions as X
from screenweave.operators import barcodes, basecalling, images, keyed, labels, spatial, stats, tracks


def one(df):
    return df.collect()[0]


def bases(spark, rows):
    out = []
    for read, cell, calls in rows:
        for cycle, base in enumerate(calls, 1):
            out += [("A1", read, cell, cycle, c, 100.0 if c == base else 5.0) for c in "ACGT"]
    return spark.createDataFrame(out, "well string, read int, cell int, cycle int, channel string, intensity double")


def test_base_calling(spark):
    out = {r["cell"]: r for r in basecalling.call_reads(bases(spark, [(1, 1, "AC"), (2, 2, "GT")]), ["well"]).collect()}
    assert out[1]["barcode"] == "AC" and out[2]["barcode"] == "GT"
    assert len(out[1]["Q"]) == 2 and 0 <= out[1]["Q_min"] <= 1
    assert basecalling.call_reads(bases(spark, [(1, 0, "AC")]), ["well"]).count() == 0


def test_base_calling_of_uneven_cycles(spark):
    df = bases(spark, [(1, 1, "AC"), (2, 2, "GT")]).where("NOT (read = 2 AND cycle = 2 AND channel = 'A')")
    assert [r["read"] for r in basecalling.call_reads(df, ["well"]).collect()] == [1]


def test_medians_are_of_all_reads(spark):
    n = 120_000
    bright = F.when(F.col("id") < 50_000, 100.0).otherwise(100.0 + F.col("id"))
    reads = spark.range(n).select(F.lit(1).alias("well"), F.col("id").alias("read"), F.lit(1).alias("cell"), F.array(F.array(bright, F.lit(7.0)), F.array(F.lit(1.0), F.col("id") % 11 + 50.0)).alias("values"))
    extra = spark.createDataFrame([(1, n, 0, [[1e6, 1e6]])], reads.schema)
    got = {r["read"]: r["values"] for r in basecalling.corrected(reads.unionAll(extra), ["well"]).where(f"read IN (0, {n})").collect()}
    x = np.arange(n)
    first, second = np.column_stack([np.where(x < 50_000, 100.0, 100.0 + x), np.full(n, 7.0)]), np.column_stack([np.ones(n), x % 11 + 50.0])
    m = basecalling.median_transform(np.concatenate([first, second]))
    assert got[n] == (m @ np.array([1e6, 1e6])).astype(int).reshape(1, 2).tolist()
    assert got[0] == [(m @ v[0]).astype(int).tolist() for v in (first, second)]


def test_median_transform():
    clean = np.repeat(np.eye(3) * 100, 5, axis=0)
    assert np.allclose(basecalling.median_transform(clean), np.eye(3))
    unseen = np.array([[9.0, 1, 0, 0], [1, 9, 0, 0]])
    assert np.isfinite(basecalling.median_transform(unseen)).all()
    bleed = np.array([[10.0, 5], [0, 10]] * 4)
    m = basecalling.median_transform(bleed)
    assert np.allclose(m @ np.array([10.0, 5]), [15, 0], atol=1e-9)
    assert np.allclose(basecalling.median_transform(np.array([[1.0, 1.0]])), np.linalg.inv([[0.5, 0], [0.5, 1]]))


def test_quality(spark):
    df = spark.createDataFrame([([100.0, 0.0, 0.0, 0.0],), ([7.0, 7.0, 1.0, 0.0],), ([5.0, 3.0, 0.0, 1.0],)], "v array<double>")
    q = [r["q"] for r in df.select(X.base_quality(F.col("v")).alias("q")).collect()]
    assert q[0] == 1.0 and q[1] == 0.0 and 0 < q[2] < 1


def test_mixture():
    r = np.random.default_rng(0)
    w, m, s = basecalling.mixture(np.r_[r.normal(0, 1, 700), r.normal(10, 2, 300)])
    assert abs(w[0] - 0.7) < 0.03 and abs(m[0]) < 0.2 and abs(m[1] - 10) < 0.4 and abs(s[1] - 2) < 0.3


def test_dedupe(spark):
    rows = [(1, "g", "A", 1), (2, None, "N", 2), (3, "g", "A", 3), (3, "h", "B", 4), (4, "g", "A", 5), (4, None, "N", 6), (5, "g", "A", 7), (5, "g", "A", 8), (6, None, None, 9)]
    df = spark.createDataFrame(rows, "seg int, gene string, barcode string, ord int")
    kept = [(r["seg"], r["ord"]) for r in keyed.singlets(df, ["seg"], "barcode", ["ord"]).orderBy("seg").collect()]
    assert kept == [(1, 1), (2, 2), (5, 7)]
    assert tuple(one(keyed.dedupe_report(df, "seg", "barcode", "gene"))) == (3, 2, 1, 1)


@pytest.mark.parametrize(
    "rounds,spec,length,read,code",
    [
        (range(10), [3], 10, [0, 1, 2, 4, 5, 6, 7, 8, 9], [0, 1, 2, 4, 5, 6, 7, 8, 9]),
        (range(10), {"shift": [3]}, 10, range(9), [0, 1, 2, 4, 5, 6, 7, 8, 9]),
        (range(10), [{"round": 2, "mode": "shift"}, {"round": 5, "mode": "shift"}], 10, range(8), [0, 1, 3, 4, 6, 7, 8, 9]),
        (range(10), {"offset": 1}, 10, range(1, 10), range(9)),
        (range(4), None, 3, range(3), range(3)),
    ],
)
def test_round_mapping(rounds, spec, length, read, code):
    m = barcodes.mapping(list(rounds), spec, length)
    assert list(m.read) == list(read) and list(m.code) == list(code)


def test_effective_rounds():
    assert barcodes.effective_rounds([0, 1, 2, 3], [1]) == [0, 2, 3]


def test_projection_and_match(spark):
    reads = spark.createDataFrame([("ACGTA",), ("AC",), (None,), ("TTTTT",), ("0",)], "barcode string")
    got = [r["p"] for r in reads.select(X.project_positions(F.col("barcode"), [0, 2, 7]).alias("p")).collect()]
    assert got == ["AG", "A", None, "TT", "0"]
    codes = spark.createDataFrame([("ACGTT", 1), ("ACGCC", 2)], "sgRNA string, gene int")
    m = barcodes.Mapping((0, 1, 2), (0, 1, 2))
    assert [r["matched"] for r in barcodes.matched(reads, codes, m).collect()].count(True) == 1
    assert sorted(r["gene"] for r in barcodes.annotated(reads, codes, m).collect()) == [1, 2]
    assert tuple(one(barcodes.uniqueness(codes, m))) == (1, 2)
    spiked = spark.createDataFrame([("a", 1.0), ("b", 2.0)], "sgRNA string, ratio double")
    assert [r["sgRNA"] for r in barcodes.spiked_out(spiked).collect()] == ["a"]


def test_entropy_and_mismatches(spark):
    df = spark.createDataFrame([("AACC", "AACG"), ("A", "AB"), ("", "x")], "a string, b string")
    rows = df.select(X.entropy(F.col("a")).alias("h"), X.mismatches(F.col("a"), F.col("b")).alias("d")).collect()
    assert abs(rows[0]["h"] - 1) < 1e-6 and [r["d"] for r in rows] == [1, 0, 0]


def test_well_names_and_boxes(spark):
    df = spark.createDataFrame([("A/1/0", "(1, 2, 11, 32)"), ("B12", "none")], "w string, b string")
    rows = df.select(X.well_key(F.col("w")), X.well_path(F.col("w")), X.bounding_box(F.col("b")).alias("b"), X.box_shape(X.bounding_box(F.col("b")), 10).alias("s")).collect()
    assert rows[0][0] == "A1" and rows[1][1] == "B/12/0" and rows[1]["b"] is None
    s = rows[0]["s"]
    assert (s["height"], s["width"], s["area"], s["is_large"]) == (10, 30, 300, True)
    window = df.limit(1).select(X.box_or_window(F.lit(None).cast("struct<min_row:int,min_col:int,max_row:int,max_col:int>"), F.lit(10), F.lit(990), 100, F.lit(1000), F.lit(1000)).alias("w"))
    assert tuple(one(window)["w"]) == (0, 890, 110, 1000)


def test_affine_drift_and_status(spark):
    df = spark.createDataFrame([(1.0, 2.0)], "y double, x double")
    r = one(df.select(X.affine_point([[0, 1, 5], [1, 0, 0], [0, 0, 1]], F.col("y"), F.col("x")).alias("p"), X.drift(F.lit(3.0), F.lit(4.0)).alias("d")))
    assert tuple(r["p"]) == (7.0, 1.0) and r["d"]["magnitude"] == 5 and abs(r["d"]["angle_deg"] - math.degrees(math.atan2(3, 4))) < 1e-9
    assert X.swapped_axes([[1, 2, 3], [4, 5, 6], [0, 0, 1]]) == [[5, 4, 6], [2, 1, 3], [0, 0, 1]]
    nan = float("nan")
    df = spark.createDataFrame([(1.0, 1.001), (1.0, 2.0), (nan, nan), (None, 1.0), (1.0, None)], "a double, b double")
    assert [r[0] for r in df.select(X.relative_status(F.col("a"), F.col("b"), 0.01)).collect()] == ["pass", "fail", "both_nan", "ref_nan", "cand_nan"]


def test_scalar_odds_and_ends(spark):
    df = spark.range(6)
    got = [tuple(r[0]) for r in df.select(X.snake_position(F.col("id"), 3)).collect()]
    assert got == [(0, 0), (0, 1), (0, 2), (1, 2), (1, 1), (1, 0)]
    assert one(df.select(X.category(F.lit("iss_x"), [("iss_", "iss"), ("snr", "signal")])))[0] == "iss"
    assert one(df.select(X.vector_distance(F.array(F.lit(1.0), F.lit(2.0)), F.array(F.lit(2.0), F.lit(0.0)))))[0] == 3
    assert [r[0] for r in spark.createDataFrame([(1.0,), (float("inf"),), (None,)], "x double").select(X.finite(F.col("x"))).collect()] == [True, False, False]


def test_outliers_of_a_flat_group(spark):
    df = spark.createDataFrame([("a", 1.0)] * 9 + [("a", 50.0)], "g string, v double")
    rows = stats.outliers(df, ["g"], "v", z=2.5).orderBy("v").collect()
    assert [r["is_outlier"] for r in rows] == [False] * 9 + [True] and rows[-1]["direction"] == "HIGH"


def test_right_closed_bins(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (1.1,), (10.0,), (11.0,)], "x double")
    assert [r[0] for r in df.select(stats.right_closed_bin(F.col("x"), F.lit(0.0), F.lit(10.0), 10)).collect()] == [0, 0, 1, 9, None]


def test_rounded_join_is_half_even(spark):
    a = spark.createDataFrame([("w", 0.5, 1.5)], "well string, y double, x double")
    b = spark.createDataFrame([("w", 0.0, 2.0, "first", 1), ("w", 0.2, 2.1, "second", 2)], "well string, y double, x double, name string, ord int")
    assert [r["name"] for r in spatial.rounded_join(a, b, ["well"], ["ord"]).collect()] == ["first"]


def test_tiles_and_first_box(spark):
    g = spatial.tile_grid(spark, 25, 20, 10).orderBy("tile").collect()
    assert [(r["tile"], r["y0"], r["x0"], r["y1"], r["x1"]) for r in g][-1] == (5, 20, 10, 25, 20)
    boxes = spark.createDataFrame([(2, 0.0, 0.0, 10.0, 10.0), (1, 5.0, 5.0, 15.0, 15.0)], "ord int, y0 double, x0 double, y1 double, x1 double")
    pts = spark.createDataFrame([(1, 7.0, 7.0), (2, 10.0, 10.0), (3, 2.0, 2.0), (4, 99.0, 0.0)], "id int, y double, x double")
    assert sorted((r["id"], r["ord"]) for r in spatial.first_box(pts, boxes, [], "id", "ord", 8.0).collect()) == [(1, 1), (2, 1), (3, 2)]
    assert sorted(r["id"] for r in spatial.points_in_boxes(pts, boxes, [], 8.0, strict=True, margin=2.0).collect()) == [1, 2]


def test_labels(spark):
    pairs = spark.createDataFrame([(1, 2), (2, 3), (10, 11), (11, 10), (7, 7)], "a long, b long")
    m = labels.merged(pairs)
    assert {r["label"]: r["root"] for r in m.collect()} == {1: 1, 2: 1, 3: 1, 10: 10, 11: 10, 7: 7}
    assert {r["label"]: r["compact"] for r in labels.compact(m).collect()} == {1: 1, 2: 1, 3: 1, 7: 2, 10: 3, 11: 3}
    px = spark.createDataFrame([(0, 0, 1), (1, 1, 2), (1, 2, 2), (2, 2, 0)], "y int, x int, label int")
    assert sorted({r["label"] for r in spatial.without_border(px, 4, 4).collect()}) == [0, 2]
    at = spark.createDataFrame([(1.9, 1.2), (9.0, 9.0)], "y double, x double")
    assert [r["label"] for r in spatial.label_at(at, px, []).orderBy("y").collect()] == [2, None]


def test_tracks(spark):
    nodes = spark.createDataFrame([(1, 0, 0.0, 0.0, 1), (2, 1, 3.0, 4.0, 1), (3, 1, 0.0, 1.0, None), (4, 2, 3.0, 4.0, 1), (5, 2, 9.0, 9.0, 2)], "id int, t int, y double, x double, tracklet_id int")
    edges = spark.createDataFrame([(1, 2), (1, 3), (2, 4)], "src int, dst int")
    assert tuple(one(tracks.graph_stats(nodes, edges))) == (5, 3, 1, 1, 1)
    moved = tracks.movement(nodes, edges)
    assert sorted(r["distance"] for r in moved.collect()) == [0.0, 1.0, 5.0]
    assert [tuple(r) for r in tracks.full_length(nodes, edges, 3).collect()] == [(1, 2, 4)]
    scored = spark.createDataFrame([(1, 2, 0.9), (1, 3, 0.5), (9, 2, 0.8), (9, 4, 0.1)], "src int, dst int, score double")
    assert [(r["src"], r["dst"]) for r in tracks.greedy_links(scored).collect()] == [(1, 2)]


def tile_rows(spark, image, size, **keys):
    rows = []
    for y in range(0, image.shape[0], size):
        for x in range(0, image.shape[1], size):
            v = np.ascontiguousarray(image[y : y + size, x : x + size], dtype=np.float32)
            rows.append((*keys.values(), y, x, *v.shape, bytearray(v.tobytes())))
    kinds = ", ".join(f"{k} {'int' if isinstance(v, int) else 'string'}" for k, v in keys.items())
    return spark.createDataFrame(rows, f"{kinds}, y0 int, x0 int, h int, w int, pixels binary")


def whole(tiles, shape):
    out = np.zeros(shape, dtype=np.float32)
    for r in tiles.collect():
        out[r["y0"] : r["y0"] + r["h"], r["x0"] : r["x0"] + r["w"]] = images.pixels(r["pixels"], r["h"], r["w"])
    return out


def test_halo_gives_what_the_whole_plane_gives(spark):
    image = np.random.default_rng(1).random((37, 29)).astype(np.float32)
    got = whole(images.with_halo(tile_rows(spark, image, 10, well="A"), ["well"], 10, 3, images.max_filter(7)), image.shape)
    assert np.array_equal(got, images.max_filter(7)(image))
    assert np.array_equal(images.max_filter(3)(image)[5, 5], image[4:7, 4:7].max())


def test_kernels(spark):
    v = np.arange(20, dtype=np.float32).reshape(4, 5)
    assert images.block_mean(2)(v).shape == (2, 3) and images.block_mean(2)(v)[0, 0] == v[:2, :2].mean()
    assert np.array_equal(images.strided(2)(v), v[::2, ::2]) and images.upscaled(3)(v).shape == (12, 15)
    assert np.allclose(images.warped(np.eye(3), v.shape)(v), v)
    moved = images.warped(np.array([[1, 0, 1], [0, 1, 0], [0, 0, 1.0]]), v.shape, 0)(v)
    assert np.array_equal(moved[:3], v[1:]) and (moved[3] == 0).all()
    seed = np.zeros((7, 7))
    seed[3, 3] = 4
    assert (images.dilate(1)(seed) == 4).sum() == 5
    assert np.allclose(images.smoothed(1.0)(np.ones((6, 6))), 1) and images.outside_discs(np.array([[3, 3]]), 1.0)(seed).sum() == 44
    assert np.allclose(images.flatfield(np.full((4, 5), 2.0))(v), v)
    stack = tile_rows(spark, v, 4, z=0).unionAll(tile_rows(spark, v * 3, 4, z=1))
    assert np.array_equal(whole(images.reduced(stack, [], "max"), v.shape), v * 3)
    assert np.allclose(whole(images.reduced(stack, [], "mean"), v.shape), v * 2)
    px = images.to_pixels(tile_rows(spark, v, 3, z=0), ["z"])
    assert sorted((r["y"], r["x"], r["value"]) for r in px.collect()) == [(y, x, float(v[y, x])) for y in range(4) for x in range(5)]
    assert one(images.contrast_limits(px, ["z"], 0.0, 1.0))["high"] == 19


def test_registration(spark):
    r = np.random.default_rng(2)
    a = r.random((32, 32))
    b = np.roll(a, (-3, 5), (0, 1))
    assert images.shift_between(a, b) == (3, -5)
    rounds = tile_rows(spark, a, 32, well="A", round=0).unionAll(tile_rows(spark, b, 32, well="A", round=1))
    assert sorted((x["round"], x["dy"], x["dx"]) for x in images.tile_shifts(rounds, ["well"], "round").collect()) == [(0, 0, 0), (1, 3, -5)]
    pts = r.random((60, 2)) * 100
    m = np.array([[0.9, 0.1, 4], [-0.1, 1.1, -7], [0, 0, 1]])
    target = (np.c_[pts, np.ones(60)] @ m.T)[:, :2]
    target[:15] += r.random((15, 2)) * 50 + 10
    found, inside = images.ransac_affine(pts, target)
    assert np.allclose(found, m, atol=1e-6) and inside.sum() == 45
    assert np.array_equal(images.ransac_affine(pts[:2], target[:2])[0], np.eye(3))
    mask = np.zeros((80, 80), dtype=bool)
    mask[20:40, 30:50] = True
    assert images.refine_translation(mask, np.roll(mask, (-12, 16), (0, 1)))[:2] == (12, -16)


def test_assignment_against_brute_force():
    import itertools

    r = np.random.default_rng(3)
    for shape in [(1, 1), (3, 3), (2, 5), (5, 2), (4, 6)]:
        for _ in range(10):
            s = r.random(shape)
            n, m = min(shape), max(shape)
            t = s if shape[0] <= shape[1] else s.T
            best = max(sum(t[k, p[k]] for k in range(n)) for p in itertools.permutations(range(m), n))
            got = images.assignment(s)
            assert abs(sum(s[p] for p in got) - best) < 1e-9 and len({a for a, _ in got}) == len({b for _, b in got}) == n


def test_detection_scores(spark):
    pairs = spark.createDataFrame([("w", 1, 1, 0.9), ("w", 1, 2, 0.3), ("w", 2, 2, 0.6)], "well string, label_a int, label_b int, iou double")
    rows = images.detection_scores(pairs, ["well"], truths=3, predictions=2, thresholds=[0.5, 0.75]).orderBy("threshold").collect()
    assert [(r["tp"], r["fp"], r["fn"]) for r in rows] == [(2, 0, 1), (1, 1, 2)]


def test_crops(spark):
    image = np.ones((20, 20), dtype=np.float32)
    image[0, :] = 0
    cells = spark.createDataFrame([(1, 10.0, 10.0), (2, 1.0, 10.0), (3, 2.0, 10.0)], "id int, y double, x double")
    assert sorted(r["id"] for r in images.crops(tile_rows(spark, image, 20, well="A").drop("well"), cells, [], 2).collect()) == [1]


def test_hopkins():
    r = np.random.default_rng(5)
    assert abs(images.hopkins(r.random((400, 2))) - 0.5) < 0.1
    assert images.hopkins(np.repeat(r.random((4, 2)), 100, axis=0) + r.normal(0, 1e-3, (400, 2))) > 0.85


def test_samples_are_exact(spark):
    df = spark.range(1000).withColumn("s", F.col("id") % 3)
    for n in (1, 10, 999):
        assert keyed.stratified_sample(df, "s", F.xxhash64("id"), n).count() == n
    random.seed(1)
    assert keyed.sample(df.repartition(7), F.xxhash64("id"), 5).collect() == keyed.sample(df, F.xxhash64("id"), 5).collect()


def test_bias_rule(spark):
    df = spark.createDataFrame([(-60.0, 0.5, 20), (-1.0, 0.01, 20), (-1.0, 0.5, 20), (-60.0, 0.0, 5)], "s double, p double, n int")
    assert [r[0] for r in df.select(stats.low_entropy_bias(F.col("s"), F.col("p"), F.col("n"))).collect()] == [True, True, False, None]


def test_near_codes_against_all_pairs(spark):
    import random

    r = random.Random(4)
    word = lambda n: "".join(r.choices("ACGT", k=n))
    codes = [word(10) for _ in range(40)] + [word(7) for _ in range(5)] + [None, ""]
    reads = [c for c in codes[:20]] + ["".join(x if r.random() > 0.15 else r.choice("ACGT") for x in c) for c in codes[:40] for _ in range(4)] + [word(10) for _ in range(40)] + [None, "", "A"]
    a, b = spark.createDataFrame([(x,) for x in reads], "barcode string"), spark.createDataFrame([(x,) for x in codes], "sgRNA string")
    off = lambda x, y: sum(p != q for p, q in zip(x, y))
    for most in (0, 1, 2, 3):
        got = {x.barcode: (x.rows, x.distance, x.codes) for x in barcodes.near_codes(a, b, most).collect()}
        want = {}
        for x in {x for x in reads if x is not None}:
            d = [off(x, c) for c in {c for c in codes if c is not None} if len(c) == len(x)]
            least = min(d, default=99)
            want[x] = (reads.count(x), least, d.count(least)) if least <= most else (reads.count(x), None, 0)
        assert got == want


def test_members_by_digest(spark):
    rows = [("a", "b"), ("a\x00", "b"), ("a", "\x00b"), ("a\\", "b"), ("", "ab"), ("ab", ""), (None, "b"), ("a", None), ("a", "b")]
    df = spark.createDataFrame([(k, *x) for k, x in enumerate(rows)], "k int, x string, y string")
    for k, pair in enumerate(rows):
        got = sorted(r.k for r in keyed.members(df, df.where(df["k"] == k), ["x", "y"]).collect())
        assert got == ([] if None in pair else [j for j, x in enumerate(rows) if x == pair])
