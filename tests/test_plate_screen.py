"""Plate statistics, linking, reports, tests of significance and array sources, against hand-made cases and brute force."""

import itertools
import json
import math
import random
import struct
import zlib

import numpy as np
import pyarrow as pa
import pytest
import zstandard
from pyspark.sql import functions as F

from screenweave.operators import keyed, plate, screen, stats
from screenweave.sources import arrays


def student_by_integral(t, df, steps=20_000):
    """Two-sided p: the share of the cosine's power beyond the angle of t."""
    a = math.atan(abs(t) / math.sqrt(df))
    area = lambda lo: np.trapezoid(np.cos(np.linspace(lo, math.pi / 2, steps)) ** (df - 1), dx=(math.pi / 2 - lo) / (steps - 1))
    return area(a) / area(0.0)


def test_tail_probabilities(spark):
    rows = [(t, df) for t in (0.0, 0.1, 1.0, -2.5, 6.0, 30.0) for df in (1, 2, 3, 10, 57, 400)]
    for r in spark.createDataFrame(rows, "t double, df int").withColumn("p", stats.student_p(F.col("t"), F.col("df"))).collect():
        want = student_by_integral(r["t"], r["df"])
        assert abs(r["p"] - want) < 1e-7 + 1e-5 * want, r
    zs = [0.0, 1e-6, 0.5, 1.96, -2.9, 3.0, 3.1, 5.0, 8.0, 20.0]
    for r in spark.createDataFrame([(z,) for z in zs], "z double").withColumn("p", stats.normal_p(F.col("z"))).collect():
        want = math.erfc(abs(r["z"]) / math.sqrt(2))
        assert abs(r["p"] - want) <= 1e-12 + 1e-9 * want, r


def test_correlations_of_constant_sides(spark):
    df = spark.createDataFrame([("a", 1.0, float(k), 2.0 * k) for k in range(8)] + [("b", float(k), float(k * k), 1.0) for k in range(8)] + [("c", None, 1.0, 1.0)], "g string, x double, y double, z double")
    got = {r["g"]: r for r in stats.regression(df, "x", "y", ["g"]).collect()}
    assert got["a"]["r"] is None and got["a"]["p_value"] is None and got["b"]["p_value"] < 1e-3 and got["c"]["n"] == 0
    assert stats.partial_correlation(df.where("g = 'a'"), "y", "z", "x").first()[0] is None
    assert stats.partial_correlation(df.where("g = 'b'"), "x", "x", "x").first()[0] is None
    assert {r["g"]: r["rho"] for r in stats.spearman(df, "x", "z", ["g"]).collect()} == {"a": None, "b": None}
    assert stats.rank_by_correlation(df, ["x", "z"], "y").count() == 2
    assert stats.block_variation(df.withColumn("v", F.lit(0.0)), ["g"], "v").where("cv is null").count() == 3
    assert stats.mann_whitney(df.where("g <> 'c'"), "z", "g", "a").first()["p_value"] is not None
    assert stats.mann_whitney(df.where("g = 'b'"), "z", "g", "a").first()["p_value"] is None
    assert keyed.top_share(df.withColumn("v", F.lit(0)), "v", 2).first()[0] is None


def test_ranks_against_brute_force(spark):
    r = random.Random(3)
    values = [r.choice([None, 0.0, -0.5, 1e-300, -1e300, 7.0, float(r.randint(-40, 40)), r.gauss(0, 1e6)]) for _ in range(400)] + [float("inf"), float("nan")]
    rows = [(k, "ab"[k % 2] if k % 7 else None, v) for k, v in enumerate(values)]
    got = {x["i"]: x["rank"] for x in stats.average_ranks(spark.createDataFrame(rows, "i int, g string, v double"), "v", ["g"]).collect()}
    key = lambda v: (math.isnan(v), v)
    for i, g, v in rows:
        if v is None:
            assert got[i] is None
            continue
        others = [key(w) for _, h, w in rows if h == g and w is not None]
        small, same = sum(o < key(v) for o in others), sum(o == key(v) or (math.isnan(v) and o[0]) for o in others)
        assert got[i] == small + (same + 1) / 2


def test_rank_tests_against_brute_force(spark):
    r = random.Random(5)
    rows = [("a" if r.random() < 0.4 else "b", float(r.randint(0, 12))) for _ in range(150)]
    m = stats.mann_whitney(spark.createDataFrame(rows, "g string, v double"), "v", "g", "a").first()
    a, b = [v for g, v in rows if g == "a"], [v for g, v in rows if g == "b"]
    u = sum((x > y) + 0.5 * (x == y) for x in a for y in b)
    n = len(rows)
    ties = sum(c**3 - c for c in np.unique([v for _, v in rows], return_counts=True)[1].tolist())
    sd = math.sqrt(len(a) * len(b) / 12 * (n + 1 - ties / (n * (n - 1))))
    assert m["u"] == u and (m["n1"], m["n2"]) == (len(a), len(b))
    assert abs(m["p_value"] - math.erfc((abs(u - len(a) * len(b) / 2) - 0.5) / sd / math.sqrt(2))) < 1e-10
    plan = stats.mann_whitney(spark.createDataFrame(rows, "g string, v double"), "v", "g", "a")._jdf.queryExecution().optimizedPlan().toString()
    assert "rank(" not in plan


def test_samples_and_top_shares(spark):
    rows = [(k, "abc"[k % 3] if k else None) for k in range(300)]
    got = keyed.stratified_sample(spark.createDataFrame(rows, "i int, s string"), "s", F.md5(F.col("i").cast("string")), 20).collect()
    assert len(got) == 20 and keyed.stratified_sample(spark.createDataFrame(rows, "i int, s string"), "s", F.md5(F.col("i").cast("string")), 0).count() == 0
    v = spark.createDataFrame([("x", float(k)) for k in range(25)] + [("x", None), ("y", 3.0)], "g string, v double")
    assert {r["g"]: r["median_top"] for r in stats.top_decile_median(v, ["g"], "v").collect()} == {"x": 23.5, "y": 3.0}


def test_well_statistics_by_hand(spark):
    reads = [("A", 1, "AC"), ("A", 1, "AG"), ("A", 2, "AC"), ("A", 0, "AC"), ("A", 3, "XX"), ("A", None, "AC"), ("B", 5, "XX")]
    codes = [("AC", "g1"), ("AG", "g2"), ("TT", None)]
    extra = spark.createDataFrame([("A", 1.5)], "well string, drift double")
    out = plate.well_statistics(spark.createDataFrame(reads, "well string, cell int, barcode string"), spark.createDataFrame(codes, "barcode string, gene string"), spark.createDataFrame([("A", 4), ("B", 0), ("C", 9)], "well string, num_cells int"), spark.createDataFrame([("A", 7)], "well string, num_spots int"), (extra,))
    a, b, c = out.orderBy("well").collect()
    assert (a["cells_with_reads"], a["cells_with_matched_reads"], a["num_reads"], a["num_reads_matched"], a["num_unique_reads"], a["num_codes"], a["num_spots"]) == (3, 2, 6, 5, 2, 3, 7)
    assert (a["percent_cells_with_reads"], a["percent_cells_with_matched_reads"], a["percent_codes_found"], a["fraction_doublets"], a["avg_guide_coverage"], a["avg_guide_coverage_inc_dropouts"], a["drift"]) == (75.0, 50.0, 66.667, 0.25, 2.0, 2.0, 1.5)
    assert (a["iss_mean_cells_per_gene"], a["iss_max_cells_per_gene"], a["iss_min_cells_per_gene"]) == (2.0, 3, 1)
    assert (b["num_reads"], b["percent_cells_with_reads"], b["iss_median_cells_per_gene"]) == (1, 0.0, 0.0)
    assert (c["num_reads"], c["cells_with_reads"], c["fraction_doublets"], c["drift"]) == (0, 0, 0.0, None)


def test_growth_effect_by_hand(spark):
    rows = [("a", -1 + 0.1 * k, 100 - 10 * k) for k in range(11)] + [("b", 0.3, 5), ("c", None, 1)]
    got = {r["g"]: r for r in plate.growth_effect(spark.createDataFrame(rows, "g string, x double, n int"), ["g"], "x", "n").collect()}
    x, y = np.array([r[1] for r in rows[:11]]), np.array([r[2] for r in rows[:11]])
    edges = np.linspace(x.min(), x.max(), 10)
    mids, meds = [], []
    for lo, hi in zip(edges[:-1], edges[1:]):
        inside = (x > lo + 1e-12) & (x <= hi + 1e-12)
        if inside.any():
            mids.append((lo + hi) / 2)
            meds.append(np.median(y[inside]))
    slope, cut = np.polyfit(mids, meds, 1)
    assert got["a"]["growth_effect_slope"] == round(slope, 1)
    assert abs(got["a"]["growth_effect_fold_change"] - (cut + slope * mids[-1]) / (cut + slope * mids[0])) < 0.006
    assert (got["b"]["growth_effect_slope"], got["b"]["growth_effect_r2"]) == (0.0, 0.0) and "c" not in got


def test_match_validation_finds_a_bias(spark):
    codes = spark.createDataFrame([("AAAA", "g0"), *[("".join(p), f"g{p[0]}") for p in itertools.permutations("ACGT")]], "barcode string, gene string")
    clean = [("w", r[0]) for r in codes.collect() if r[0] != "AAAA" for _ in range(40)]
    biased = [("v", b) for _, b in clean] + [("v", "AAAA")] * 2000
    got = {r["well"]: r for r in plate.match_validation(spark.createDataFrame(clean + biased, "well string, barcode string"), codes, ["well"], 4).collect()}
    assert got["w"]["is_valid"] and not got["v"]["is_valid"]
    assert (got["v"]["top_barcode"], got["v"]["top_barcode_entropy"] < 1e-6, got["v"]["top_barcode_count"]) == ("AAAA", True, 2000)
    assert got["w"]["top5_concentration"] == 100.0 and got["w"]["unique_genes"] == 4


def test_linking_by_hand(spark):
    tracks = spark.createDataFrame([("A", k, 10 * k) for k in range(5)], "well string, og_index int, t0 int")
    iss = spark.createDataFrame([("A", 0, "ACGT"), ("A", 1, "0"), ("A", 2, None), ("A", 3, "ACTT")], "well string, og_index int, barcode string")
    pheno = spark.createDataFrame([("A", 0, 7), ("A", 3, None), ("A", 4, 9)], "well string, og_index int, segmentation_id int")
    genes = spark.createDataFrame([("XACG", "g1"), ("XACT", "g2"), ("YACT", "g3")], "barcode string, gene string")
    out = plate.linked(tracks, iss, pheno, genes, [0, 1, 2], [1, 2, 3])
    assert sorted((r["og_index"], r["t0"], r["gene"]) for r in out.collect()) == [(0, 0, "g1"), (3, 30, "g2"), (3, 30, "g3")]
    m = plate.link_metrics(tracks, iss, pheno, out).first().asDict()
    assert m == {"well": "A", "full_length_tracks": 5, "iss_linked": 4, "iss_linked_with_barcode": 2, "pheno_linked": 3, "iss_only": 2, "pheno_only": 1, "iss_pheno_matched": 2, "tracks_with_gene_matched": 3, "valid_segmentation": 1, "fallback_bbox": 2}
    base = spark.createDataFrame([(1, "0"), (2, "C"), (3, None)], "k int, barcode string")
    sides = {"iss": spark.createDataFrame([(1, "A", 5)], "k int, barcode string, n int"), "cp": spark.createDataFrame([(1, "B"), (3, "0")], "k int, barcode string")}
    assert {r["k"]: r["barcode"] for r in plate.composite_link(base, sides, "k").collect()} == {1: "A", 2: "C", 3: None}


def test_reports_by_hand(spark):
    pairs = spark.createDataFrame([("A", "round0_round1", 0.5, 1.0, 3.0), ("A", "round1_round2", 0.7, 2.0, 4.0), ("A", "nucleus", 0.0, 9.0, 99.0)], "well string, round_pair string, inlier_ratio double, residual_mean double, residual_max double")
    assert tuple(plate.cycle_registration(pairs, ["well"]).first()) == ("A", 0.6, 0.5, 1.5, 4.0, 2)
    passed = spark.createDataFrame([(9.0, None), (8.0, None), (8.0, 31.0), (50.0, 14.0), (8.0, 20.0), (None, None)], "c double, m double")
    assert [r[0] for r in passed.select(plate.registration_passed(F.col("c"), F.col("m"))).collect()] == [True, False, True, False, False, False]
    dates = spark.createDataFrame([("x_20240102",), ("a_20230501",), ("none",)], "experiment string")
    assert [r["experiment"] for r in plate.by_date(dates).collect()] == ["a_20230501", "x_20240102", "none"]
    direction = plate.pooled_direction(spark.createDataFrame([(1, [3.0, 0.0]), (3, [0.0, 4.0]), (9, [1.0, 1.0, 1.0])], "n int, mean array<double>"))
    assert np.allclose([r["direction"] for r in direction.orderBy("dim").collect()], np.array([0.75, 3.0]) / np.hypot(0.75, 3.0))


def test_screen_selections(spark):
    df = spark.range(100).withColumnRenamed("id", "index")
    inner = [r[0] for r in screen.centre_positions(df, 10, 100, 4).collect()]
    assert len(set(inner)) == 10 and inner == [r[0] for r in screen.centre_positions(df.repartition(5), 10, 100, 4).collect()]
    assert screen.centre_positions(df, 200, 100, 4).count() == 100
    far = lambda i: math.hypot(i // 10 - 5, (9 - i % 10 if i // 10 % 2 else i % 10) - 5)
    assert max(map(far, inner)) <= sorted(map(far, range(100)))[49]
    even = sorted(r[0] for r in screen.evenly_spaced(df, 24, "index").collect())
    assert len(even) == 24 and even[0] == 0 and even[-1] == 99 and max(np.diff(even)) - min(np.diff(even)) <= 1
    assert screen.evenly_spaced(df.limit(5), 24, "index").count() == 5
    assert screen.confident(df).count() == 0
    assert screen.cells_of(spark.createDataFrame([(k, "g" if k % 2 else "h", f"s{k % 3}") for k in range(40)], "cell int, gene string, sgRNA string"), "g", 5, 1).count() == 5


def test_screen_conversions(spark):
    xs = [0.0, 1234.5678, 0.00123456, -0.5, 99.96, 12.0, None]
    got = [r[0] for r in spark.createDataFrame([(x,) for x in xs], "x double").select(screen.significant(F.col("x"), 3)).collect()]
    assert got == ["0", "1235", "0.00123", "-0.500", "100.0", "12.0", None]
    df = spark.createDataFrame([(1.0, 0.5, None, 1.0), (2.0, 1.0, None, None)], "a double, b double, c double, d double")
    assert dict(screen.unified_integers(df).dtypes) == {"a": "bigint", "b": "double", "c": "double", "d": "bigint"}
    n = spark.createDataFrame([("ops0033",), ("op0072_x",), ("ops0000",), ("abc",), (None,)], "e string")
    assert [r[0] for r in n.select(screen.experiment_number(F.col("e"))).collect()] == [33, 72, 0, None, None]
    assert screen.regrouped(df, ["d", "zz"], ["a"]).columns == ["d", "b", "c", "a"]
    over = screen.overridden(spark.createDataFrame([("x", {"a": "1", "b": "2"}), ("y", None)], "e string, settings map<string,string>"), spark.createDataFrame([("x", {"b": "3", "c": "4"})], "e string, settings map<string,string>"), "e")
    assert {r["e"]: r["settings"] for r in over.collect()} == {"x": {"a": "1", "b": "3", "c": "4"}, "y": {}}


def test_screen_registrations(spark):
    r = np.random.default_rng(4)
    ms = [np.vstack([r.normal(size=(2, 3)), [0, 0, 1]]) for _ in range(4)]
    df = spark.createDataFrame([("w", k, m.tolist()) for k, m in enumerate(ms)], "well string, round int, m array<array<double>>")
    got = {x["round"]: np.array(x["m"]) for x in screen.composed(df, ["well"], "round").collect()}
    want = np.eye(3)
    for k, m in enumerate(ms):
        want = m @ want
        assert np.allclose(got[k], want)
    turned = lambda deg, s, y, x: [[s * math.cos(math.radians(deg)), -s * math.sin(math.radians(deg)), y], [s * math.sin(math.radians(deg)), s * math.cos(math.radians(deg)), x], [0.0, 0.0, 1.0]]
    two = spark.createDataFrame([(turned(10, 2.0, 1.0, 2.0), turned(25, 3.0, 4.0, 6.0))], "a array<array<double>>, b array<array<double>>")
    d = two.select(screen.affine_difference(F.col("a"), F.col("b")).alias("d")).first()["d"]
    assert np.allclose(tuple(d), (5.0, 15.0, 50.0, 4.0, 9.0))


# Array sources


def blosc_by_hand(data, width, block, compressor, shuffle=True, split=True):
    number = {"lz4": 1, "zlib": 3, "zstd": 4}[compressor]
    press = {"lz4": lambda d: pa.Codec("lz4_raw").compress(d, asbytes=True), "zlib": zlib.compress, "zstd": zstandard.ZstdCompressor().compress}[compressor]
    blocks, starts, at = [], [], 16 + 4 * -(-len(data) // block)
    for k in range(0, len(data), block):
        part = data[k : k + block]
        if shuffle:
            n = len(part) // width
            part = np.frombuffer(part[: n * width], np.uint8).reshape(n, width).T.tobytes() + part[n * width :]
        pieces = width if split and len(part) == block else 1
        size = len(part) // pieces
        out = b""
        for j in range(pieces):
            raw = part[j * size : (j + 1) * size]
            packed = press(raw)
            packed = raw if len(packed) >= len(raw) else packed
            out += struct.pack("<I", len(packed)) + packed
        starts.append(at)
        blocks.append(out)
        at += len(out)
    body = struct.pack(f"<{len(starts)}I", *starts) + b"".join(blocks)
    return bytes([2, 1, (1 if shuffle else 0) | (0 if split else 16) | number << 5, width]) + struct.pack("<III", len(data), block, 16 + len(body)) + body


@pytest.mark.parametrize("compressor", ["lz4", "zlib", "zstd"])
def test_blosc_containers(compressor):
    for n, block, shuffle, split in ((1000, 256, True, True), (1003, 512, True, False), (64, 64, False, True), (7, 64, True, True)):
        data = (np.arange(n) // 5 % 251).astype(np.uint8).tobytes()
        assert arrays.blosc(blosc_by_hand(data, 4, block, compressor, shuffle, split)) == data
    stored = bytes([2, 1, 2, 1]) + struct.pack("<III", 5, 5, 21) + b"hello"
    assert arrays.blosc(stored) == b"hello"


def read_planes(df, shape):
    out = np.full(shape, -1.0)
    for r in df.collect():
        out[(*r["index"], slice(r["y0"], r["y0"] + r["h"]), slice(r["x0"], r["x0"] + r["w"]))] = np.frombuffer(r["pixels"], np.float32).reshape(r["h"], r["w"])
    return out


def test_zarr_version_3_with_shards(spark, tmp_path):
    arrays.register(spark)
    data = np.arange(2 * 9 * 10, dtype=">u2").reshape(2, 9, 10)
    plain, sharded = tmp_path / "p.zarr/plain", tmp_path / "p.zarr/sharded"
    meta = {"zarr_format": 3, "node_type": "array", "shape": [2, 9, 10], "data_type": "uint16", "fill_value": 7, "chunk_key_encoding": {"name": "default", "configuration": {"separator": "/"}}}
    inner = [{"name": "transpose", "configuration": {"order": [2, 1, 0]}}, {"name": "bytes", "configuration": {"endian": "big"}}, {"name": "zstd"}]
    plain.mkdir(parents=True)
    sharded.mkdir()
    (plain / "zarr.json").write_text(json.dumps(meta | {"chunk_grid": {"name": "regular", "configuration": {"chunk_shape": [1, 4, 6]}}, "codecs": inner}))
    shard = {"name": "sharding_indexed", "configuration": {"chunk_shape": [1, 2, 3], "codecs": inner, "index_codecs": [{"name": "bytes"}, {"name": "crc32c"}]}}
    (sharded / "zarr.json").write_text(json.dumps(meta | {"chunk_grid": {"name": "regular", "configuration": {"chunk_shape": [1, 4, 6]}}, "codecs": [shard]}))
    want = data.astype(float)

    def cut(c, y, x, h, w):
        full = np.full((1, h, w), 7, dtype=">u2")
        part = data[c : c + 1, y : y + h, x : x + w]
        full[:, : part.shape[1], : part.shape[2]] = part
        return zstandard.ZstdCompressor().compress(full.transpose(2, 1, 0).tobytes())

    for c in range(2):
        for y in range(3):
            for x in range(2):
                if (c, y, x) != (0, 1, 1):
                    (plain / f"c/{c}/{y}").mkdir(parents=True, exist_ok=True)
                    (plain / f"c/{c}/{y}/{x}").write_bytes(cut(c, 4 * y, 6 * x, 4, 6))
                body, index = b"", b""
                for i in range(2):
                    for j in range(2):
                        if (c, y, x) == (0, 1, 1):
                            index += struct.pack("<QQ", 2**64 - 1, 2**64 - 1)
                        else:
                            piece = cut(c, 4 * y + 2 * i, 6 * x + 3 * j, 2, 3)
                            index += struct.pack("<QQ", len(body), len(piece))
                            body += piece
                (sharded / f"c/{c}/{y}").mkdir(parents=True, exist_ok=True)
                (sharded / f"c/{c}/{y}/{x}").write_bytes(body + index + b"crc!")
    want[0, 4:8, 6:] = 7
    for name in ("plain", "sharded"):
        df = spark.read.format("zarr").option("arrays", name)
        assert np.array_equal(read_planes(df.load(str(tmp_path / "p.zarr")), want.shape), want)
        got = read_planes(df.option("window", "3,6,2,9").option("index", "[[1]]").load(str(tmp_path / "p.zarr")), want.shape)
        assert np.array_equal(got[1, 3:6, 2:9], want[1, 3:6, 2:9])
        got[1, 3:6, 2:9] = -1
        assert (got == -1).all()


def column(folder, values, dtype="<f8", strings=False):
    folder.mkdir(parents=True)
    shape = list(np.shape(values))
    meta = {"zarr_format": 2, "shape": shape, "chunks": [3, *shape[1:]], "dtype": "|O" if strings else dtype, "order": "C", "compressor": {"id": "blosc"}, "fill_value": 0, "filters": [{"id": "vlen-utf8"}] if strings else None}
    (folder / ".zarray").write_text(json.dumps(meta))
    for k in range(-(-shape[0] // 3)):
        part = list(values[3 * k : 3 * k + 3])
        if strings:
            part += [""] * (3 - len(part))
            raw = struct.pack("<I", 3) + b"".join(struct.pack("<I", len(s.encode())) + s.encode() for s in part)
        else:
            full = np.zeros((3, *shape[1:]), dtype)
            full[: len(part)] = part
            raw = full.tobytes()
        (folder / ".".join(map(str, [k] + [0] * (len(shape) - 1)))).write_bytes(blosc_by_hand(raw, 1 if strings else np.dtype(dtype).itemsize, max(len(raw), 8), "lz4"))


def test_track_graphs_and_observations(spark, tmp_path):
    arrays.register(spark)
    g = tmp_path / "t.geff"
    column(g / "nodes/ids", [5, 6, 7, 8], "<u8")
    column(g / "nodes/props/t/values", [0, 1, 1, 2], "<i4")
    column(g / "nodes/props/y/values", [0.5, 1.5, 2.5, 3.5])
    column(g / "edges/ids", [[5, 6], [5, 7], [7, 8]], "<u8")
    nodes, edges = arrays.track_graph(spark, str(g), ["t", "y"])
    assert sorted(map(tuple, nodes.collect())) == [(5, 0.0, 0.5), (6, 1.0, 1.5), (7, 1.0, 2.5), (8, 2.0, 3.5)]
    assert sorted(map(tuple, edges.collect())) == [(5, 6), (5, 7), (7, 8)]
    a = tmp_path / "a.zarr"
    column(a / "obs/score", [1.0, 2.5, 3.0, 4.0])
    column(a / "obs/gene/codes", [0, 1, -1, 0], "<i1")
    column(a / "obs/gene/categories", ["NTC", "ÄB"], strings=True)
    got = arrays.observations(spark, str(a), ["score", "gene"]).orderBy("row").collect()
    assert [tuple(r) for r in got] == [(0, "1", "NTC"), (1, "2.5", "ÄB"), (2, "3", None), (3, "4", "NTC")]


def test_cumulative_transforms(spark, tmp_path):
    from screenweave.sources import tables

    for name, shift in (("round1", 5), ("nuclei", 2)):
        (tmp_path / f"{name}_cumulative.json").write_text(json.dumps({"affine_transform_zyx": [[1, 0, 0, 9], [0, 1, 0, shift], [0, 0, 2, 1], [0, 0, 0, 1]]}))
    got = {r["key"]: np.array(r["inverse"]) for r in tables.cumulative_transforms(spark, f"{tmp_path}/*_cumulative.json").collect()}
    assert set(got) == {"1", "-1"} and np.allclose(got["1"], np.linalg.inv([[1, 0, 5], [0, 2, 1], [0, 0, 1]]))
    pytest.importorskip("yaml")
    (tmp_path / "c.yaml").write_text("a: [1, 2]\nb: {c: x}\n")
    assert tables.read_config(spark, f"{tmp_path}/c.yaml") == {"a": [1, 2], "b": {"c": "x"}}


def test_track_links(spark):
    tracks = spark.createDataFrame([("A", 0, 1.0, 2.0), ("A", 1, 4.0, 4.0), ("A", 2, 90.0, 90.0)], "well string, og_index int, y double, x double")
    shift = [[1.0, 0.0, 1.0], [0.0, 1.0, 0.0], [0.0, 0.0, 1.0]]
    pixels = spark.createDataFrame([("A", 2, 2, 7), ("A", 5, 4, 8)], "well string, y int, x int, label int")
    reads = spark.createDataFrame([("A", 7, "AC", 1), ("A", 7, "AG", 2), ("A", 0, "TT", 3)], "well string, cell int, barcode string, k int")
    got = {r["og_index"]: (r["y_iss"], r["barcode"]) for r in plate.track_reads(tracks, shift, pixels, reads, "k").collect()}
    assert got == {0: (2.0, "AG"), 1: (5.0, "0"), 2: (91.0, "0")}
    boxes = spark.createDataFrame([("A", "t0", 0.0, 0.0, 4.0, 4.0), ("A", "t1", 0.0, 3.0, 8.0, 8.0)], "well string, tile string, y0 double, x0 double, y1 double, x1 double")
    got = {r["og_index"]: (r["tile_pheno"], r["y_local_pheno"], r["x_local_pheno"]) for r in plate.track_tiles(tracks, shift, boxes, 4.0, "pheno").collect()}
    assert got == {0: ("t0", 2.0, 2.0), 1: ("t1", 5.0, 1.0), 2: (None, None, None)}
    long = spark.createDataFrame([("A", 0, 1, 1.0, 3.5), ("A", 0, 2, 7.0, 4.0), ("A", 1, 1, 50.0, 50.0)], "well string, og_index int, t int, y double, x double")
    got = {r["og_index"]: tuple(r)[2:] for r in plate.track_times(long, boxes, [1, 2], 4.0).collect()}
    assert got == {0: ("t0", 3, 1, "t1", 1, 7), 1: (None,) * 6}


def test_validation_leaves_designed_controls_out(spark):
    import random

    r = random.Random(5)
    codes = sorted({"".join(r.choices("ACGT", k=10)) for _ in range(40)})
    book = spark.createDataFrame([(c, f"g{k % 9}", 1.0) for k, c in enumerate(codes)] + [("A" * 10, "-1", 5.0)], "barcode string, gene string, ratio double")
    rows = [("w", c) for k, c in enumerate(codes) for _ in range(20 + k % 5)] + [("w", "A" * 10)] * 400
    reads = spark.createDataFrame(rows, "well string, barcode string")
    spikes = plate.spiked(book)
    assert [x.barcode for x in spikes.collect()] == ["A" * 10]
    (good,) = plate.validated(reads, book, ["well"], 41, spikes).collect()
    (bad,) = plate.validated(reads, book, ["well"], 41).collect()
    assert good.is_valid and good.unique_barcodes == 41 and good.top_barcode != "A" * 10 and good.notes == "left out: 400 reads of 1 spike-ins"
    assert not bad.is_valid and "low-entropy barcode dominates" in bad.notes and bad.top_barcode == "A" * 10
    fixed = reads.withColumn("barcode", F.concat(F.lit("A"), F.substring("barcode", 2, 9)))
    (collapsed,) = plate.validated(fixed, book.withColumn("barcode", F.concat(F.lit("A"), F.substring("barcode", 2, 9))), ["well"], 41).collect()
    assert "round of low entropy" in collapsed.notes
    ref = spark.createDataFrame([(c, 1 / 41) for c in codes], "barcode string, median_freq double")
    base = spark.createDataFrame([("w", 0.9, 1.0)], "well string, correlation double, top_guide_vs_median double")
    (against,) = plate.validated(reads, book, ["well"], 41, spikes, ref, base).collect()
    assert not against.is_valid and against.correlation == 0 and "correlation below baseline" in against.notes  # under 50 common barcodes
    assert not plate.validated(reads.limit(0), book, ["well"], 41, spikes).collect()
