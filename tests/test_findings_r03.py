"""Cases that the findings of round 3 were about, against SQL and brute force."""

import math
import random

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from screenweave.operators import labels, leaves, mixtures, plate, positions, rasters, signals, spatial, stats
from screenweave.plans import plates, registry  # noqa: F401
from screenweave.streaming import completeness


def shuffled(spark) -> int:
    """Rows that all stages so far have written to shuffles."""
    g = spark.sparkContext._gateway
    stages = spark._jsc.sc().statusStore().stageList(None, False, False, g.new_array(g.jvm.double, 0), g.jvm.java.util.ArrayList())
    return sum(stages.apply(k).shuffleWriteRecords() for k in range(stages.size()))


def crowd(n, seed, keys=1):
    """Points with many at one place, on a small grid, far off and without a place."""
    r = random.Random(seed)
    place = lambda: r.choice([(0.0, -0.0), (r.gauss(0, 9), r.gauss(0, 9)), (r.randint(-5, 5) / 2, r.randint(-5, 5) / 2), (r.gauss(40, 0.01), r.gauss(40, 0.01)), (1e5, r.random())])
    rows = [(k % keys, k * 3 + seed, *place(), k % 5 if k % 11 else None) for k in range(n)]
    return [*rows, (0, -1, None, 1.0, 1), (0, -2, float("nan"), 1.0, 1), (None, -3, 0.0, 0.0, 1)]


@pytest.mark.parametrize("codes", [1, 2, 4])
def test_entropy_report_of_few_codes(spark, tmp_path, codes):
    part = [(k, "aaaaab"[k % 3 :] + "cd" * k, "STEEL", f"Brand#{k}1") for k in range(codes)] + [(90 + k, "zz", "TIN", "Brand#31") for k in range(2)]
    lines = [(k, p, s, 0.01 * (k % 5)) for k, (p, s) in enumerate([(p, s) for p in range(codes) for s in range(10) for _ in range(1 + 40 * p * (s % 2))] + [(90, 3)] * 5)]
    spark.createDataFrame(part, "p_partkey long, p_name string, p_type string, p_brand string").write.parquet(f"{tmp_path}/part.parquet")
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_suppkey long, l_discount double").write.parquet(f"{tmp_path}/lineitem.parquet")
    db = duckdb.connect()
    for name in ("part", "lineitem"):
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet/*.parquet'")
    text = lambda row: tuple("nan" if isinstance(v, float) and math.isnan(v) else v for v in row)
    want = sorted(map(text, db.execute(registry.ORACLES["entropy_report"]).fetchall()))
    got = sorted(text(tuple(x)) for x in registry.QUERIES["entropy_report"](spark, str(tmp_path)).collect())
    assert got == want and len(got) == 5


@pytest.fixture
def small_leaves(monkeypatch):
    for name, value in (("LEAF", 8), ("DEPTH", 4), ("PART", 16), ("AT_ONCE", 100)):
        monkeypatch.setattr(leaves, name, value)


_SCHEMA = "g long, id long, y double, x double, label long"


def usable(rows):
    return [x for x in rows if x[0] is not None and x[2] is not None and x[2] == x[2]]


@pytest.mark.parametrize("strict", [False, True])
def test_nearest_of_crowds(spark, small_leaves, strict):
    a, b, radius = crowd(160, 1, 2), crowd(170, 2, 2), 2.5
    fa, fb = (spark.createDataFrame(x, _SCHEMA) for x in (a, b))
    near = {}
    for p in usable(a):
        found = sorted((math.sqrt((p[2] - q[2]) ** 2 + (p[3] - q[3]) ** 2), q[1]) for q in usable(b) if q[0] == p[0])
        near[p[:2]] = [(d, q) for d, q in found if (d < radius if strict else d <= radius)]
    for k in (1, 3):
        got = sorted((x["g"], x["id_a"], x["place"], x["id_b"], x["distance"], x["label_a"] is None) for x in spatial.nearest(fa, fb, radius, ["g"], k, strict).collect())
        assert got == sorted((g, i, n + 1, q, d, (i - 1) // 3 % 11 == 0) for (g, i), found in near.items() for n, (d, q) in enumerate(found[:k]))
    if strict:
        best = {key: found[0][1] for key, found in near.items() if found}
        back = {}
        for p in usable(b):
            found = sorted((math.sqrt((p[2] - q[2]) ** 2 + (p[3] - q[3]) ** 2), q[1]) for q in usable(a) if q[0] == p[0])
            if found and found[0][0] < radius:
                back[p[:2]] = found[0][1]
        got = sorted((x["g"], x["id_a"], x["id_b"]) for x in spatial.mutual_nearest(fa, fb, radius, ["g"]).collect())
        assert got == sorted((g, i, q) for (g, i), q in best.items() if back.get((g, q)) == i)


def test_labels_around_crowds(spark, small_leaves):
    rows, radius = crowd(200, 4, 2), 3.0
    want = {}
    for p in rows:
        near = [q[4] for q in usable(rows) if p in usable(rows) and q[0] == p[0] and q[1] != p[1] and (p[2] - q[2]) ** 2 + (p[3] - q[3]) ** 2 <= radius**2]
        want[p[:2]] = (len(near), sum(v == p[4] for v in near if v is not None), max([near.count(v) for v in near] or [0]))
    got = {(x["g"], x["id"]): (x["neighbours"], x["sisters"], x["dominant"]) for x in spatial.neighbour_counts(spark.createDataFrame(rows, _SCHEMA), radius, "label", ["g"]).collect()}
    assert got == want


def test_components_of_crowds(spark, small_leaves):
    rows, radius = usable(crowd(200, 7)), 1.5
    root = {p[1]: p[1] for p in rows}
    links = [(p[1], q[1]) for p in rows for q in rows if p[1] < q[1] and (p[2] - q[2]) ** 2 + (p[3] - q[3]) ** 2 <= radius**2]
    for _ in rows:
        for p, q in links:
            root[p] = root[q] = min(root[p], root[q])
    got = {x["label"]: x["root"] for x in labels.merged(spatial.connections(spark.createDataFrame(rows, _SCHEMA), radius)).collect()}
    assert got == {k: root[k] for k in {v for link in links for v in link}} and len(set(got.values())) > 3


@pytest.mark.parametrize("search", ["nearest", "mutual", "counts", "components"])
def test_dense_planes_make_no_row_of_a_pair(spark, search):
    r = random.Random(5)
    points = spark.createDataFrame([(0, k, r.gauss(0, 5), r.gauss(0, 5), k % 4) for k in range(3000)], _SCHEMA).drop("g").coalesce(4)
    a, b = points.where("id % 2 = 0"), points.where("id % 2 = 1")
    before = shuffled(spark)
    out = {"nearest": lambda: spatial.nearest(a, b, 25.0), "mutual": lambda: spatial.mutual_nearest(a, b, 25.0), "counts": lambda: spatial.neighbour_counts(points, 20.0, "label"), "components": lambda: labels.merged(spatial.connections(points, 6.0))}[search]()
    assert out.count() > 0 and shuffled(spark) - before < 150_000  # of 2.25 million pairs


def test_points_of_one_tile_are_dealt(spark):
    pixels = spark.range(16).selectExpr("id div 4 AS y", "id % 4 AS x", "id AS label")
    points = spark.range(120_000).selectExpr("id", "id % 4 AS y", "id div 7 % 4 AS x")
    out = rasters.gathered(points, rasters.packed(pixels, size=4), size=4)
    assert out.where("value = y * 4 + x").count() == 120_000
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # it would put small partitions together
    try:
        of = out.select(F.spark_partition_id().alias("p")).groupBy("p").count().agg(F.max("count")).first()[0]
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert of < 120_000


def test_figures_of_repeated_values():
    r = np.random.default_rng(3)
    for n in (1, 2, 9, 40):
        v, times = r.integers(0, 9, n) / 4, r.integers(1, 30, n)
        all_ = np.sort(np.repeat(v, times))
        k = max(1, len(all_) // 10)
        got = signals._row("Signal", v, True, times)
        assert got[0] == "Signal" and got[4] == len(all_) and np.allclose([*got[1:4], got[5]], [all_.mean(), np.median(all_), all_.std(), np.median(all_[-k:])])


def test_spots_of_a_tile_arrive_counted(spark):
    plane = spark.range(16).selectExpr("1 AS cycle", "'A' AS channel", "id div 4 AS y", "id % 4 AS x", "cast(id AS double) AS v")
    spots = spark.range(50_000).selectExpr("id", "id % 3 AS y", "id % 2 AS x").coalesce(2)
    tiles = rasters.packed(plane, ["cycle", "channel"], 4, "v", "<f8", full=True)
    before = shuffled(spark)
    got = {x["type"]: x for x in signals.tile_stats(spots, tiles, size=4, radius=0, width=1).collect()}
    assert shuffled(spark) - before < 1000 and got["Signal"]["count"] == 50_000 and got["Background"]["count"] == 10
    assert abs(got["Signal"]["mean"] - sum(k % 3 * 4 + k % 2 for k in range(50_000)) / 50_000) < 1e-9


def test_large_components_are_solved_without_iterations(spark, monkeypatch):
    r = random.Random(7)
    rows, columns = 9, 11
    shift = lambda y, x: (y + r.gauss(0, 1) + (60 if r.random() < 0.05 else 0), x + r.gauss(0, 1), r.choice([0.5, 1.0, 2.0]))
    number = r.sample(range(1000), rows * columns)
    edges = [(number[i * columns + j], number[(i + p) * columns + j + q], *shift(90.0 * p, 90.0 * q)) for i in range(rows) for j in range(columns) for p, q in ((0, 1), (1, 0)) if i + p < rows and j + q < columns]
    edges += [edges[5], (*edges[6][1::-1], *shift(-90.0, 0.0))] + [(2000 + k, 2001 + k, *shift(0.0, 0.0)) for k in range(40)]  # repeated, turned; a chain
    df = spark.createDataFrame([*edges, (1, 1, 0.0, 0.0, 1.0), (3, None, 0.0, 0.0, 1.0)], "a long, b long, dy double, dx double, weight double")
    small = {p.tile: (p.component, p.y, p.x) for p in positions.solved(df, 3.0, 1).collect()}
    for name, value in {"WHOLE": 30, "CELL": 5, "INSIDE": 1, "STEPS": 1}.items():
        monkeypatch.setattr(positions, name, value)
    large = {p.tile: (p.component, p.y, p.x) for p in positions.solved(df, 3.0, 1).collect()}
    assert set(large) == set(small) and all(large[k][0] == small[k][0] and np.allclose(large[k][1:], small[k][1:], atol=1e-6) for k in small)


def test_outliers_of_counted_rows(spark):
    r = random.Random(5)
    rows = [(k, v) for k in ("a", "b", None) for v in [r.choice([1.0, 2.0, 2.5, 9.0, -30.0, None]) for _ in range(60)]] + [("one", 4.0), ("none", None)]
    df = spark.createDataFrame(rows, "k string, v double")
    votes = ["by_z", "by_mad", "by_iqr", "votes", "is_outlier", "direction"]
    plain = stats.outliers(df, ["k"], "v", 1.5, 2.0, 1.0)
    told = {(x.k, x.v): tuple(x[c] for c in votes) for x in plain.collect()}
    n = df.groupBy("k", "v").agg(F.count("*").alias("n"))
    folded = stats.outliers(n, ["k"], "v", 1.5, 2.0, 1.0, count="n").collect()
    assert {(x.k, x.v): tuple(x[c] for c in votes) for x in folded} == told and sum(x.n for x in folded) == len(rows)


def test_mixture_steps_do_not_shuffle_the_rows(spark):
    df = spark.range(4000).select((F.col("id") % 3).alias("k"), (F.col("id") * 1.5 + F.when(F.col("id") % 2 == 0, 9000).otherwise(0)).alias("x"))
    before = shuffled(spark)
    assert {x.n for x in mixtures.fit(df, ["k"], "x", most=8).collect()} == {1333, 1334}
    assert shuffled(spark) - before < 3 * 4000  # counts and centres; a step adds a row a task and group


def scans(df, table: str) -> int:
    return df._jdf.queryExecution().executedPlan().toString().count(f"{table}.parquet")


def test_plate_report_reads_the_lines_for_the_cell_sizes_only(spark):
    """The reads are joined with their parts once, into a table; the final plan has the lines only for the boxes, and works a text's entropy out once."""
    assert scans(registry.QUERIES["plate_report"](spark, "/root/testdata/sf0.001"), "lineitem") == 1


def test_statistics_of_counted_and_numbered_barcodes(spark):
    r = random.Random(3)
    texts = {k: "".join(r.choice("ACGT") for _ in range(r.randint(1, 9))) + str(k) for k in range(12)}
    rows = [(w, r.choice([k for k in texts if k % 3 != w])) for w in (0, 1, 2, None) for _ in range(150)] + [(5, 1), (6, None)]
    plain = spark.createDataFrame([(w, texts.get(k)) for w, k in rows], "well long, barcode string")
    counts = spark.createDataFrame(rows, "well long, barcode long").dropna(subset=["barcode"]).groupBy("well", "barcode").agg(F.count("*").alias("count"))
    coded = spark.createDataFrame(list(texts.items()), "barcode long, text string")
    close = lambda x, y: x == y or (isinstance(x, float) and math.isclose(x, y, rel_tol=1e-9))
    ordered = lambda df: sorted(df.collect(), key=lambda x: (x.well is None, x.well))
    same = lambda a, b: len(a) == len(b) > 1 and all(close(v, w) for x, y in zip(a, b) for v, w in zip(x, y))
    assert same(ordered(plate.entropy_stats(plain, ["well"])), ordered(plate.entropy_stats(counts, ["well"], count="count", texts=coded)))
    ref = [(k, 0.01 * (k + 1)) for k in range(9)]
    named, numbered = spark.createDataFrame([(texts[k], f) for k, f in ref], "barcode string, median_freq double"), spark.createDataFrame(ref, "barcode long, median_freq double")
    assert same(ordered(plate.reference_stats(plain, named, ["well"], least=2)), ordered(plate.reference_stats(counts, numbered, ["well"], least=2, count="count")))


def test_boxes_of_odd_texts(spark):
    texts = ["(1, 2, 30, 40)", "1 2 3", "", None, "(1, 2, 3, 4, 5)", "box", "[10,20,310,322]", "a1b2c3d4", "5,5,5,5"]
    out = plate.cell_sizes(spark.createDataFrame([(t,) for t in texts], "bbox string"), keep=["bbox"])
    got = {x.bbox: (x.bbox_height, x.bbox_width, x.bbox_area, x.bbox_aspect_ratio, x.is_large) for x in out.collect()}
    assert got == {"(1, 2, 30, 40)": (29, 38, 1102, 29 / 38, False), "[10,20,310,322]": (300, 302, 90600, 300 / 302, True), "a1b2c3d4": (2, 2, 4, 1.0, False), "5,5,5,5": (0, 0, 0, None, False)}
    assert "transform(" not in out._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("sent", [20_000, 0])
def test_top_medians_shuffle_few_rows(spark, monkeypatch, sent):
    monkeypatch.setattr(stats, "SENT", sent)
    r = random.Random(9)
    draw = {"a": lambda: r.gauss(0, 50), "b": lambda: float(r.randint(-2, 2)), "c": lambda: r.lognormvariate(3, 2), None: lambda: r.choice([0.0, -0.0, math.inf, 5e-324, 1e300])}
    rows = [(k, draw[k]()) for k in draw for _ in range(997)] + [("one", 4.0), ("two", -4.0), ("two", 9.0), ("none", None)] + [("a", None)] * 5
    rows += [("wide", 900.0 + k * 0.37) for k in range(20_000)]
    before = shuffled(spark)
    got = {x["g"]: x["median_top"] for x in stats.top_decile_median(spark.createDataFrame(rows, "g string, v double").coalesce(2), ["g"], "v").collect()}
    assert sent == 0 or shuffled(spark) - before < 8000  # of 24,000 different values
    for g in {k for k, _ in rows} - {"none"}:
        v = sorted((v for k, v in rows if k == g and v is not None), reverse=True)
        top = v[: max(1, len(v) // 10)]
        assert got.pop(g) == 0.5 * top[(len(top) - 1) // 2] + 0.5 * top[len(top) // 2]
    assert not got


def test_signal_summary_reads_the_signals_once(spark):
    table = spark.createDataFrame([(g, c, k, float(v), 2.0 * v, 0.1, 0.2, 3.0, 4.0, 5.0, 6.0) for g in ("x", "y", None) for c in (1, 2, 4) for k, v in enumerate(range(c, c * 3))], "g string, cycle long, channel long, snr double, sbr double, lld double, z_prime double, signal_mean double, median_top double, background_mean double, background_std double")
    got = {x["g"]: x for x in plate.signal_summary(table, ["g"]).collect()}
    means = {c: sum(range(c, c * 3)) / (2 * c) for c in (1, 2, 4)}
    assert set(got) == {"x", "y"} and got["x"].snr_slope == round(float(np.polyfit(list(means), list(means.values()), 1)[0]), 2) and got["x"].sbr_slope == round(2 * float(np.polyfit(list(means), list(means.values()), 1)[0]), 2)
    of = registry.QUERIES["signal_summary"](spark, "/root/testdata/sf0.001")
    assert scans(of, "lineitem") == 2  # and one before, of the buckets


def test_a_well_asks_its_state_twice_a_batch():
    calls, state, timers = [], {}, []

    class Value:
        def get(self):
            calls.append("get")
            return state.get("w")

        def update(self, value):
            calls.append("update")
            state["w"] = value

    class Handle:
        def getValueState(self, name, schema):
            return Value()

        def registerTimer(self, at):
            timers.append(at)

    wells = completeness.Wells()
    wells.init(Handle())
    batch = lambda tiles: pd.DataFrame({"tile": tiles, "expected": [completeness.NONE, *[40] * (len(tiles) - 1)], "due": [7] * len(tiles)})
    assert list(wells.handleInputRows(("a",), iter([batch([f"t{k % 30}" for k in range(500)]), batch(["t1", None])]), None)) == []
    assert calls == ["get", "update"] and timers == [7] and len(state["w"][0]) == 30
    assert list(wells.handleInputRows(("a",), iter([batch(["t3", None])]), None)) == [] and calls[2:] == ["get"]  # nothing new
    (told,) = wells.handleInputRows(("a",), iter([batch([f"t{k}" for k in range(45)])]), None)
    assert told.to_dict("records") == [{"well": "a", "tiles": 40, "expected": 40, "complete": True}] and state["w"] == ([], 40, True)
    assert list(wells.handleInputRows(("a",), iter([batch(["t99"])]), None)) == [] and list(wells.handleExpiredTimer(("a",), None, None)) == [] and timers == [7]
