"""Arrays keep their types, and are written whole or not at all."""

import json
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from screenweave.operators import rasters
from screenweave.sources import arrays, zarr_sink


def tiles(spark, cube, size):
    rows = []
    for lead in np.ndindex(*cube.shape[:-2]):
        for y in range(0, cube.shape[-2], size):
            for x in range(0, cube.shape[-1], size):
                part = np.ascontiguousarray(cube[lead][y : y + size, x : x + size])
                rows.append((list(map(int, lead)), y, x, *part.shape, part.dtype.str, part.tobytes()))
    return spark.createDataFrame(rows, "index array<int>, y0 long, x0 long, h int, w int, dtype string, data binary")


def dense(df, shape, dtype):
    out = np.full(shape, -1 if np.dtype(dtype).kind != "u" else 0, dtype=dtype)
    for r in df.collect():
        out[(*r["index"], slice(r["y0"], r["y0"] + r["h"]), slice(r["x0"], r["x0"] + r["w"]))] = np.frombuffer(r["data"], r["dtype"]).reshape(r["h"], r["w"])
    return out


@pytest.mark.parametrize("dtype,chunks,shard", [("<u2", [1, 8, 6], None), ("<i8", [1, 4, 4], [1, 8, 12]), ("<f4", [1, 5, 5], [1, 10, 10]), ("|b1", [1, 30, 30], None)])
def test_round_trip(spark, tmp_path, dtype, chunks, shard):
    r = np.random.default_rng(1)
    cube = (r.integers(0, 3, (2, 21, 25)) * r.integers(0, 2**60 if dtype == "<i8" else 2**15, (2, 21, 25))).astype(dtype)
    cube[1, :8] = 0
    path = str(tmp_path / "a.zarr")
    zarr_sink.written(tiles(spark, cube, 7).repartition(3), path, [2, 21, 25], chunks, dtype, shard)
    assert os.listdir(tmp_path) == ["a.zarr"] and set(os.listdir(path)) == {"c", "zarr.json"}
    assert np.array_equal(dense(zarr_sink.tiles_of(spark, path), cube.shape, dtype), cube)
    zarr_sink.resharded(spark, path, str(tmp_path / "b.zarr"), [1, 3, 9], [1, 9, 18])
    assert np.array_equal(dense(zarr_sink.tiles_of(spark, str(tmp_path / "b.zarr")), cube.shape, dtype), cube)


def test_append_and_overwrite(spark, tmp_path):
    path, a = str(tmp_path / "p"), np.arange(400).reshape(20, 20).astype("<i4")
    zarr_sink.written(tiles(spark, a, 20).where("false"), path, [20, 20], [4, 4], "<i4", [8, 8])
    assert not dense(zarr_sink.tiles_of(spark, path), (20, 20), "<i4").any()
    for y0 in (0, 10):  # one batch after the other, across shards
        part = tiles(spark, a[y0 : y0 + 10], 5).withColumn("y0", F.col("y0") + y0)
        zarr_sink.written(part, path, [20, 20], [4, 4], "<i4", [8, 8], append=True)
    assert np.array_equal(dense(zarr_sink.tiles_of(spark, path), (20, 20), "<i4"), a)
    with pytest.raises(Exception, match="another shape"):
        zarr_sink.written(tiles(spark, a, 5), path, [20, 24], [4, 4], "<i4", [8, 8], append=True)
    beyond = tiles(spark, a + 1, 20).withColumn("y0", F.lit(-3).cast("long"))
    zarr_sink.written(beyond, path, [10, 12], [4, 4], "<i4")
    assert np.array_equal(dense(zarr_sink.tiles_of(spark, path), (10, 12), "<i4"), (a + 1)[3:13, :12])


def test_a_failed_write_leaves_the_old_array(spark, tmp_path):
    path, a = str(tmp_path / "q"), np.ones((16, 16), "<i4")
    zarr_sink.written(tiles(spark, a, 8), path, [16, 16], [4, 4], "<i4", [8, 8])
    bad = tiles(spark, a * 2, 8).withColumn("dtype", F.when(F.col("y0") == 8, F.lit("<f4")).otherwise(F.col("dtype")))
    with pytest.raises(Exception, match="doesn't fit"):
        zarr_sink.written(bad, path, [16, 16], [4, 4], "<i4", [8, 8])
    assert os.listdir(tmp_path) == ["q"]
    assert np.array_equal(dense(zarr_sink.tiles_of(spark, path), (16, 16), "<i4"), a)


def test_a_killed_task_leaves_no_half_shard(tmp_path):
    meta = zarr_sink.metadata([16, 16], [4, 4], [8, 8], "<i4")
    w = zarr_sink.ShardWriter({"path": str(tmp_path / "k"), "metadata": json.dumps(meta)}, True)
    whole = np.ones((8, 8), "<i4")
    move = zarr_sink._open("/")[0].__class__.move

    class Killed(Exception):
        pass

    real = zarr_sink._open
    try:
        class Broken:
            def __init__(self, system):
                self.system = system

            def __getattr__(self, name):
                if name == "move":
                    raise Killed
                return getattr(self.system, name)

        zarr_sink._open = lambda p: (Broken(real(p)[0]), real(p)[1])
        with pytest.raises(Killed):
            w.put("c/0/0", w.encoded(arrays.Array.of(w.into, meta), whole, [2, 2]))
    finally:
        zarr_sink._open = real
    assert move and not os.path.exists(f"{w.into}/c/0/0")
    w.put("c/0/0", w.encoded(arrays.Array.of(w.into, meta), whole, [2, 2]))
    w.commit([])
    assert set(os.listdir(tmp_path / "k")) == {"c", "zarr.json"} and os.listdir(tmp_path) == ["k"]


def test_types_are_kept(spark, tmp_path):
    labels = np.array([[16777217, 16777219], [2**53 + 1, 0]], "<i8")
    path = str(tmp_path / "labels")
    zarr_sink.written(tiles(spark, labels, 2), path, [2, 2], [2, 2], "<i8")
    got = rasters.label_stats(zarr_sink.tiles_of(spark, path)).collect()
    assert {r.label for r in got} == {16777217, 16777219, 2**53 + 1}
    with pytest.raises(Exception, match="zarr_tiles"):
        spark.read.format("zarr").load(path).collect()
    graph = tmp_path / "g"
    ids = [2**53 + 1, 2**53 + 3, 5]
    for place, values, dtype in (("nodes/ids", ids, "<u8"), ("nodes/props/y/values", [1.5, 2.5, 3.5], "<f8"), ("edges/ids", [[2**53 + 1, 2**53 + 3]], "<i8")):
        v = np.array(values, dtype)
        folder = graph / place
        folder.mkdir(parents=True)
        (folder / ".zarray").write_text(json.dumps({"zarr_format": 2, "shape": v.shape, "chunks": v.shape, "dtype": dtype, "order": "C", "compressor": None, "filters": None, "fill_value": 0}))
        (folder / ".".join("0" * v.ndim)).write_bytes(v.tobytes())
    nodes, edges = arrays.track_graph(spark, str(graph), ["y"])
    assert {(r.id, r.y) for r in nodes.collect()} == set(zip(ids, [1.5, 2.5, 3.5]))
    assert [(r.src, r.dst) for r in edges.collect()] == [(2**53 + 1, 2**53 + 3)]
