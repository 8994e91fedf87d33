"""Sources, sinks, streams, the step graph and the registered queries."""

import datetime
import json
import zlib

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

import __spark_entry__
from screenweave.plans import quality, registry  # noqa: F401
from screenweave.plans.dag import Graph, Step
from screenweave.sources import arrays, tables
from screenweave.streaming import queries as streams

SF = "/root/testdata/sf0.001"


def test_wells_from_file_names(spark, tmp_path):
    for well in ("A1", "B2"):
        (tmp_path / f"{well}_linked_pheno_iss.csv").write_text("cell,barcode\n1,AC\n2,\n")
    df = tables.read_wells(spark, f"{tmp_path}/*_linked_pheno_iss.csv", "cell int, barcode string")
    assert sorted((r["well"], r["cell"], r["barcode"]) for r in df.collect())[:2] == [("A1", 1, "AC"), ("A1", 2, None)]
    assert tables.read_optional(spark, f"{tmp_path}/none.csv", "a int").count() == 0
    assert tables.resolved(df, "sgRNA", "barcode") == "barcode"
    assert tables.drop_unnamed(df.withColumn("Unnamed: 0", F.lit(1))).columns == df.columns
    before = tables.status_key(spark, f"{tmp_path}/*.csv")
    (tmp_path / "C3_x.csv").write_text("a\n")
    assert tables.status_key(spark, f"{tmp_path}/*.csv") != before


def test_replace_while_reading(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(5).write.parquet(path)
    tables.replace(spark.read.parquet(path).where("id > 2"), path, backup=f"{path}.first")
    assert sorted(r[0] for r in spark.read.parquet(path).collect()) == [3, 4]
    assert spark.read.parquet(f"{path}.first").count() == 5
    assert tables.completed(spark, path) and not tables.completed(spark, f"{path}x")


def test_cache_and_upsert(spark, tmp_path):
    calls = []

    def build():
        calls.append(1)
        return spark.range(3)

    for _ in range(2):
        assert tables.cached(spark, str(tmp_path / "c"), build).count() == 3
    assert len(calls) == 1
    path = str(tmp_path / "k")
    tables.upsert_partitions(spark.createDataFrame([("A", 1), ("B", 2)], "well string, n int"), path, "well")
    tables.upsert_partitions(spark.createDataFrame([("B", 3)], "well string, n int"), path, "well")
    assert sorted((r["well"], r["n"]) for r in spark.read.parquet(path).collect()) == [("A", 1), ("B", 3)]
    assert [r["n"] for r in tables.read_key(spark, path, "well", "B").collect()] == [3]


def test_arrays(spark, tmp_path):
    arrays.register(spark)
    np.save(tmp_path / "spots.npy", np.array([[1, 2], [3, 4]]))
    got = spark.read.format("npy").load(str(tmp_path / "spots.npy")).orderBy("spot_id").collect()
    assert [(r["file"], r["y"], r["x"]) for r in got] == [("spots", 1.0, 2.0), ("spots", 3.0, 4.0)]
    store, data = tmp_path / "a.zarr", np.arange(2 * 5 * 7, dtype="<u2").reshape(2, 5, 7)
    store.mkdir()
    (store / ".zarray").write_text(json.dumps({"shape": [2, 5, 7], "chunks": [1, 4, 4], "dtype": "<u2", "order": "C", "compressor": {"id": "zlib"}, "fill_value": 0, "zarr_format": 2}))
    for c in range(2):
        for y in range(2):
            for x in range(2):
                chunk = np.zeros((1, 4, 4), dtype="<u2")
                part = data[c : c + 1, 4 * y : 4 * y + 4, 4 * x : 4 * x + 4]
                chunk[:, : part.shape[1], : part.shape[2]] = part
                if (c, y, x) != (1, 1, 1):
                    (store / f"{c}.{y}.{x}").write_bytes(zlib.compress(chunk.tobytes()))
    out = np.zeros(data.shape)
    for r in spark.read.format("zarr").load(str(tmp_path)).collect():
        out[r["index"][0], r["y0"] : r["y0"] + r["h"], r["x0"] : r["x0"] + r["w"]] = np.frombuffer(r["pixels"], np.float32).reshape(r["h"], r["w"])
    data[1, 4:, 4:] = 0
    assert np.array_equal(out, data)


def test_rounds_and_affines(spark):
    df = tables.rounds_as_time({1: spark.range(1), 0: spark.range(2)})
    assert sorted((r["t"], r["id"]) for r in df.collect()) == [(0, 0), (0, 1), (1, 0)]
    r = tables.affines({"0": [[2, 0, 1], [0, 2, 0], [0, 0, 1]]}, spark).collect()[0]
    assert np.allclose(np.array(r["m"]) @ np.array(r["inverse"]), np.eye(3))


def test_streams(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    base = datetime.datetime(2024, 1, 1)
    rows = [{"ts": str(base + datetime.timedelta(minutes=m)), "k": k, "value": 1.0} for m, k in [(0, "a"), (5, "a"), (20, "b"), (21, "a"), (70, "a")]]
    (src / "1.json").write_text("\n".join(map(json.dumps, rows)))
    schema = "ts timestamp, k string, value double"

    def run(make, name, mode="append"):
        df = spark.readStream.schema(schema).json(str(src))
        make(df).writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", str(tmp_path / name)).trigger(availableNow=True).start().awaitTermination()
        return spark.table(name)

    w = run(lambda df: streams.windowed(df, ["k"], "10 minutes", "0 seconds"), "w").collect()
    assert sorted((r["begin"].minute, r["k"], r["n"]) for r in w) == [(0, "a", 2), (20, "a", 1), (20, "b", 1)]
    s = run(lambda df: streams.sessions(df, "k", "10 minutes", "0 seconds"), "s").collect()
    assert sorted((r["k"], r["n"]) for r in s) == [("a", 1), ("a", 2), ("b", 1)]
    assert sorted(r["k"] for r in run(lambda df: streams.first_arrivals(df, ["k"], "1 hour"), "f").collect()) == ["a", "b"]
    seen = []
    for _ in range(2):
        streams.work_off(spark, str(src), schema, str(tmp_path / "q"), lambda df, k: seen.append(df.count()))
    assert seen == [5]


def test_graph():
    log = []
    step = lambda n, *needs, fail=False, done=False: Step(n, (lambda: 1 / 0) if fail else (lambda: log.append(n)), needs, lambda: done)
    g = Graph([step("d", "b", "c"), step("a"), step("b", "a"), step("c", "a", "absent"), step("e", "x"), step("x", fail=True), step("y", done=True)])
    assert g.order() == ["a", "b", "c", "d", "x", "e", "y"]
    assert g.downstream("b") == ["b", "d"]
    for workers in (1, 3):
        log.clear()
        state = g.run(workers=workers)
        assert state == {"a": "done", "b": "done", "c": "done", "d": "done", "x": "failed", "e": "blocked", "y": "skipped"}
        assert log.index("a") < min(log.index("b"), log.index("c")) and log[-1] == "d"
    with pytest.raises(ValueError):
        Graph([step("p", "q"), step("q", "p")]).order()


def rows(df):
    cols = sorted(df.columns)
    show = lambda v: "null" if v is None or v is pd.NA or v != v else repr(float(v) + 0.0) if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v)
    return cols, sorted(map(tuple, df[cols].map(show).to_numpy().tolist()))


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_query_gives_what_sql_gives(spark, name):
    con = duckdb.connect()
    for t in "region nation customer supplier part orders lineitem events documents embeddings labels benchmark".split():
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    assert rows(registry.QUERIES[name](spark, SF).toPandas()) == rows(con.sql(registry.ORACLES[name]).df())


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 1
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_plans_push_down(spark):
    plan = registry.QUERIES["keep_best"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_totalprice:double>" in plan
    assert "CartesianProduct" not in registry.QUERIES["nearest_neighbour"](spark, SF)._jdf.queryExecution().executedPlan().toString()
