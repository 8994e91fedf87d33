"""Numbers by place, sketches, table functions, and wells told by a stateful stream."""

import datetime
import json

import numpy as np
import pytest

from screenweave.functions import tables as table_functions
from screenweave.operators import keyed, labels, ordered, sketches
from screenweave.streaming import completeness


def test_positions_follow_the_files(spark, tmp_path):
    r = np.random.default_rng(1)
    values = []
    for k, n in enumerate((700, 0, 3, 1500)):
        own = [int(v) for v in r.integers(0, 10**6, n)]
        values += own
        folder = tmp_path / "csv"
        folder.mkdir(exist_ok=True)
        (folder / f"part{k}.csv").write_text("".join(f"{v},x{v}\n" for v in own))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("1k", "128m"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            got = ordered.positions(spark.read.schema("v int, s string").csv(str(tmp_path / "csv"))).collect()
            assert sorted((x.position, x.v) for x in got) == list(enumerate(values))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


@pytest.mark.parametrize("n,m", [(50, 30), (30, 50), (40, 40), (5, 0)])
def test_join_by_position(spark, tmp_path, n, m):
    spark.range(n).selectExpr("id * 3 % 31 AS a", "id AS shared").coalesce(1).write.parquet(str(tmp_path / "a"))
    spark.range(m).selectExpr("id * 7 % 29 AS b", "id AS shared").coalesce(1).write.parquet(str(tmp_path / "b"))
    a, b = (spark.read.parquet(str(tmp_path / x)) for x in "ab")
    got = sorted((x.position, x.a, x.b) for x in ordered.joined_by_position(a, b).collect())
    assert got == [(k, k * 3 % 31, k * 7 % 29 if k < m else None) for k in range(n)]


def test_dense_numbers(spark):
    v = [5, 2**40, -3, 5, 7, 7, 2**40 + 1]
    df = spark.createDataFrame([(x,) for x in v], "root long")
    assert {r.root: r.number for r in ordered.dense(df, "root").collect()} == {x: k + 1 for k, x in enumerate(sorted(set(v)))}
    assert len(labels.compact(df).collect()) == len(v)
    assert not ordered.dense(df.limit(0), "root").collect()


def test_downsample_by_hash(spark):
    r = np.random.default_rng(2)
    rows = [(f"g{k % 3}", f"b{b}", f"{h:032x}") for k, (b, h) in enumerate(zip(r.integers(0, 2, 900), r.integers(0, 2**62, 900)))] + [("h", "b0", "00")]
    df = spark.createDataFrame(rows, "g string, b string, h string")
    got = keyed.equal_downsample(df, "g", "b", df["h"], 2).collect()
    want = []
    for g in ("g0", "g1", "g2"):
        of = {b: sorted(x for x in rows if x[:2] == (g, b)) for b in ("b0", "b1")}
        k = min(map(len, of.values()))
        want += [x for v in of.values() for x in v[:k]]
    assert sorted(map(tuple, got)) == sorted(want)


def test_sketches_merge(spark):
    df = spark.range(60_000).selectExpr("id % 7 AS well", "id % 3 AS day", "id * 13 % 20011 AS cell", "CAST(NULL AS long) AS none")
    table = sketches.sketched(df, ["well", "day"], ["cell", "none"])
    exact = {r.day: r.n for r in df.groupBy("day").agg({"cell": "count"}).withColumnRenamed("count(cell)", "x").join(df.groupBy("day").agg(labels.F.countDistinct("cell").alias("n")), "day").collect()}
    for r in sketches.estimated(table, ["day"], ["cell", "none"]).collect():
        assert abs(r.cell - exact[r.day]) <= 0.03 * exact[r.day] and r.none == 0
    (total,) = sketches.estimated(table, [], ["cell", "none"]).collect()
    assert abs(total.cell - 20011) <= 0.03 * 20011 and total.rows == 60_000
    halves = [sketches.sketched(df.where(f"well {op} 3"), ["day"], ["cell", "none"]) for op in ("<", ">=")]
    both = sketches.estimated(sketches.added(*halves, ["day"], ["cell", "none"]), ["day"], ["cell"])
    assert {r.day: r.cell for r in both.collect()} == {r.day: r.cell for r in sketches.estimated(table, ["day"], ["cell"]).collect()}


def test_table_functions(spark):
    table_functions.register(spark)
    got = spark.sql("SELECT * FROM tile_grid(25, 30, 10, 2)").collect()
    assert len(got) == 9 and tuple(got[-1]) == (8, 18, 18, 25, 30) and tuple(got[0]) == (0, 0, 0, 12, 12)
    spark.createDataFrame([(k, a) for k, v in {1: [1, 2, 3, 9, 10, None], 2: [5], 3: []}.items() for a in v], "key long, at long").repartition(3).createOrReplaceTempView("frames")
    got = spark.sql("SELECT * FROM islands(TABLE(SELECT key, at FROM frames) PARTITION BY (key) ORDER BY (at), 1)").collect()
    assert sorted(map(tuple, got)) == [(1, 1, 3, 3), (1, 9, 10, 2), (2, 5, 5, 1)]


def test_wells_are_told_once(spark, tmp_path):
    at = lambda m: (datetime.datetime(2024, 1, 1) + datetime.timedelta(minutes=m)).isoformat()
    row = lambda well, tile, m, expected=3, due=60: {"well": well, "tile": tile, "ts": at(m), "expected": expected, "due": at(due)}
    first = [row("A1", "t1", 1), row("A1", "t2", 2), row("B1", "t1", 3), row("A1", "t2", 4), row("C1", "t1", 5), row("C1", "t2", 6), row("C1", "t3", 7), row(None, "t1", 7), row("D1", None, 7)]
    second = [row("A1", "t3", 50), row("B1", "t2", 55), row("C1", "t3", 56), row("C1", "t4", 57)]
    third = [row("B1", "t3", 90), row("E1", "t1", 200, due=500), row("Z1", "t1", 400, 1, 900)]
    src, schema = tmp_path / "in", "well string, tile string, ts timestamp, expected long, due timestamp"
    src.mkdir()
    told = []
    for k, part in enumerate((first, second, third, [row("Z1", "t2", 1000, 1, 900)])):
        (src / f"{k}.json").write_text("\n".join(map(json.dumps, part)))
        completeness.run(spark, spark.readStream.schema(schema).json(str(src)), "10 minutes", str(tmp_path / "out"), str(tmp_path / "checkpoint"))
        told.append(sorted((r.well, r.tiles, r.complete) for r in spark.read.parquet(str(tmp_path / "out")).collect()))
    assert told[0] == [("C1", 3, True)]
    assert told[1] == [("A1", 3, True), ("C1", 3, True)]
    assert ("B1", 2, False) in told[2] and ("E1", 1, False) not in told[2]
    whole = sorted((r.well, r.tiles, r.complete) for r in completeness.batch(spark.read.schema(schema).json(str(src))).collect())
    assert [w for w in told[3]] == whole
    completeness.run(spark, spark.readStream.schema(schema).json(str(src)), "10 minutes", str(tmp_path / "again"), str(tmp_path / "fresh"))
    assert sorted((r.well, r.tiles, r.complete) for r in spark.read.parquet(str(tmp_path / "again")).collect()) == whole
