"""Registered queries of rasters: values under points, labels, base calling from planes.

Lines are pixels (part and order numbers give the place), orders are spots and customers cells.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from screenweave.operators import basecalling, rasters, signals
from screenweave.operators.scratch import shared
from screenweave.plans.registry import _RC, _raster, long, query, r
from screenweave.sources import zarr_sink

_SPOTS = "SELECT o_orderkey AS id, o_custkey % 70 AS y, o_orderkey % 70 AS x FROM orders"


def _spots(t, n: int):
    return t.orders.select(F.col("o_orderkey").alias("id"), (F.col("o_custkey") % n).alias("y"), (F.col("o_orderkey") % n).alias("x"))


@query(f"WITH a AS ({_RC}), s AS ({_SPOTS}) SELECT id, s.y, s.x, coalesce(label, CASE WHEN s.y < 60 AND s.x < 60 THEN 0 END) AS label FROM s LEFT JOIN a USING (y, x)")
def spot_labels(t):
    return rasters.gathered(_spots(t, 70), _raster(t), size=32, name="label")


@query(f"""
WITH a AS ({_RC}), s AS ({_SPOTS}), k AS (SELECT label, min(y) AS r0, min(x) AS c0, max(y) + 1 AS r1, max(x) + 1 AS c1 FROM a WHERE label > 0 GROUP BY 1)
SELECT id, coalesce(r0, greatest(s.y - 100, 0)) AS min_row, coalesce(c0, greatest(s.x - 100, 0)) AS min_col, coalesce(r1, s.y + 100) AS max_row, coalesce(c1, s.x + 100) AS max_col FROM s LEFT JOIN a USING (y, x) LEFT JOIN k USING (label)""")
def spot_boxes(t):
    return rasters.boxes_at(_spots(t, 70), _raster(t), size=32).select("id", "min_row", "min_col", "max_row", "max_col")


_PLANE = "SELECT l_linenumber AS cycle, substr('ACGT', (l_suppkey % 4 + 1)::INT, 1) AS channel, l_partkey % 60 AS y, l_orderkey % 60 AS x, max(l_extendedprice) AS v FROM lineitem GROUP BY ALL"


def _planes(t, size: int = 60):
    channel = F.substring(F.lit("ACGT"), (F.col("l_suppkey") % 4 + 1).cast("int"), F.lit(1))
    pixels = t.lineitem.groupBy(F.col("l_linenumber").alias("cycle"), channel.alias("channel"), (F.col("l_partkey") % 60).alias("y"), (F.col("l_orderkey") % 60).alias("x")).agg(F.max("l_extendedprice").alias("v"))
    return rasters.packed(pixels, ["cycle", "channel"], size, "v", "<f8", full=True)


@query(f"""
WITH a AS ({_PLANE}), s AS (SELECT o_orderkey AS id, o_custkey % 60 AS y, o_orderkey % 60 AS x FROM orders), p AS (SELECT DISTINCT cycle, channel FROM a)
SELECT id, p.cycle::BIGINT AS cycle, p.channel, round(coalesce(v, 0), 2) AS intensity FROM s CROSS JOIN p LEFT JOIN a ON a.cycle = p.cycle AND a.channel = p.channel AND a.y = s.y AND a.x = s.x""")
def spot_intensities(t):
    out = rasters.intensities(_spots(t, 60), _planes(t), size=60)
    return out.select("id", long("cycle").alias("cycle"), "channel", r("intensity", 2).alias("intensity"))


@query()
def base_calls(t):
    """Reads called from planes: intensities and cells under spots, medians, unmixing, the brightest base of each cycle."""
    spots = rasters.gathered(_spots(t, 60), _raster(t), size=32, name="cell")
    bases = rasters.intensities(spots, _planes(t), size=60).withColumn("tile", F.floor(F.col("y") / 30) * 2 + F.floor(F.col("x") / 30))
    calls = basecalling.call_reads(bases.withColumnRenamed("id", "read"), ["tile"])
    return calls.select("tile", "read", long("cell").alias("cell"), "barcode", r("Q_min").alias("Q_min"))


@query(f"WITH a AS ({_RC}) SELECT label, round(avg(y), 4) AS y, round(avg(x), 4) AS x, count(*) AS area FROM a WHERE label > 0 GROUP BY 1")
def stored_labels(t):
    """Labels written as a sharded array, resharded, read again and measured."""
    path = f"{shared(t.spark)}/labels-{uuid.uuid4().hex}"
    tiles = _raster(t).withColumn("index", F.array().cast("array<int>"))
    zarr_sink.written(tiles, f"{path}/a", [60, 60], [8, 8], "<i8", [16, 32])
    zarr_sink.resharded(t.spark, f"{path}/a", f"{path}/b", [20, 20], [60, 20])
    return rasters.label_stats(zarr_sink.tiles_of(t.spark, f"{path}/b")).select("label", r("y").alias("y"), r("x").alias("x"), "area")


@query()
def tile_signals(t):
    """Signal and background of each tile, cycle and channel, from planes and spots."""
    out = signals.tile_stats(_spots(t, 60), _planes(t, 30), size=30, radius=1, width=2)
    return out.select("y0", "x0", long("cycle").alias("cycle"), "channel", "type", *[r(c, 3).alias(c) for c in ("mean", "median", "std")], "count", r("median_top", 3).alias("median_top"))


@query()
def tile_snrs(t):
    out = signals.tile_snr(signals.tile_stats(_spots(t, 60), _planes(t, 30), size=30, radius=1, width=2))
    return out.select("y0", "x0", long("cycle").alias("cycle"), "channel", r("snr").alias("snr"))


@query()
def snr_by_round(t):
    """Signal to noise around sampled spots by cycle and channel."""
    out = signals.snr_by_round(_spots(t, 60), _planes(t, 30), size=30, samples=50, near=2, around=12)
    return out.select(long("cycle").alias("cycle"), "channel", "spots", r("snr").alias("snr"))
