"""Rasters as tiles: a row holds a rectangle of pixels as bytes, and no step makes a row of a pixel.

A tile has its keys, its place (y0, x0), its size (h, w), a numpy type (dtype) and its rows of pixels, one after the other (data).
What is asked of labels (areas, centroids, boxes, overlaps, distinct labels) is a partial result by tile, whose sums are
merged by an aggregate: the shuffle is in proportion to the labels of tiles, not to pixels. Values under points are read with
one numpy take for each tile: points meet the bytes of their tile, and tiles with many points are dealt to several tasks.

Labels are integers; 0 and less is background. Tiles of one raster don't overlap.

Defined results: points off all tiles, or without a coordinate, have null; coordinates are truncated towards zero. Null keys
are keys like others. Tiles without data count as background. Empty frames give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from screenweave.operators.scratch import saved

SIZE = 512
#: Points of one tile that one task takes at once: it gives a row for each of them and each plane.
POINTS = 25_000
TILE = ["y0", "x0", "h", "w", "dtype", "data"]


def _kinds(df: DataFrame, columns: list[str]) -> str:
    return "".join(f"`{c}` {df.schema[c].dataType.simpleString()}, " for c in columns)


def _pixels(row: dict) -> np.ndarray:
    if row["data"] is None:
        return np.zeros((row["h"] or 0, row["w"] or 0), np.int64)
    return np.frombuffer(row["data"], dtype=row["dtype"]).reshape(row["h"], row["w"])


def packed(pixels: DataFrame, keys: list[str] = (), size: int = SIZE, value: str = "label", dtype: str = "<i8", full: bool = False) -> DataFrame:
    """Tiles of at most `size` x `size` (`full`: of that size) from rows (keys, y, x, value). Pixels without a row are 0; of two rows of a pixel the larger value stays."""
    keys = list(keys)

    def run(group: pd.DataFrame) -> pd.DataFrame:
        y0, x0 = int(group["_ty"].iloc[0]) * size, int(group["_tx"].iloc[0]) * size
        y, x = group["y"].to_numpy() - y0, group["x"].to_numpy() - x0
        plane = np.zeros((size, size) if full else (y.max() + 1, x.max() + 1), dtype=dtype)
        order = np.argsort(group["v"].to_numpy(), kind="stable")
        plane[y[order], x[order]] = group["v"].to_numpy()[order]
        return pd.DataFrame([[*group[keys].iloc[0], y0, x0, *plane.shape, dtype, plane.tobytes()]], columns=[*keys, *TILE])

    value_kind = "double" if np.dtype(dtype).kind == "f" else "long"
    rows = pixels.where(F.col(value).isNotNull() & F.col("y").isNotNull() & F.col("x").isNotNull()).select(*keys, F.col("y").cast("long").alias("y"), F.col("x").cast("long").alias("x"), F.col(value).cast(value_kind).alias("v"))
    at = rows.withColumns({"_ty": F.floor(F.col("y") / size), "_tx": F.floor(F.col("x") / size)})
    return at.groupBy(*keys, "_ty", "_tx").applyInPandas(run, f"{_kinds(pixels, keys)}y0 long, x0 long, h int, w int, dtype string, data binary")


def gathered(points: DataFrame, tiles: DataFrame, keys: list[str] = (), planes: list[str] = (), size: int = SIZE, name: str = "value", kind: str = "long") -> DataFrame:
    """The points with the value of the pixel under them: a row for each point and plane (columns of tiles that points lack).

    Tiles lie on a grid of `size`; a point that no tile of its place holds has one row with null planes and value.
    """
    keys, planes = list(keys), list(planes)
    columns = [f.name for f in points.schema]
    at = points.withColumns({"_y": F.col("y").cast("long"), "_x": F.col("x").cast("long")})
    at = at.withColumns({"_ty": F.floor(F.col("_y") / size), "_tx": F.floor(F.col("_x") / size), "_k": F.monotonically_increasing_id()})
    place = [*keys, "_ty", "_tx"]
    many = at.groupBy(*place).agg(F.ceil(F.count("*") / POINTS).cast("int").alias("_parts"))
    meets = lambda a, b: a.join(b.withColumnsRenamed({c: f"{c}_r" for c in place}), _same(a, place)).drop(*[f"{c}_r" for c in place])
    hot = many.where("_parts > 1")  # at most one row for each POINTS points
    dealt = at.join(hot.withColumnsRenamed({c: f"{c}_r" for c in place}), _same(at, place), "left").drop(*[f"{c}_r" for c in place])
    dealt = dealt.withColumn("_part", F.coalesce(F.pmod("_k", F.col("_parts")), F.lit(0)).cast("int")).drop("_parts", "_k")
    wanted = tiles.select(*keys, *planes, *TILE).withColumns({"_ty": F.floor(F.col("y0") / size), "_tx": F.floor(F.col("x0") / size)})
    wanted = meets(wanted, many).withColumn("_part", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1))).drop("_parts")

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        found = np.zeros(len(left), bool)
        y, x = left["_y"].to_numpy(dtype=float, na_value=np.nan), left["_x"].to_numpy(dtype=float, na_value=np.nan)
        for _, row in right.iterrows():
            plane = _pixels(row)
            ok = (y >= row["y0"]) & (x >= row["x0"]) & (y < row["y0"] + row["h"]) & (x < row["x0"] + row["w"])
            found |= ok
            part = left.loc[ok, columns].copy()
            for p in planes:
                part[p] = row[p]
            part[name] = plane[(y[ok] - row["y0"]).astype(int), (x[ok] - row["x0"]).astype(int)]
            out.append(part)
        rest = left.loc[~found, columns].copy()
        for p in [*planes, name]:
            rest[p] = None
        return pd.concat([p for p in [*out, rest] if len(p)] or [rest], ignore_index=True)[[*columns, *planes, name]].astype({name: "Int64" if kind == "long" else "float64"})

    by = [*place, "_part"]
    schema = f"{_kinds(points, columns)}{_kinds(tiles, planes)}`{name}` {kind}"
    there = dealt.where("_y IS NOT NULL AND _x IS NOT NULL")
    known = there.groupBy(*by).cogroup(wanted.groupBy(*by)).applyInPandas(run, schema)
    nowhere = dealt.where("_y IS NULL OR _x IS NULL").select(*columns, *[F.lit(None).cast(tiles.schema[p].dataType).alias(p) for p in planes], F.lit(None).cast(kind).alias(name))
    return known.unionByName(nowhere)


def _same(df: DataFrame, columns: list[str]):
    on = F.lit(True)
    for c in columns:
        on = on & df[c].eqNullSafe(F.col(f"{c}_r"))
    return on


def intensities(points: DataFrame, tiles: DataFrame, keys: list[str] = (), size: int = SIZE) -> DataFrame:
    """Long intensities of points from planes (cycle, channel): base calling's input. Points off the planes have no rows."""
    return gathered(points, tiles, keys, ["cycle", "channel"], size, "intensity", "double").where("intensity IS NOT NULL")


# Labels


def _by_tile(tiles: DataFrame, keys: list[str], schema: str, partial) -> DataFrame:
    """The partial results of all tiles: `partial` gives columns of numbers for a tile's pixels and its place."""
    names = [p.split()[0] for p in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k, row in enumerate(b.select(TILE).to_pylist()):
                columns = partial(_pixels(row), row["y0"] or 0, row["x0"] or 0)
                n = len(columns[0])
                if n:
                    own = [pa.concat_arrays([b.column(i)[k : k + 1]] * n) for i in range(len(keys))]
                    yield pa.RecordBatch.from_arrays([*own, *map(pa.array, columns)], names=[*keys, *names])

    return tiles.select(*keys, *TILE).mapInArrow(run, _kinds(tiles, keys) + schema)


def label_partials(tiles: DataFrame, keys: list[str] = ()) -> DataFrame:
    """(label, n, sy, sx, min_row, min_col, max_row, max_col) of each label of each tile; they merge by sums, least and largest values."""

    def partial(plane: np.ndarray, y0: int, x0: int) -> list[np.ndarray]:
        y, x = np.nonzero(plane > 0)
        labels, at = np.unique(plane[y, x].astype(np.int64), return_inverse=True)
        n = np.bincount(at, minlength=len(labels))
        y, x = y + y0, x + x0
        low = [np.full(len(labels), np.iinfo(np.int64).max) for _ in range(2)]
        high = [np.full(len(labels), np.iinfo(np.int64).min) for _ in range(2)]
        for k, v in enumerate((y, x)):
            np.minimum.at(low[k], at, v)
            np.maximum.at(high[k], at, v)
        total = [np.zeros(len(labels), np.int64) for _ in range(2)]
        for k, v in enumerate((y, x)):
            np.add.at(total[k], at, v)
        return [labels, n.astype(np.int64), *total, *low, *high]

    return _by_tile(tiles, list(keys), "label long, n long, sy long, sx long, min_row long, min_col long, max_row long, max_col long", partial)


def label_stats(tiles: DataFrame, keys: list[str] = ()) -> DataFrame:
    """Centroid, area and bounding box (half-open) of each label."""
    of = label_partials(tiles, keys).groupBy(*keys, "label")
    return of.agg(
        (F.sum("sy") / F.sum("n")).alias("y"), (F.sum("sx") / F.sum("n")).alias("x"), F.sum("n").alias("area"),
        F.min("min_row").alias("min_row"), F.min("min_col").alias("min_col"), (F.max("max_row") + 1).alias("max_row"), (F.max("max_col") + 1).alias("max_col"),
    )


def boxes_at(points: DataFrame, tiles: DataFrame, keys: list[str] = (), size: int = SIZE, side: int = 200) -> DataFrame:
    """The points with the label under them and its bounding box; on background, a window of `side` pixels around the point, not below 0."""
    keys = list(keys)
    under = gathered(points, tiles, keys, size=size, name="label")
    stats = label_stats(tiles, keys).select(*[F.col(k).alias(f"{k}_r") for k in keys], F.col("label").alias("label_r"), "min_row", "min_col", "max_row", "max_col")
    joined = under.join(stats, _same(under, [*keys, "label"]), "left").drop(*[f"{c}_r" for c in [*keys, "label"]])
    half = side // 2
    y, x = F.col("y").cast("long"), F.col("x").cast("long")
    around = {"min_row": F.greatest(y - half, F.lit(0)), "min_col": F.greatest(x - half, F.lit(0)), "max_row": y + half, "max_col": x + half}
    return joined.withColumns({k: F.coalesce(F.col(k), v) for k, v in around.items()})


def overlaps(a: DataFrame, b: DataFrame, threshold: float, keys: list[str] = ()) -> DataFrame:
    """(label_a, label_b, shared, iou) of two rasters on one grid, pairs with intersection over union above the threshold."""
    keys = list(keys)
    place = [*keys, "y0", "x0"]
    left, right = a.select(*place, *[F.col(c).alias(f"a_{c}") for c in TILE[2:]]), b.select(*[F.col(c).alias(f"{c}_r") for c in place], *[F.col(c).alias(f"b_{c}") for c in TILE[2:]])
    both = left.join(right, _same(left, place), "full").select(*[F.coalesce(c, f"{c}_r").alias(c) for c in keys], *[f"{s}_{c}" for s in "ab" for c in TILE[2:]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, row in enumerate(batch.to_pylist()):
                p, q = (_pixels({c: row[f"{s}_{c}"] for c in TILE[2:]}).astype(np.int64) for s in "ab")
                h, w = max(p.shape[0], q.shape[0]), max(p.shape[1], q.shape[1])
                flat = [np.pad(v, ((0, h - v.shape[0]), (0, w - v.shape[1]))).ravel() for v in (p, q)]
                pairs, n = np.unique(np.stack(flat)[:, (flat[0] > 0) | (flat[1] > 0)], axis=1, return_counts=True)
                if len(n):
                    own = [pa.concat_arrays([batch.column(i)[k : k + 1]] * len(n)) for i in range(len(keys))]
                    yield pa.RecordBatch.from_arrays([*own, pa.array(np.maximum(pairs[0], 0)), pa.array(np.maximum(pairs[1], 0)), pa.array(n.astype(np.int64))], names=[*keys, "label_a", "label_b", "n"])

    partial = both.mapInArrow(run, f"{_kinds(a, keys)}label_a long, label_b long, n long")
    pairs = saved(partial.groupBy(*keys, "label_a", "label_b").agg(F.sum("n").alias("shared")), "overlaps")
    area = lambda s: pairs.where(f"label_{s} > 0").groupBy(*[F.col(k).alias(f"{k}_r") for k in keys], F.col(f"label_{s}").alias(f"label_{s}_r")).agg(F.sum("shared").alias(f"area_{s}"))
    out = pairs.where("label_a > 0 AND label_b > 0")
    for s in "ab":
        out = out.join(area(s), _same(out, [*keys, f"label_{s}"])).drop(*[f"{c}_r" for c in [*keys, f"label_{s}"]])
    return out.withColumn("iou", F.col("shared") / (F.col("area_a") + F.col("area_b") - F.col("shared"))).where(F.col("iou") > threshold).drop("area_a", "area_b")


def confluency(tiles: DataFrame, size: int, keys: list[str] = ()) -> DataFrame:
    """Distinct labels by cell of a grid of `size` pixels."""

    def partial(plane: np.ndarray, y0: int, x0: int) -> list[np.ndarray]:
        row, column = (np.arange(n) + o for n, o in zip(plane.shape, (y0, x0)))
        cell = np.broadcast_arrays((row // size)[:, None], (column // size)[None, :], np.maximum(plane, 0))
        return list(np.unique(np.stack([c.ravel().astype(np.int64) for c in cell]), axis=1)) if plane.size else [np.zeros(0, np.int64)] * 3

    rows = _by_tile(tiles, list(keys), "row long, column long, label long", partial)
    return rows.groupBy(*keys, "row", "column").agg(F.countDistinct(F.when(F.col("label") > 0, F.col("label"))).alias("labels"))
