"""Mosaics of tiles: placement, blending, sampled statistics, focus."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from screenweave.operators.images import pixels


def placed(tiles: DataFrame, shifts: DataFrame, keys: list[str]) -> DataFrame:
    """Tiles with their place in the mosaic: y0, x0 moved by the shift (dy, dx) of their keys, 0 where there is none."""
    out = tiles.join(shifts.select(*keys, F.col("dy").alias("_dy"), F.col("dx").alias("_dx")), keys, "left")
    return out.withColumns({"y0": F.col("y0") + F.coalesce("_dy", F.lit(0)), "x0": F.col("x0") + F.coalesce("_dx", F.lit(0))}).drop("_dy", "_dx")


def assembled(tiles: DataFrame, keys: list[str], size: int) -> DataFrame:
    """Output tiles of `size` from tiles at any place; where they overlap, weighted by the distance to their own edge.

    Each input tile goes to the output tiles that it touches, so a task holds one output tile and what lies on it.
    """
    span = lambda a, n: F.sequence(F.floor(F.col(a) / size), F.floor((F.col(a) + F.col(n) - 1) / size))
    sent = tiles.withColumn("_ty", F.explode(span("y0", "h"))).withColumn("_tx", F.explode(span("x0", "w")))

    def run(df: pd.DataFrame) -> pd.DataFrame:
        ty, tx = int(df["_ty"].iloc[0]) * size, int(df["_tx"].iloc[0]) * size
        total, weight = np.zeros((size, size)), np.zeros((size, size))
        for y, x, h, w, p in zip(df["y0"], df["x0"], df["h"], df["w"], df["pixels"]):
            edge = np.minimum.outer(np.minimum(np.arange(h), np.arange(h)[::-1]) + 1, np.minimum(np.arange(w), np.arange(w)[::-1]) + 1)
            a, b, c, d = max(y, ty), max(x, tx), min(y + h, ty + size), min(x + w, tx + size)
            part, at = (slice(a - y, c - y), slice(b - x, d - x)), (slice(a - ty, c - ty), slice(b - tx, d - tx))
            total[at] += pixels(p, h, w)[part] * edge[part]
            weight[at] += edge[part]
        out = (total / np.maximum(weight, 1)).astype(np.float32)
        return df[keys].iloc[:1].assign(y0=ty, x0=tx, h=size, w=size, pixels=[out.tobytes()])

    schema = ", ".join(filter(None, [*(f"{k} {tiles.schema[k].dataType.simpleString()}" for k in keys), "y0 int, x0 int, h int, w int, pixels binary"]))
    return sent.groupBy(*keys, "_ty", "_tx").applyInPandas(run, schema)


def stitch_confidence(edges: DataFrame, keys: list[str], confidence: str = "confidence", least: float = 0.5) -> DataFrame:
    """Statistics of the confidences of tile pairs (the third member of each edge), and whether the median is sufficient."""
    return edges.groupBy(*keys).agg(F.count("*").alias("edges"), F.avg(confidence).alias("mean"), F.percentile(confidence, F.lit(0.5)).alias("median"), F.min(confidence).alias("min"), (F.percentile(confidence, F.lit(0.5)) >= least).alias("sufficient"))


def sampled_stats(tiles: DataFrame, keys: list[str], block: int = 512, spacing: int = 4) -> DataFrame:
    """mean, std, median and iqr by keys, and over all as nulls, from every `spacing`-th pixel of the tiles' first block: a bounded read of each."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for r in b.to_dict("records"):
                v = pixels(r["pixels"], r["h"], r["w"])[:block:spacing, :block:spacing].ravel().astype(float)
                yield pd.DataFrame({**{k: [r[k]] * len(v) for k in keys}, "v": v})

    schema = ", ".join(f"{k} {tiles.schema[k].dataType.simpleString()}" for k in keys) + ", v double"
    values = tiles.mapInPandas(run, schema)
    q = lambda p: F.percentile("v", F.lit(p))
    return values.groupingSets([[F.col(k) for k in keys], []], *keys).agg(F.avg("v").alias("mean"), F.stddev_pop("v").alias("std"), q(0.5).alias("median"), (q(0.75) - q(0.25)).alias("iqr"), F.count("*").alias("n"))


def sharpness(v: np.ndarray) -> float:
    """Variance of a discrete Laplacian."""
    inner = v[1:-1, 1:-1]
    return float((v[:-2, 1:-1] + v[2:, 1:-1] + v[1:-1, :-2] + v[1:-1, 2:] - 4 * inner).var()) if inner.size else 0.0


def best_focus(tiles: DataFrame, keys: list[str], plane: str = "z") -> DataFrame:
    """The sharpest plane of each place (ties: the lowest)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield b[[*keys, "y0", "x0", plane]].assign(sharpness=[sharpness(pixels(p, h, w)) for p, h, w in zip(b["pixels"], b["h"], b["w"])])

    schema = ", ".join(f"{k} {tiles.schema[k].dataType.simpleString()}" for k in [*keys, "y0", "x0", plane]) + ", sharpness double"
    scores = tiles.mapInPandas(run, schema)
    best = F.max(F.struct("sharpness", (-F.col(plane)).alias("n"))).alias("b")
    return scores.groupBy(*keys, "y0", "x0").agg(best).select(*keys, "y0", "x0", (-F.col("b.n")).alias(plane), F.col("b.sharpness").alias("sharpness"))


def blank(tiles: DataFrame, keys: list[str]) -> DataFrame:
    """Whether the largest pixel of a key's tiles is 0."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield b[keys].assign(top=[float(pixels(p, h, w).max()) for p, h, w in zip(b["pixels"], b["h"], b["w"])])

    schema = ", ".join(f"{k} {tiles.schema[k].dataType.simpleString()}" for k in keys) + ", top double"
    return tiles.mapInPandas(run, schema).groupBy(*keys).agg((F.max("top") <= 0).alias("blank"))
