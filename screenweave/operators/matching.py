"""Matching of cells by place and shape: scaled descriptors, log-moment distances, neighbourhood graphs. Candidates always come from a radius join."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from screenweave.functions.expressions import vector_distance
from screenweave.operators.spatial import nearest, within


def log_moments(mask: np.ndarray) -> list[float]:
    """The seven rotation-invariant moments of a mask, as sign(h) log10 |h| (0 for 0)."""
    y, x = np.nonzero(mask)
    if not len(y):
        return [0.0] * 7
    y, x, n = y - y.mean(), x - x.mean(), len(y)
    e = {(p, q): float((x**p * y**q).sum()) / n ** (1 + (p + q) / 2) for p in range(4) for q in range(4 - p)}
    a, b = e[3, 0] + e[1, 2], e[2, 1] + e[0, 3]
    c, d = e[3, 0] - 3 * e[1, 2], 3 * e[2, 1] - e[0, 3]
    h = [
        e[2, 0] + e[0, 2],
        (e[2, 0] - e[0, 2]) ** 2 + 4 * e[1, 1] ** 2,
        c**2 + d**2,
        a**2 + b**2,
        c * a * (a**2 - 3 * b**2) + d * b * (3 * a**2 - b**2),
        (e[2, 0] - e[0, 2]) * (a**2 - b**2) + 4 * e[1, 1] * a * b,
        d * a * (a**2 - 3 * b**2) - c * b * (3 * a**2 - b**2),
    ]
    return [float(np.sign(v) * np.log10(abs(v))) if abs(v) > 1e-30 else 0.0 for v in h]


def by_descriptor(a: DataFrame, b: DataFrame, radius: float, vector: str, k: int = 5, worst: float | None = None, keys: list[str] = ()) -> DataFrame:
    """One-to-one matches among the k nearest with the smallest L1 distance of descriptors: best by source, then best by target."""
    near = nearest(a, b, radius, keys, k).withColumn("difference", vector_distance(F.col(f"{vector}_a"), F.col(f"{vector}_b")))
    if worst is not None:
        near = near.where(F.col("difference") <= worst)
    first = lambda df, s, t: df.withColumn("_n", F.row_number().over(W.partitionBy(*keys, f"id_{s}").orderBy("difference", "distance", f"id_{t}"))).where("_n = 1").drop("_n")
    return first(first(near, "a", "b"), "b", "a").select(*keys, "id_a", "id_b", "distance", "difference")


def standardised(df: DataFrame, features: list[str], name: str = "vector", keys: list[str] = ()) -> DataFrame:
    """Features as one array of z-scores (population deviation; 0 counts as 1)."""
    stats = df.groupBy(*keys).agg(*[F.avg(c).alias(f"_m_{c}") for c in features], *[F.stddev_pop(c).alias(f"_s_{c}") for c in features])
    both = df.join(stats, list(keys)) if keys else df.crossJoin(F.broadcast(stats))
    z = [(F.col(c) - F.col(f"_m_{c}")) / F.coalesce(F.nullif(F.col(f"_s_{c}"), F.lit(0.0)), F.lit(1.0)) for c in features]
    return both.withColumn(name, F.array(*z)).drop(*[f"_{s}_{c}" for c in features for s in "ms"])


def neighbourhoods(points: DataFrame, radius: float, k: int, keys: list[str] = ()) -> DataFrame:
    """(id, neighbours): the k nearest others with their offsets, nearest first. k bounds the array."""
    p = points.select(*keys, "id", "y", "x")
    pairs = within(p, p, radius, keys).where("id_a <> id_b")
    ranked = pairs.withColumn("_n", F.row_number().over(W.partitionBy(*keys, "id_a").orderBy("distance", "id_b"))).where(F.col("_n") <= k)
    item = F.struct("_n", F.col("id_b").alias("id"), (F.col("y_b") - F.col("y_a")).alias("dy"), (F.col("x_b") - F.col("x_a")).alias("dx"))
    return ranked.groupBy(*keys, F.col("id_a").alias("id")).agg(F.transform(F.sort_array(F.collect_list(item)), lambda s: F.struct(s["id"].alias("id"), s["dy"].alias("dy"), s["dx"].alias("dx"))).alias("neighbours"))


def graph_consistent(a: DataFrame, b: DataFrame, radius: float, k: int = 6, tolerance: float = 3.0, least: float = 0.5) -> DataFrame:
    """Candidate pairs of points whose neighbours' offsets agree: the share of a's neighbours with one of b's within the tolerance is `least` or more; best by source, then by target."""
    na, nb = (neighbourhoods(x, radius, k).select(F.col("id").alias(f"id_{s}"), F.col("neighbours").alias(f"n_{s}")) for x, s in ((a, "a"), (b, "b")))
    pairs = within(a.select("id", "y", "x"), b.select("id", "y", "x"), radius).join(na, "id_a").join(nb, "id_b")
    close = lambda p, q: (p["dy"] - q["dy"]) ** 2 + (p["dx"] - q["dx"]) ** 2 <= tolerance**2
    agree = F.size(F.filter("n_a", lambda p: F.exists("n_b", lambda q: close(p, q)))) / F.size("n_a")
    scored = pairs.withColumn("agreement", agree).where(F.col("agreement") >= least)
    first = lambda df, s, t: df.withColumn("_n", F.row_number().over(W.partitionBy(f"id_{s}").orderBy(F.desc("agreement"), "distance", f"id_{t}"))).where("_n = 1").drop("_n")
    return first(first(scored, "a", "b"), "b", "a").select("id_a", "id_b", "distance", "agreement")


def grid_subsample(a: DataFrame, b: DataFrame, size: float, bins: int, order=None, margin: float = 0.2) -> tuple[DataFrame, DataFrame]:
    """The points of both sides in the same `bins` grid cells, picked by hash among those that both fill in the inner part of the plane."""
    at = lambda df: df.withColumns({"_gy": F.floor(F.col("y") / size), "_gx": F.floor(F.col("x") / size)})
    cells = at(a).select("_gy", "_gx").distinct().intersect(at(b).select("_gy", "_gx").distinct())
    span = cells.agg(*[f(c).alias(f"{n}{c}") for c in ("_gy", "_gx") for n, f in (("lo", F.min), ("hi", F.max))])
    inner = lambda c: (F.col(c) >= F.col(f"lo{c}") + margin * (F.col(f"hi{c}") - F.col(f"lo{c}"))) & (F.col(c) <= F.col(f"hi{c}") - margin * (F.col(f"hi{c}") - F.col(f"lo{c}")))
    picked = cells.crossJoin(F.broadcast(span)).where(inner("_gy") & inner("_gx")).select("_gy", "_gx").orderBy(F.xxhash64("_gy", "_gx") if order is None else order).limit(bins)
    return tuple(at(x).join(F.broadcast(picked), ["_gy", "_gx"]).drop("_gy", "_gx") for x in (a, b))


def tilt_fit(samples: DataFrame, keys: list[str]) -> DataFrame:
    """(keys..., a, b, c) of zenith = a exp(b r) + c by a search over b with a linear fit for a and c. A group is one well's calibration samples."""

    def run(df: pd.DataFrame) -> pd.DataFrame:
        r, z = df["r"].to_numpy(float), df["zenith"].to_numpy(float)
        scale = max(np.abs(r).max(), 1e-9)

        def fit(b: float):
            m = np.c_[np.exp(b * r / scale), np.ones(len(r))]
            p, *_ = np.linalg.lstsq(m, z, rcond=None)
            return float(((m @ p - z) ** 2).sum()), p

        lo, hi = -10.0, 10.0
        for _ in range(8):
            grid = np.linspace(lo, hi, 41)
            best = min((g for g in grid if abs(g) > 1e-6), key=lambda g: fit(g)[0])
            lo, hi = best - (hi - lo) / 20, best + (hi - lo) / 20
        p = fit(best)[1]
        return df[keys].iloc[:1].assign(a=p[0], b=best / scale, c=p[1])

    schema = ", ".join(f"{k} {samples.schema[k].dataType.simpleString()}" for k in keys) + ", a double, b double, c double"
    return samples.groupBy(*keys).applyInPandas(run, schema)
