"""Base calling from long intensities (well, tile, read, cell, cycle, channel, intensity)."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from screenweave.functions.expressions import argmax_base, base_quality

CHANNELS = ["A", "C", "G", "T"]


def cubes(bases: DataFrame, keys: list[str]) -> DataFrame:
    """One row for each read with an array by cycle of arrays by channel, both in sorted order; null unless every cycle has all channels."""
    by_cycle = bases.groupBy(*keys, "cycle").agg(F.transform(F.sort_array(F.collect_list(F.struct("channel", "intensity"))), lambda s: s["intensity"].cast("double")).alias("v"))
    whole = by_cycle.groupBy(*keys).agg(F.transform(F.sort_array(F.collect_list(F.struct("cycle", "v"))), lambda s: s["v"]).alias("values"), F.min(F.size("v")).alias("_lo"), F.max(F.size("v")).alias("_hi"))
    return whole.withColumn("values", F.when(F.col("_lo") == F.col("_hi"), F.col("values"))).drop("_lo", "_hi")


def median_transform(values: np.ndarray) -> np.ndarray:
    """Unmixing matrix of rows of channel intensities: medians of the rows where a channel is brightest, columns scaled to sum 1, inverted.

    A channel that is never the brightest has a unit column; a singular matrix gives the identity.
    """
    top = values.argmax(axis=1)
    return unmixing({k: np.median(values[top == k], axis=0) for k in set(top.tolist())}, values.shape[1])


def unmixing(medians: dict[int, np.ndarray], n: int) -> np.ndarray:
    """The matrix from the median intensities of the rows where a channel is brightest, by that channel."""
    mixing = np.zeros((n, n))
    for k in range(n):
        column = medians.get(k, np.eye(n)[k])
        mixing[:, k] = column / column.sum() if column.sum() else np.eye(n)[k]
    try:
        return np.linalg.inv(mixing)
    except np.linalg.LinAlgError:
        return np.eye(n)


def corrected(reads: DataFrame, group: list[str]) -> DataFrame:
    """Values after each group's transform, fitted on all reads inside cells, applied to all, truncated to integers.

    The medians are aggregates by group, brightest channel and channel; a task of Python meets the few medians of a group,
    never its rows.
    """
    schema = ", ".join(f"{c} {reads.schema[c].dataType.simpleString()}" for c in group) + ", matrix array<array<double>>"

    def fit(df: pd.DataFrame) -> pd.DataFrame:
        n = int(df["_n"].iloc[0])
        medians = {int(k): rows.sort_values("_c")["_m"].to_numpy(dtype=float) for k, rows in df.groupby("_top")}
        return pd.DataFrame([[*df[group].iloc[0], unmixing(medians, n).tolist()]], columns=[*group, "matrix"])

    inside = reads.where((F.col("cell") > 0) & F.col("values").isNotNull())
    # missing and undefined values count as the brightest and make a median undefined, as in numpy
    nan = F.lit(float("nan"))
    rows = inside.select(*group, F.explode("values").alias("_v")).withColumn("_v", F.transform("_v", lambda x: F.coalesce(x, nan)))
    tops = rows.select(*group, (F.array_position("_v", F.array_max("_v")) - 1).alias("_top"), F.size("_v").alias("_n"), F.posexplode("_v").alias("_c", "_x"))
    median = F.when(F.max(F.isnan("_x")), nan).otherwise(F.percentile("_x", F.lit(0.5)))
    fits = tops.groupBy(*group, "_top", "_c").agg(F.max("_n").alias("_n"), median.alias("_m")).groupBy(*group).applyInPandas(fit, schema)
    product = lambda v: F.transform("matrix", lambda row: F.aggregate(F.zip_with(row, v, lambda a, b: a * b), F.lit(0.0), lambda s, x: s + x).cast("int").cast("double"))
    return reads.join(fits, group).withColumn("values", F.transform("values", product)).drop("matrix")


def called(reads: DataFrame, channels: list[str] = CHANNELS) -> DataFrame:
    """barcode, Q (by cycle) and Q_min of reads with values."""
    names = F.array(*[F.lit(c) for c in sorted(channels)])
    out = reads.where("values IS NOT NULL").withColumns({"barcode": F.array_join(F.transform("values", lambda v: argmax_base(v, names)), ""), "Q": F.transform("values", base_quality)})
    return out.withColumn("Q_min", F.array_min("Q")).drop("values")


def call_reads(bases: DataFrame, group: list[str], channels: list[str] = CHANNELS) -> DataFrame:
    """Reads with barcodes from long intensities; groups without a read inside a cell give none."""
    return called(corrected(cubes(bases, [*group, "read", "cell"]), group), channels)


def channel_normalised(bases: DataFrame, group: list[str]) -> DataFrame:
    """Intensities divided by their channel's median."""
    med = bases.groupBy(*group, "channel").agg(F.percentile("intensity", F.lit(0.5)).alias("_m"))
    return bases.join(med, [*group, "channel"]).withColumn("intensity", F.col("intensity") / F.nullif(F.col("_m"), F.lit(0.0))).drop("_m")


def unpivoted(wide: DataFrame, keys: list[str], channels: list[str]) -> DataFrame:
    """Wide intensities as long rows."""
    return wide.unpivot(keys, channels, "channel", "intensity")


def mixture(values: np.ndarray, rounds: int = 200) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Weights, means and deviations of two Gaussians by expectation maximisation, the lower mean first."""
    x = np.asarray(values, dtype=float)
    mean, sd, weight = np.percentile(x, [25, 75]).astype(float), np.full(2, x.std() or 1.0), np.full(2, 0.5)
    for _ in range(rounds):
        p = weight * np.exp(-0.5 * ((x[:, None] - mean) / sd) ** 2) / sd + 1e-300
        p /= p.sum(axis=1, keepdims=True)
        n = p.sum(axis=0) + 1e-12
        new = (p * x[:, None]).sum(axis=0) / n
        sd = np.sqrt((p * (x[:, None] - new) ** 2).sum(axis=0) / n) + 1e-9
        weight, done = n / len(x), np.allclose(new, mean, rtol=1e-10)
        mean = new
        if done:
            break
    order = np.argsort(mean)
    return weight[order], mean[order], sd[order]
