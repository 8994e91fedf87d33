"""Mixtures of two Gaussians by group: expectation maximisation whose every step is one aggregation.

Equal values of a group are folded into a count first, so an image's rows become its different intensities. A step joins the
groups' few parameters to these rows, weighs each row by the responsibilities, and sums; nothing is gathered by group, so
a group may be of any size. Parameters are a small table, written after every STEPS steps; groups that have converged leave
the join. Values are centred on their group's mean, so that sums of squares don't cancel.

The start is the mean less and plus one deviation, both with the group's deviation. A group has converged when its mean
log-likelihood grew by less than the tolerance. Variances have a floor.

Defined results: null, NaN and infinite values are left out; groups without another value have no row. A group of one
value has two equal components. Null keys are a group of their own.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from screenweave.functions.expressions import finite, signal_metrics
from screenweave.operators.scratch import saved

#: Steps that one job takes.
STEPS = 4
#: Up to so many groups their parameters are sent to the rows; beyond, rows and parameters meet by a shuffle.
SENT = 20_000
_PARAMETERS = ["w", "m0", "s0", "m1", "s1", "ll", "rounds", "done"]


def _matched(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """An inner join in which null keys meet."""
    renamed = right.withColumnsRenamed({k: f"_k_{k}" for k in keys})
    on = F.lit(True)
    for k in keys:
        on = on & left[k].eqNullSafe(renamed[f"_k_{k}"])
    return left.join(renamed, on).drop(*[f"_k_{k}" for k in keys])


def _step(rows: DataFrame, now: DataFrame, keys: list[str], tolerance: float, floor: float) -> DataFrame:
    """The parameters after one more step; w is the lower component's weight."""
    log = lambda w, m, s: F.log(w) - F.log(s) - (F.col("z") - F.col(m)) ** 2 / (2 * F.col(s) ** 2)
    both = _matched(rows, now, keys).withColumns({"a": log(F.col("w"), "m0", "s0"), "b": log(1 - F.col("w"), "m1", "s1")})
    both = both.withColumns({"p": 1 / (1 + F.exp(F.col("b") - F.col("a"))), "l": F.greatest("a", "b") + F.log1p(F.exp(-F.abs(F.col("a") - F.col("b")))) - 0.5 * math.log(2 * math.pi)})
    n, p = F.col("n"), F.col("p")
    sums = {"_n": n, "_p": n * p, "_pz": n * p * F.col("z"), "_pzz": n * p * F.col("z") ** 2, "_z": n * F.col("z"), "_zz": n * F.col("z") ** 2, "_l": n * F.col("l")}
    out = both.groupBy(*keys).agg(*[F.sum(v).alias(k) for k, v in sums.items()], F.max(F.struct(*_PARAMETERS)).alias("old"))
    deviation = lambda zz, z, k: F.sqrt(F.greatest(zz / k - (z / k) ** 2, F.lit(0.0)) + floor)
    k0, k1 = F.greatest("_p", F.lit(1e-12)), F.greatest(F.col("_n") - F.col("_p"), F.lit(1e-12))
    z1, zz1 = F.col("_z") - F.col("_pz"), F.col("_zz") - F.col("_pzz")
    ll = F.col("_l") / F.col("_n")
    share = F.least(F.greatest(F.col("_p") / F.col("_n"), F.lit(1e-12)), F.lit(1 - 1e-12))
    new = F.struct(
        share.alias("w"), (F.col("_pz") / k0).alias("m0"), deviation(F.col("_pzz"), F.col("_pz"), k0).alias("s0"), (z1 / k1).alias("m1"), deviation(zz1, z1, k1).alias("s1"),
        ll.alias("ll"), (F.col("old.rounds") + 1).alias("rounds"), F.coalesce(F.abs(ll - F.col("old.ll")) < tolerance, F.lit(False)).alias("done"),
    )
    return out.select(*keys, F.when(F.col("old.done"), F.col("old")).otherwise(new).alias("now")).select(*keys, "now.*")


def fit(df: DataFrame, keys: list[str], value: str, tolerance: float = 1e-3, most: int = 100, floor: float = 1e-6) -> DataFrame:
    """By key: n, and weight, mean and deviation of the lower and the higher component, the number of steps, and whether they converged."""
    x = F.col(value).cast("double")
    counts = saved(df.where(finite(x)).groupBy(*keys, x.alias("_x")).agg(F.count("*").alias("n")), "mixture_counts")
    center = counts.groupBy(*keys).agg(F.sum("n").alias("total"), (F.sum(F.col("n") * F.col("_x")) / F.sum("n")).alias("center"))
    rows = saved(_matched(counts, center, keys).select(*keys, (F.col("_x") - F.col("center")).alias("z"), "n"), "mixture_rows")
    spread = F.sqrt(F.sum(F.col("n") * F.col("z") ** 2) / F.sum("n"))
    begin = rows.groupBy(*keys).agg(spread.alias("_s")).withColumn("_d", F.sqrt(F.col("_s") ** 2 + floor))
    now = begin.select(*keys, F.lit(0.5).alias("w"), (-F.col("_s")).alias("m0"), F.col("_d").alias("s0"), F.col("_s").alias("m1"), F.col("_d").alias("s1"), F.lit(None).cast("double").alias("ll"), F.lit(0).alias("rounds"), F.lit(False).alias("done"))
    now, taken = saved(now, "mixture"), 0
    near = F.broadcast if now.count() <= SENT else lambda df: df  # else each step shuffles all rows, by as many keys as there are groups
    while taken < most and not now.where("not done").isEmpty():
        left = now.where("not done")
        for _ in range(min(STEPS, most - taken)):
            left = _step(rows, near(left), keys, tolerance, floor)
        now, taken = saved(now.where("done").unionByName(left), "mixture"), taken + STEPS
    out = _matched(now, center, keys)
    swap = F.col("m0") > F.col("m1")
    pick = lambda a, b: F.when(swap, b).otherwise(a)
    return out.select(
        *keys, F.col("total").alias("n"), pick(F.col("w"), 1 - F.col("w")).alias("low_weight"), (F.col("center") + pick(F.col("m0"), F.col("m1"))).alias("low_mean"), pick(F.col("s0"), F.col("s1")).alias("low_sd"),
        pick(1 - F.col("w"), F.col("w")).alias("high_weight"), (F.col("center") + pick(F.col("m1"), F.col("m0"))).alias("high_mean"), pick(F.col("s1"), F.col("s0")).alias("high_sd"), "rounds", F.col("done").alias("converged"),
    )


def signal_table(fits: DataFrame, keys: list[str]) -> DataFrame:
    """Signal and Background rows of fitted groups, in the shape of a signal table: the higher component is the signal."""
    top = F.col("high_mean") + 1.28 * F.col("high_sd")  # the 90th percentile of a Gaussian
    row = lambda kind, side, top: F.struct(F.lit(kind).alias("type"), F.col(f"{side}_mean").alias("mean"), F.col(f"{side}_sd").alias("std"), F.floor(F.col(f"{side}_weight") * F.col("n")).cast("long").alias("count"), F.col(f"{side}_mean").alias("median"), top.alias("median_top"))
    return fits.select(*keys, F.explode(F.array(row("Signal", "high", top), row("Background", "low", F.lit(None).cast("double")))).alias("row")).select(*keys, "row.*")


def separation(fits: DataFrame, keys: list[str]) -> DataFrame:
    """By key: snr (not below 0; 0 without deviation of the background), sbr, lld and z-prime of the higher component against the lower one."""
    m = signal_metrics(F.col("high_mean"), F.col("low_mean"), F.col("high_sd"), F.col("low_sd"))
    snr: Column = F.when(F.col("low_sd") > 0, F.greatest((F.col("high_mean") - F.col("low_mean")) / F.col("low_sd"), F.lit(0.0))).otherwise(0.0)
    return fits.withColumn("_m", m).select(*keys, "n", snr.alias("snr"), *[F.col(f"_m.{c}").alias(c) for c in ("sbr", "lld", "z_prime")])
