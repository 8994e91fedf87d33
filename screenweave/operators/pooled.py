"""Effect sizes of guides by bins of a metric, pooled over experiments in two passes whose partial results merge.

Pass A counts an experiment's values of the metric (`metric_counts`); the bins' global edges come from the summed counts (`edges`). Pass B
sums an experiment's vectors and unit vectors by guide and fine cell of the metric (`partials`), and describes its control rows
(`controls`). Fine cells don't depend on the edges, so an experiment that is added writes its own partial results and nobody
else's (`stored`). `effects` merges the partial results: z-scores against each experiment's own controls follow from the sums.

Bins: strategy `fixed` has edges evenly from 0 to 1; `integer` has edges from 0 in steps of max(1, ceil(ceil(p95) / bins)), one more if the
largest value lies beyond. Only the range from the first to the last bin that holds a value (right-closed) is used; values on
an inner edge then belong to the upper bin, values outside to the first or last one.

Native effects take guides with two bins or more, all their rows. Downsampled ones take guides with all bins and at least `least` rows in
each; bins with more rows than the guide's least bin are cut to as many, shared out over the experiments in proportion (largest
remainders, ties by experiment).

Defined results: rows without guide, metric or vector are left out, as are experiments with fewer than two control rows. Zero vectors have a
unit vector of zeros; a deviation of 0 (or of one row) counts as 1. No rows give no effects.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from screenweave.functions.expressions import finite


def metric_counts(cells: DataFrame, metric: str, experiment: str = "experiment") -> DataFrame:
    """(experiment, value, n) of the rows that aren't controls."""
    rows = cells.where(finite(F.col(metric)) & ~F.coalesce(F.col("control"), F.lit(False)))
    return rows.groupBy(F.col(experiment).alias("experiment"), F.col(metric).cast("double").alias("value")).agg(F.count("*").alias("n"))


def edges(counts: DataFrame, strategy: str = "fixed", bins: int = 5) -> list[float]:
    """The edges of the bins in use; fewer than two bins are an error. What reaches the driver is two numbers and the occupied bins."""
    if strategy == "fixed":
        found = [round(k / bins, 10) for k in range(bins + 1)]
    elif strategy == "integer":
        by_value = counts.groupBy("value").agg(F.sum("n").alias("n"))
        p95, top = by_value.agg(F.percentile("value", F.lit(0.95), F.col("n")), F.max("value")).first()
        width = max(1, math.ceil(max(1, math.ceil(p95 or 0)) / bins))
        found = [float(k * width) for k in range(bins + 1)]
        if top is not None and found[-1] < top:
            found.append(found[-1] + width)
    else:
        raise ValueError(f"no such strategy: {strategy}")
    # right-closed, the lowest edge included
    place = sum((F.when(F.col("value") > e, 1).otherwise(0) for e in found[1:-1]), F.lit(0))
    inside = counts.where((F.col("value") >= found[0]) & (F.col("value") <= found[-1]))
    used = sorted(r[0] for r in inside.select(place.alias("bin")).distinct().collect())
    if len(used) < 2:
        raise ValueError("fewer than two bins hold a value")
    return found[used[0] : used[-1] + 2]


def _fine(metric: str, strategy: str, bins: int) -> Column:
    """The metric up to what tells bins apart: its place among all edges, or the whole number below it."""
    v = F.col(metric).cast("double")
    return (sum((F.when(v >= round(k / bins, 10), 1).otherwise(0) for k in range(1, bins)), F.lit(0)) if strategy == "fixed" else F.floor(v)).cast("long")


def _exploded(cells: DataFrame, vector: str) -> DataFrame:
    norm = F.sqrt(F.aggregate(vector, F.lit(0.0), lambda s, x: s + x * x))
    rows = cells.withColumns({"_v": F.transform(vector, lambda x: x.cast("double")), "_n": F.when(norm == 0, 1.0).otherwise(norm)})
    return rows.select("*", F.posexplode("_v").alias("dim", "x")).withColumn("u", F.col("x") / F.col("_n")).drop("_v", "_n", vector)


def controls(cells: DataFrame, vector: str, experiment: str = "experiment") -> DataFrame:
    """(experiment, dim, n, mean, std, unit) of the control rows: mean, deviation (n - 1; 0 is 1) and mean unit vector."""
    rows = _exploded(cells.where(F.col("control") & F.col(vector).isNotNull()).select(F.col(experiment).alias("experiment"), F.col(vector).cast("array<double>").alias(vector)), vector)
    std = F.stddev_samp("x")
    return rows.groupBy("experiment", "dim").agg(F.count("*").alias("n"), F.avg("x").alias("mean"), F.when(std > 0, std).otherwise(1.0).alias("std"), F.avg("u").alias("unit")).where("n >= 2")


def partials(cells: DataFrame, metric: str, vector: str, strategy: str = "fixed", bins: int = 5, experiment: str = "experiment") -> DataFrame:
    """(experiment, guide, gene, cell, dim, n, x, u): sums of vectors and unit vectors of the rows that aren't controls."""
    good = cells.where(F.col("guide").isNotNull() & finite(F.col(metric)) & F.col(vector).isNotNull() & ~F.coalesce(F.col("control"), F.lit(False)))
    rows = good.select(F.col(experiment).alias("experiment"), "guide", "gene", _fine(metric, strategy, bins).alias("cell"), F.col(vector).cast("array<double>").alias(vector))
    return _exploded(rows, vector).groupBy("experiment", "guide", "cell", "dim").agg(F.min("gene").alias("gene"), F.count("*").alias("n"), F.sum("x").alias("x"), F.sum("u").alias("u"))


def stored(df: DataFrame, path: str) -> None:
    """Writes partial results into one table of all experiments: the partitions of the experiments in `df` are replaced, others stay as they are."""
    df.write.partitionBy("experiment").mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)


def direction(control: DataFrame) -> DataFrame:
    """(dim, g): the experiments' unit control centroids, weighted by their rows, scaled to length 1."""
    own = control.groupBy("experiment").agg(F.sqrt(F.sum(F.col("unit") ** 2)).alias("_l"))
    mean = control.join(own, "experiment").withColumn("_q", F.coalesce(F.col("unit") / F.nullif(F.col("_l"), F.lit(0.0)), F.lit(0.0)))
    pooled = mean.groupBy("dim").agg((F.sum(F.col("_q") * F.col("n")) / F.sum("n")).alias("_g"))
    norm = pooled.agg(F.sqrt(F.sum(F.col("_g") ** 2)).alias("_norm"))
    return pooled.crossJoin(F.broadcast(norm)).select("dim", F.coalesce(F.col("_g") / F.nullif(F.col("_norm"), F.lit(0.0)), F.lit(0.0)).alias("g"))


def effects(partial: DataFrame, control: DataFrame, used: list[float], strategy: str = "fixed", bins: int = 5, least: int = 10, downsample: bool = False) -> DataFrame:
    """(guide, gene, bin, n: rows of the bin, taken: rows that count, experiments, cohens_d, cosine_distance)."""
    last = len(used) - 2
    if strategy == "fixed":
        first = round(used[0] * bins)
        at = F.greatest(F.lit(0), F.least(F.lit(last), F.col("cell") - first))
    else:
        at = sum((F.when(F.col("cell") >= e, 1).otherwise(0) for e in used[1:-1]), F.lit(0))
    known = partial.join(control.select("experiment", "dim", "mean", "std"), ["experiment", "dim"])
    rows = known.withColumns({"bin": at.cast("int"), "z": (F.col("x") - F.col("n") * F.col("mean")) / F.col("std")}).groupBy("experiment", "guide", "bin", "dim").agg(F.min("gene").alias("gene"), F.sum("n").alias("n"), F.sum("z").alias("z"), F.sum("u").alias("u"))
    parts = rows.where("dim = 0").select("experiment", "guide", "bin", "n")
    whole = parts.groupBy("guide", "bin").agg(F.sum("n").alias("all"))
    by_guide = whole.groupBy("guide").agg(F.count("*").alias("found"), F.min("all").alias("k"))
    if downsample:
        by_guide = by_guide.where((F.col("found") == last + 1) & (F.col("k") >= least))
        exact = F.least(F.col("all"), F.col("k")) * F.col("n") / F.col("all")
        shared = parts.join(whole, ["guide", "bin"]).join(by_guide, "guide").withColumns({"_floor": F.floor(exact), "_rest": exact - F.floor(exact)})
        bin_ = W.partitionBy("guide", "bin")  # a row for each experiment
        open_ = F.least(F.col("all"), F.col("k")) - F.sum("_floor").over(bin_)
        taken = shared.withColumn("taken", F.col("_floor") + F.when(F.row_number().over(bin_.orderBy(F.desc("_rest"), "experiment")) <= open_, 1).otherwise(0)).select("experiment", "guide", "bin", "taken", "all")
    else:
        taken = parts.join(whole, ["guide", "bin"]).join(by_guide.where("found >= 2"), "guide").select("experiment", "guide", "bin", F.col("n").alias("taken"), "all")
    scaled = rows.join(taken, ["experiment", "guide", "bin"]).withColumn("f", F.col("taken") / F.col("n"))
    sums = scaled.groupBy("guide", "bin", "dim").agg(F.min("gene").alias("gene"), F.max("all").alias("n"), F.sum("taken").alias("taken"), F.count_if(F.col("taken") > 0).alias("experiments"), F.sum(F.col("z") * F.col("f")).alias("z"), F.sum(F.col("u") * F.col("f")).alias("u"))
    both = sums.join(direction(control), "dim")
    length = F.sqrt(F.sum(F.col("u") ** 2))
    return both.groupBy("guide", "bin").agg(
        F.min("gene").alias("gene"), F.max("n").alias("n"), F.max("taken").alias("taken"), F.max("experiments").alias("experiments"),
        F.sqrt(F.avg((F.col("z") / F.col("taken")) ** 2)).alias("cohens_d"), (1 - F.coalesce(F.sum(F.col("u") * F.col("g")) / F.nullif(length, F.lit(0.0)), F.lit(0.0))).alias("cosine_distance"),
    )
