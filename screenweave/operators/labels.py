"""Merging of labels: connected components by joins, compact numbering."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from screenweave.operators.ordered import dense
from screenweave.operators.scratch import saved


def merged(pairs: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(label, root): the smallest label that pairs connect with it. Labels jump to their root's root in each round, so rounds grow with the logarithm."""
    edges = saved(pairs.select(F.col(a).alias("x"), F.col(b).alias("y")).unionAll(pairs.select(F.col(b), F.col(a))).dropna().distinct(), "labels")
    now = saved(edges.groupBy(F.col("x").alias("label")).agg(F.least(F.min("y"), F.col("x")).alias("root")), "labels")
    while True:
        near = edges.join(now, edges["y"] == now["label"]).groupBy("x").agg(F.min("root").alias("near"))
        step = now.join(near, now["label"] == near["x"], "left").select("label", F.least("root", F.coalesce("near", "root")).alias("root"))
        jump = step.select(F.col("label").alias("root"), F.col("root").alias("up"))
        after = saved(step.join(jump, "root", "left").select("label", F.coalesce("up", "root").alias("root")), "labels")
        moved = after.join(now.withColumnRenamed("root", "old"), "label").where("root <> old").limit(1).count()
        now = after
        if not moved:
            return now


def compact(df: DataFrame, label: str = "root", name: str = "compact") -> DataFrame:
    """Labels numbered 1..n in their order, in ranges of labels side by side."""
    return df.join(dense(df, label, name), label)
