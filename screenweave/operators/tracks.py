"""Queries on track graphs: nodes (id, t, y, x, tracklet_id) and directed edges (src, dst)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W


def degrees(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Every node with the numbers of edges that enter and leave it."""
    ends = edges.select(F.col("src").alias("id"), F.lit(1).alias("o"), F.lit(0).alias("i")).unionAll(edges.select(F.col("dst").alias("id"), F.lit(0), F.lit(1)))
    return nodes.join(ends.groupBy("id").agg(F.sum("o").alias("out_degree"), F.sum("i").alias("in_degree")), "id", "left").fillna(0, ["out_degree", "in_degree"])


def graph_stats(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Nodes, edges, divisions (two or more successors), appearances after the first frame and disappearances before the last."""
    d = degrees(nodes, edges).crossJoin(F.broadcast(nodes.agg(F.min("t").alias("_lo"), F.max("t").alias("_hi"))))
    return d.agg(F.count("*").alias("nodes"), F.sum("out_degree").alias("edges"), F.count_if(F.col("out_degree") >= 2).alias("divisions"), F.count_if((F.col("in_degree") == 0) & (F.col("t") > F.col("_lo"))).alias("appearances"), F.count_if((F.col("out_degree") == 0) & (F.col("t") < F.col("_hi"))).alias("disappearances"))


def movement(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Edges with source frame, tracklet and length."""
    n = nodes.select("id", "t", "y", "x", "tracklet_id")
    a = n.select(*[F.col(c).alias(f"{c}_s") for c in n.columns])
    b = n.select(*[F.col(c).alias(f"{c}_d") for c in ("id", "y", "x")])
    moved = edges.join(a, F.col("src") == F.col("id_s")).join(b, F.col("dst") == F.col("id_d"))
    return moved.select("src", "dst", F.col("t_s").alias("t"), F.col("tracklet_id_s").alias("tracklet_id"), F.hypot(F.col("y_d") - F.col("y_s"), F.col("x_d") - F.col("x_s")).alias("distance"))


def movement_stats(moved: DataFrame, keys: list[str] = ()) -> DataFrame:
    return moved.groupBy(*keys).agg(F.avg("distance").alias("mean"), F.percentile("distance", F.lit(0.5)).alias("median"), F.stddev_pop("distance").alias("std"), F.min("distance").alias("min"), F.max("distance").alias("max"), F.count("*").alias("n"))


def track_lengths(moved: DataFrame) -> DataFrame:
    """Total distance of each tracklet; edges without one don't count."""
    return moved.dropna(subset=["tracklet_id"]).groupBy("tracklet_id").agg(F.sum("distance").alias("distance"), F.count("*").alias("steps"))


def full_length(nodes: DataFrame, edges: DataFrame, frames: int) -> DataFrame:
    """Paths (id_0, ..., id_k) of one node in each of `frames` consecutive frames from the first on: frames - 1 joins."""
    start = nodes.agg(F.min("t").alias("t0"))
    path = nodes.join(F.broadcast(start), F.col("t") == F.col("t0")).select(F.col("id").alias("id_0"))
    for k in range(1, frames):
        path = path.join(edges.select(F.col("src").alias(f"id_{k - 1}"), F.col("dst").alias(f"id_{k}")), f"id_{k - 1}")
    return path.select(*[f"id_{k}" for k in range(frames)])


def lineage_agreement(cells: DataFrame, key: str, barcode: str) -> DataFrame:
    """Of keys with several rows, how many there are and how many have one valid barcode only ("0" and null are none)."""
    valid = F.when(F.col(barcode) != "0", F.col(barcode))
    by = cells.dropna(subset=[key]).groupBy(key).agg(F.count("*").alias("rows"), F.countDistinct(valid).alias("codes")).where("rows > 1")
    return by.agg(F.count("*").alias("shared"), F.count_if(F.col("codes") == 1).alias("matching"))


def tracked_loss(total: DataFrame, tracked: DataFrame, keys: list[str]) -> DataFrame:
    """Cells and tracked cells by tile, loss in percent, and the loss rescaled to 0..1 over all tiles."""
    both = total.join(tracked.withColumnRenamed("n", "tracked"), keys, "left").fillna(0, ["tracked"])
    loss = both.withColumn("loss_pct", F.coalesce(100 * (F.col("n") - F.col("tracked")) / F.nullif(F.col("n"), F.lit(0)), F.lit(0.0)))
    span = loss.agg(F.min("loss_pct").alias("_lo"), F.max("loss_pct").alias("_hi"))
    return loss.crossJoin(F.broadcast(span)).withColumn("rescaled", F.coalesce((F.col("loss_pct") - F.col("_lo")) / F.nullif(F.col("_hi") - F.col("_lo"), F.lit(0.0)), F.lit(0.0))).drop("_lo", "_hi")


def greedy_links(candidates: DataFrame) -> DataFrame:
    """One-to-one links from scored candidates (src, dst, score): mutual best only. An assignment solver is an external step."""
    best = lambda a, b: F.row_number().over(W.partitionBy(a).orderBy(F.desc("score"), b))
    return candidates.withColumns({"_a": best("src", "dst"), "_b": best("dst", "src")}).where("_a = 1 AND _b = 1").drop("_a", "_b")


def widened(points: DataFrame, key: str, times: list[int], values: list[str]) -> DataFrame:
    """One row for each key with `{value}_t{k}` columns: a pivot in one aggregation instead of a join for each time."""
    return points.groupBy(key).agg(*[F.max(F.when(F.col("t") == t, F.col(v))).alias(f"{v}_t{t}") for t in times for v in values])
