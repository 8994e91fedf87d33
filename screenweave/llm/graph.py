"""Connected components of an edge table, in rounds of DataFrame joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from screenweave.llm.common import dropped, written


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of the undirected edges (a, b): component is the smallest node of its component.

    Large-star and small-star rounds: each round links a node's neighbours to the least of them, until every node is
    linked straight to its root. A round is two aggregations and two joins of the edges, no matter how large a component is; its table
    is written to the shared folder, which cuts the lineage. The number of rounds grows with the logarithm of the
    longest path. Self-links and repeated edges are fine; null ends are dropped.
    """

    def star(e: DataFrame, large: bool) -> DataFrame:
        ends = e.select("a", "b").unionAll(e.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = ends.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        linked = ends.join(least, "a")
        if large:
            return linked.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        return linked.select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").unionAll(least.select("a", F.col("m").alias("b"))).where("a <> b").distinct()

    # written first, as it is read twice: for the nodes and for the rounds
    given = written(edges.select(F.col("a").cast("long"), F.col("b").cast("long")).dropna().distinct(), "given")
    nodes = given.select(F.col("a").alias("node")).unionAll(given.select(F.col("b").alias("node"))).distinct()
    now = written(given.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "edges")
    seal = None
    while True:
        after = written(star(star(now, True), False), "edges")
        found = after.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)")).alias("h")).first()
        dropped(now)
        now = after
        if seal == (found["n"], found["h"]):
            break
        seal = (found["n"], found["h"])
    roots = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return nodes.join(roots.groupBy("node").agg(F.min("component").alias("component")), "node", "left").select("node", F.coalesce("component", "node").alias("component"))
