"""One-to-one links between nodes that maximise the sum of the links' gains: an auction on the components of the candidates.

Candidates are rows (src, dst, cost). A link's gain is what it saves: a node that disappears and one that appears cost `disappearance +
appearance`, so the gain is that less the cost; links without a gain are never taken. Sources bid for targets: an unlinked source
offers its best target so much that it would be indifferent to its second best one, and EPSILON more; a target takes the highest bid
(ties: the smaller source) and frees the source that it had. It ends when each source has a target or nothing to gain.

Components (found by joins) of up to WHOLE candidates are solved each in one task, those of up to DENSE sources and targets exactly, by
shortest augmenting paths; of larger ones a round of bids is a few joins and aggregations over the candidates, prices
being a small table. An auction's sum is within EPSILON times the number of linked sources of the largest one; with
gains that are multiples of a unit above that product it is the largest.

Defined results: null ends or costs are left out; of repeated candidates the cheapest counts. No candidates give no links.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from screenweave.operators.labels import merged
from screenweave.operators.scratch import saved

WHOLE = 200_000
DENSE = 300
#: Candidates that one task solves, about.
TASK_ROWS = 5_000
EPSILON = 1e-4


def exact(src: np.ndarray, dst: np.ndarray, gain: np.ndarray) -> np.ndarray:
    """Places of the candidates with the largest sum of gains; sources and targets are numbered from 0. A column of its own lets each source stay unlinked."""
    n, m = (int(x.max()) + 1 if len(x) else 0 for x in (src, dst))
    cost = np.full((n, m + n), np.inf)
    cost[:, m:][np.diag_indices(n)] = 0.0
    cost[src, dst] = -gain
    row, column, holds = np.zeros(n), np.zeros(m + n), np.full(m + n, -1)  # holds: the source that has a column
    for s in range(n):
        least, before, closed = np.full(m + n, np.inf), np.full(m + n, -1), np.zeros(m + n, bool)
        at, far, last = s, 0.0, -1
        while True:
            step = far + cost[at] - row[at] - column
            nearer = ~closed & (step < least)
            least[nearer], before[nearer] = step[nearer], last
            last = int(np.argmin(np.where(closed, np.inf, least)))
            far = least[last]
            if holds[last] < 0:
                break
            closed[last] = True
            at = holds[last]
        done = np.flatnonzero(closed)
        row[s] += far
        row[holds[done]] += far - least[done]
        column[done] -= far - least[done]
        while last >= 0:  # the path's sources move one column on
            holds[last] = holds[before[last]] if before[last] >= 0 else s
            last = before[last]
    taken = {(int(holds[t]), t) for t in range(m) if holds[t] >= 0}
    return np.array([k for k, x in enumerate(zip(src.tolist(), dst.tolist())) if x in taken], dtype=int)


def auction(src: np.ndarray, dst: np.ndarray, gain: np.ndarray, epsilon: float) -> np.ndarray:
    """Places of the chosen candidates; sources and targets are numbered from 0, candidates sorted by source and target."""
    n, m = (int(x.max()) + 1 if len(x) else 0 for x in (src, dst))
    at = np.searchsorted(src, np.arange(n + 1))
    price, owner, taken = np.zeros(m), np.full(m, -1), np.full(n, -1)
    waiting = list(range(n))[::-1]
    while waiting:
        s = waiting.pop()
        span = slice(at[s], at[s + 1])
        net = gain[span] - price[dst[span]]
        best = int(np.argmax(net))
        if net[best] <= 0:
            continue  # nothing to gain, now or later: prices only rise
        second = max(0.0, float(np.partition(net, -2)[-2]) if len(net) > 1 else 0.0)
        t = int(dst[span][best])
        price[t] += net[best] - second + epsilon
        if owner[t] >= 0:
            taken[owner[t]] = -1
            waiting.append(int(owner[t]))
        owner[t], taken[s] = s, at[s] + best
    return taken[taken >= 0]


def _whole(candidates: DataFrame, kinds: tuple[str, str], epsilon: float) -> DataFrame:
    """Links of whole components; a task takes many small ones."""

    def solve(df: pd.DataFrame) -> pd.DataFrame:
        df = df.sort_values(["component", "src", "dst"], ignore_index=True)
        component, src, dst, gain = (df[c].to_numpy() for c in ("component", "src", "dst", "gain"))
        cut = np.flatnonzero(np.concatenate([[True], component[1:] != component[:-1], [True]]))
        chosen = []
        for i, j in zip(cut[:-1], cut[1:]):
            if j - i == 1:
                chosen.append([i])
                continue
            s, t = (np.unique(x[i:j], return_inverse=True)[1] for x in (src, dst))
            chosen.append(i + (exact(s, t, gain[i:j]) if max(s.max(), t.max()) < DENSE else auction(s, t, gain[i:j], epsilon)))
        return df.loc[np.concatenate(chosen), ["src", "dst", "cost", "gain"]]

    tasks = max(1, -(-candidates.count() // TASK_ROWS))
    dealt = candidates.withColumn("_task", F.pmod(F.xxhash64("component"), F.lit(tasks)))
    return dealt.groupBy("_task").applyInPandas(solve, f"src {kinds[0]}, dst {kinds[1]}, cost double, gain double")


def _rounds(candidates: DataFrame, epsilon: float) -> DataFrame:
    """The auction over tables: links (src, dst) and prices (dst, price) change from round to round."""
    links = saved(candidates.select("src", "dst", F.lit(0.0).alias("price")).limit(0), "auction")
    while True:
        offers = candidates.join(links.select("src", F.lit(True).alias("_linked")), "src", "left").where("_linked IS NULL").drop("_linked")
        net = offers.join(links.select("dst", "price"), "dst", "left").withColumn("price", F.coalesce("price", F.lit(0.0))).withColumn("net", F.col("gain") - F.col("price"))
        two = net.withColumn("_k", F.row_number().over(W.partitionBy("src").orderBy(F.desc("net"), "dst"))).where("_k <= 2")
        of = lambda k, c: F.max(F.when(F.col("_k") == k, F.col(c)))
        top = two.groupBy("src").agg(of(1, "dst").alias("dst"), of(1, "net").alias("net"), of(1, "price").alias("price"), F.greatest(F.coalesce(of(2, "net"), F.lit(0.0)), F.lit(0.0)).alias("second"))
        bids = top.where("net > 0").select("src", "dst", (F.col("price") + F.col("net") - F.col("second") + epsilon).alias("price"))
        won = saved(bids.groupBy("dst").agg(F.max_by("src", F.struct("price", -F.col("src"))).alias("src"), F.max("price").alias("price")).select("src", "dst", "price"), "auction")
        if won.isEmpty():
            return candidates.join(links.select("src", "dst"), ["src", "dst"]).select("src", "dst", "cost", "gain")
        links = saved(links.join(won.select("dst"), "dst", "left_anti").select("src", "dst", "price").unionByName(won), "auction")


def linked(candidates: DataFrame, appearance: float = 0.5, disappearance: float = 0.5, epsilon: float = EPSILON) -> DataFrame:
    """(src, dst, cost, gain) of the chosen links. Sources and targets are different nodes, even where their ids are equal; ids are numbers."""
    good = candidates.select("src", "dst", F.col("cost").cast("double").alias("cost")).dropna().groupBy("src", "dst").agg(F.min("cost").alias("cost"))
    good = saved(good.withColumn("gain", F.lit(appearance + disappearance) - F.col("cost")).where("gain > 0"), "candidates")
    node = lambda c, side: F.concat(F.lit(side), F.col(c).cast("string"))
    root = merged(good.select(node("src", "s").alias("a"), node("dst", "t").alias("b")))
    own = saved(good.withColumn("label", node("src", "s")).join(root, "label").select(F.col("root").alias("component"), "src", "dst", "cost", "gain"), "candidates")
    large = saved(own.groupBy("component").agg(F.count("*").alias("n")).where(F.col("n") > WHOLE).select("component"), "components")
    kinds = tuple(good.schema[c].dataType.simpleString() for c in ("src", "dst"))
    out = _whole(own.join(large, "component", "left_anti"), kinds, epsilon)
    if not large.isEmpty():
        out = out.unionByName(_rounds(saved(own.join(large, "component", "left_semi").drop("component"), "candidates"), epsilon))
    return out
