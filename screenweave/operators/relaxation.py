"""Graph-consistent matching by relaxation labelling: candidate pairs of points vote for each other until their scores settle.

Points of two sides that lie within a radius are candidate pairs. A pair (a, b) is supported by a pair (p, q) if p is one of a's k nearest
neighbours, q one of b's, and the offsets a to p and b to q agree within the tolerance. In each round a pair's score is multiplied by a
floor plus the mean score of its supporters (the best one for each neighbour p), and the scores of a point's pairs are scaled to sum 1
together with a share for having no partner.

A plane (the points of one key) of up to WHOLE points is solved in one task, from arrays. Larger ones, and those so dense that a task would
compare more than WORK pairs of points, go by tables: the support table is made once, by joins on neighbours; a round is a join and two
aggregations over it. These tables grow with the input, so their joins are by sort and merge: stored sizes, by which Spark would choose to broadcast one, are small beside
what it takes in the driver's memory. Pairs that are their points' best on both sides and hold `least` of the share are the matches.

Defined results: points without id, finite coordinates or a key have no pairs and are no neighbours; with fewer than k others all of them are neighbours. Ties go to the nearer
pair, then to the smaller ids. Ids are unique by key on each side.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructType
from pyspark.sql.window import Window as W

from screenweave.operators.leaves import finite
from screenweave.operators.scratch import saved
from screenweave.operators.spatial import nearest, within

#: Points of both sides of a plane that one task solves; pairs of points that it compares at most, and at once; of the most, the part that it may hold as supports.
WHOLE, WORK, AT_ONCE, HELD = 300_000, 100_000_000, 2_000_000, 20


class Dense(Exception):
    """A plane has more pairs than one task should compare."""


def _spread(low: np.ndarray, many: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of ranges low[k], low[k] + 1, ... of many[k] numbers, each number and its k."""
    k = np.repeat(np.arange(len(many)), many)
    return low[k] + np.arange(len(k)) - np.repeat(np.cumsum(many) - many, many), k


def _chunks(many: np.ndarray) -> Iterator[slice]:
    """Slices whose sum is AT_ONCE or a little more."""
    upto = np.cumsum(many)
    begin = 0
    while begin < len(many):
        end = int(np.searchsorted(upto, (upto[begin - 1] if begin else 0) + AT_ONCE)) + 1
        yield slice(begin, end)
        begin = end


def _close(p: np.ndarray, q: np.ndarray, side: float, work: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(i, j, squared distance) of each point of p and those of q in the 3 x 3 cells around its own; all of a point in one piece. p, q: (2, n)."""
    if not q.shape[1]:
        return
    (py, px), (qy, qx) = np.floor(p / side), np.floor(q / side)
    rows, columns = np.unique(qy), np.unique(qx)
    code = np.searchsorted(rows, qy) * len(columns) + np.searchsorted(columns, qx)
    order = np.argsort(code, kind="stable")
    code = code[order]
    left, right = np.searchsorted(columns, px - 1), np.searchsorted(columns, px + 1, side="right")
    low, many = [], []
    for k in (-1, 0, 1):
        row = np.minimum(np.searchsorted(rows, py + k), len(rows) - 1)
        there = rows[row] == py + k
        low.append(np.searchsorted(code, row * len(columns) + left))
        many.append(np.where(there, np.searchsorted(code, row * len(columns) + right) - low[-1], 0))
    low, many = np.stack(low, axis=1), np.stack(many, axis=1)
    if many.sum() > work:
        raise Dense
    for part in _chunks(many.sum(axis=1)):
        at, k = _spread(low[part].ravel(), many[part].ravel())
        i, j = part.start + k // 3, order[at]
        yield i, j, (p[0, i] - q[0, j]) ** 2 + (p[1, i] - q[1, j]) ** 2


def _nearest(p: np.ndarray, reach: float, k: int, work: int) -> tuple[np.ndarray, np.ndarray]:
    """(neighbours, where each point's begin) of the k nearest others within the reach; ties by number."""
    n = p.shape[1]
    # of points at one place only the first k + 1 can be among a point's nearest
    order = np.lexsort((p[1], p[0]))
    new = np.r_[True, (p[:, order][:, 1:] != p[:, order][:, :-1]).any(axis=0)][:n]
    first = np.flatnonzero(new)
    some = np.sort(order[np.arange(n) - first[np.cumsum(new) - 1] <= k]) if n else order
    span = np.ptp(p, axis=1) if n else np.zeros(2)
    side = min(reach, max(float(np.sqrt(span[0] * span[1] * (k + 1) / max(1, len(some)))), reach / 2**13))
    left, found = np.arange(n), []
    while len(left):
        more = []
        for i, j, d in _close(p[:, left], p[:, some], side * (1 + 1e-9), work):
            i, j = left[i], some[j]
            near = (d <= min(side, reach) ** 2) & (i != j)
            i, j, far = i[near], j[near], np.sqrt(d[near])
            order = np.lexsort((j, far, i))
            i, j = i[order], j[order]
            place = np.arange(len(i)) - np.searchsorted(i, i)
            keep = place < k
            more.append((i[keep], j[keep]))
        i, j = (np.concatenate([x[s] for x in more]) if more else np.zeros(0, np.int64) for s in (0, 1))
        done = np.bincount(i, minlength=n) >= k if side < reach else np.ones(n, bool)
        found.append((i[done[i]], j[done[i]]))
        left, side = left[~done[left]], min(reach, side * 2)
    i, j = (np.concatenate([x[s] for x in found]) if found else np.zeros(0, np.int64) for s in (0, 1))
    order = np.argsort(i, kind="stable")
    return j[order], np.searchsorted(i[order], np.arange(n + 1))


def _solved(p: np.ndarray, q: np.ndarray, work: int, radius: float, reach: float, k: int, tolerance: float, rounds: int, least: float, floor: float) -> tuple[np.ndarray, ...]:
    """(i, j, distance, score) of the matches of points p and q, (2, n), in the order of their ids."""
    pairs, compared = [], 0
    for i, j, d in _close(p, q, radius, work):
        near = np.sqrt(d) <= radius
        pairs.append((i[near], j[near], np.sqrt(d[near])))
        compared += 1 + int(near.sum()) * k * k
        if compared > work:
            raise Dense
    if not pairs:
        return (np.zeros(0, np.int64),) * 2 + (np.zeros(0),) * 2
    i, j, distance = (np.concatenate([x[s] for x in pairs]) for s in range(3))
    order = np.lexsort((j, i))
    i, j, distance = i[order], j[order], distance[order]
    code, n = i * q.shape[1] + j, p.shape[1]
    (ta, sa), (tb, sb) = _nearest(p, reach, k, work), _nearest(q, reach, k, work)
    na, nb = np.diff(sa), np.diff(sb)
    # the pairs (to a neighbour of i, to one of j) that are pairs, and how well the offsets agree
    held: list[tuple[np.ndarray, ...]] = []
    for part in _chunks(na[i] * nb[j]):
        at, t = _spread(sa[i[part]], na[i[part]])  # a row for each neighbour of i
        t += part.start
        bt, u = _spread(sb[j[t]], nb[j[t]])  # and one for each of j
        a, b, own, slot = ta[at][u], tb[bt], t[u], at[u]
        off = np.hypot((p[0, a] - p[0, i[own]]) - (q[0, b] - q[0, j[own]]), (p[1, a] - p[1, i[own]]) - (q[1, b] - q[1, j[own]]))
        fit = 1 - off / tolerance
        to = np.minimum(np.searchsorted(code, a * q.shape[1] + b), len(code) - 1)
        good = (fit > 0) & (code[to] == a * q.shape[1] + b)
        held.append((own[good], slot[good], to[good], fit[good]))
        if sum(len(x[0]) for x in held) * HELD > work:
            raise Dense
    own, slot, to, fit = (np.concatenate([x[s] for x in held]) for s in range(4))
    new = np.flatnonzero(np.r_[True, (own[1:] != own[:-1]) | (slot[1:] != slot[:-1])]) if len(own) else np.zeros(0, np.int64)
    score = 1 / (np.bincount(i, minlength=n)[i] + 1)
    for _ in range(rounds):
        best = np.maximum.reduceat(fit * score[to], new) if len(new) else np.zeros(0)
        votes = np.bincount(own[new], best, len(i)) / np.maximum(na[i], 1)
        raised = score * (floor + votes)
        total = np.bincount(i, raised, n) + np.maximum(1 - np.bincount(i, score, n), 0) * floor
        score = raised / total[i]
    chosen = np.flatnonzero(score >= least)
    for side, other in ((i, j), (j, i)):
        chosen = chosen[np.lexsort((other[chosen], distance[chosen], -score[chosen], side[chosen]))]
        chosen = chosen[np.r_[True, side[chosen][1:] != side[chosen][:-1]][: len(chosen)]]
    return i[chosen], j[chosen], distance[chosen], score[chosen]


def _in_tasks(a: DataFrame, b: DataFrame, keys: list[str], *how) -> DataFrame:
    """The matches of planes that a task solves; of one that is too dense, a row without ids."""
    schema = StructType([a.schema[c] for c in keys])
    schema.add("id_a", a.schema["id"].dataType).add("id_b", b.schema["id"].dataType).add("distance", DoubleType()).add("score", DoubleType())
    work = WORK

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        left, right = left.sort_by("id"), right.sort_by("id")
        places = [np.stack([t["_y"].to_numpy(), t["_x"].to_numpy()]) for t in (left, right)]
        try:
            i, j, distance, score = _solved(*places, work, *how)
        except Dense:
            empty = lambda kind: pa.nulls(1, kind)
            return pa.table({c: left[c].slice(0, 1) for c in keys} | {"id_a": empty(left["id"].type), "id_b": empty(right["id"].type), "distance": empty(pa.float64()), "score": empty(pa.float64())})
        left = left.take(pa.array(i))
        return pa.table({c: left[c] for c in keys} | {"id_a": left["id"], "id_b": right["id"].take(pa.array(j)), "distance": distance, "score": score})

    a, b = (x.drop("y", "x") for x in (a, b))
    return a.groupBy(*keys).cogroup(b.groupBy(*keys)).applyInArrow(run, schema)


def _neighbours(points: DataFrame, radius: float, k: int, keys: list[str], s: str) -> DataFrame:
    """(id, neighbour, dy, dx, n: how many neighbours the point has) of the k nearest others."""
    p = points.select(*keys, "id", "y", "x")
    near = nearest(p, p, radius, keys, k + 1).where("id_a <> id_b")
    ranked = near.withColumn("_n", F.row_number().over(W.partitionBy(*keys, "id_a").orderBy("distance", "id_b"))).where(F.col("_n") <= k)
    rows = ranked.select(*keys, F.col("id_a").alias(f"id_{s}"), F.col("id_b").alias(f"to_{s}"), (F.col("y_b") - F.col("y_a")).alias(f"dy_{s}"), (F.col("x_b") - F.col("x_a")).alias(f"dx_{s}"))
    rows = saved(rows, "neighbours")
    return rows.join(rows.groupBy(*keys, f"id_{s}").agg(F.count("*").alias(f"n_{s}")).hint("merge"), [*keys, f"id_{s}"])


def supports(a: DataFrame, b: DataFrame, pairs: DataFrame, reach: float, k: int, tolerance: float, keys: list[str]) -> DataFrame:
    """(id_a, id_b, to_a, to_b, fit): the pairs that support a pair, and how well their offsets agree (1 exactly, 0 at the tolerance)."""
    of = saved(pairs.select(*keys, "id_a", "id_b"), "pairs")
    na, nb = _neighbours(a, reach, k, keys, "a"), _neighbours(b, reach, k, keys, "b")
    both = of.hint("merge").join(na, [*keys, "id_a"]).join(nb.hint("merge"), [*keys, "id_b"])
    off = F.hypot(F.col("dy_a") - F.col("dy_b"), F.col("dx_a") - F.col("dx_b"))
    fits = both.withColumn("fit", 1 - off / tolerance).where("fit > 0").select(*keys, "id_a", "id_b", "to_a", "to_b", "fit", "n_a")
    there = of.select(*keys, F.col("id_a").alias("to_a"), F.col("id_b").alias("to_b"))
    return fits.join(there.hint("merge"), [*keys, "to_a", "to_b"])


def matched(a: DataFrame, b: DataFrame, radius: float, reach: float, k: int = 8, tolerance: float = 3.0, rounds: int = 6, least: float = 0.5, floor: float = 0.05, keys: list[str] = ()) -> DataFrame:
    """(keys..., id_a, id_b, distance, score) of the matches between two sides of points (keys..., id, y, x)."""
    plane = list(keys) or ["_plane"]
    sides = [x.withColumn("_plane", F.lit(0)).select(*plane, "id", "y", "x").dropna(subset=["id"]) for x in (a, b)]
    sides = [finite(x, plane) for x in sides]
    how = (radius, reach, k, tolerance, rounds, least, floor)
    sizes = sides[0].select(*plane).unionByName(sides[1].select(*plane)).groupBy(*plane).agg(F.count("*").alias("n"))
    large = saved(sizes.where(F.col("n") > WHOLE).select(*plane), "large")
    small = sides if large.isEmpty() else [x.join(F.broadcast(large), plane, "left_anti") for x in sides]
    found = saved(_in_tasks(*small, plane, *how), "matches")
    rest = large.unionByName(found.where("id_a IS NULL").select(*plane))
    out = found.where("id_a IS NOT NULL")
    if not rest.isEmpty():
        out = out.unionByName(by_tables(*[x.drop("_y", "_x").join(F.broadcast(rest), plane, "left_semi") for x in sides], *how, plane))
    return out.select(*keys, "id_a", "id_b", "distance", "score")


def by_tables(a: DataFrame, b: DataFrame, radius: float, reach: float, k: int, tolerance: float, rounds: int, least: float, floor: float, keys: list[str]) -> DataFrame:
    """matched() by joins in rounds, however large a plane is."""
    sides = [a, b]
    pairs = within(*sides, radius, keys).select(*keys, "id_a", "id_b", "distance")
    many = pairs.groupBy(*keys, "id_a").agg(F.count("*").alias("_m"))
    now = saved(pairs.join(many.hint("merge"), [*keys, "id_a"]).withColumn("score", 1 / (F.col("_m") + 1)).drop("_m"), "relaxed")
    held = saved(supports(*sides, now, reach, k, tolerance, keys), "supports")
    for _ in range(rounds):
        voters = now.select(*keys, F.col("id_a").alias("to_a"), F.col("id_b").alias("to_b"), F.col("score").alias("_s"))
        by_neighbour = held.join(voters.hint("merge"), [*keys, "to_a", "to_b"]).groupBy(*keys, "id_a", "id_b", "to_a").agg(F.max(F.col("fit") * F.col("_s")).alias("_v"), F.max("n_a").alias("_n"))
        votes = by_neighbour.groupBy(*keys, "id_a", "id_b").agg((F.sum("_v") / F.max("_n")).alias("_v"))
        raised = now.join(votes.hint("merge"), [*keys, "id_a", "id_b"], "left").withColumn("_r", F.col("score") * (floor + F.coalesce("_v", F.lit(0.0))))
        # having no partner keeps what the scores left of 1, times the floor alone
        total = raised.groupBy(*keys, "id_a").agg((F.sum("_r") + F.greatest(1 - F.sum("score"), F.lit(0.0)) * floor).alias("_t"))
        now = saved(raised.join(total.hint("merge"), [*keys, "id_a"]).select(*keys, "id_a", "id_b", "distance", (F.col("_r") / F.col("_t")).alias("score")), "relaxed")

    def best(df: DataFrame, side: str, other: str) -> DataFrame:
        order: list[Column | str] = [F.desc("score"), "distance", other]
        return df.withColumn("_n", F.row_number().over(W.partitionBy(*keys, side).orderBy(*order))).where("_n = 1").drop("_n")

    return best(best(now.where(F.col("score") >= least), "id_a", "id_b"), "id_b", "id_a")
