"""Places of tiles from the shifts between pairs of them: weighted least squares on the edges, with bad edges down-weighted.

Edges are rows (a, b, dy, dx, weight): b lies dy, dx from a. A connected component of up to WHOLE edges (a well) is solved in
one task, all wells at the same time; a larger one is cut into cells of tiles that lie together, and solved without iterations: a task solves its cells' tiles
for those that part it from other areas, four areas become one until one is left, and places go back the same way (nested dissection). A component whose
areas are parted by more than FRONT tiles, so that such equations would be too large for a task, takes conjugate gradients over the edge table, two joins and
an aggregation a step. All minimise the same sum; a component's least tile is moved to 0, 0.

Bad edges: after a solution each edge's weight is scaled by min(1, cutoff / its residual) and the sum is solved again, `rounds` times
(iteratively reweighted, Huber's loss).

Defined results: null ends, shifts or weights, weights of 0 or less, and edges of a tile with itself are left out. Repeated edges count
each. Tiles without an edge have no place. No edges give no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from screenweave.operators.scratch import saved

#: Edges of a component that one task solves whole.
WHOLE = 100_000
#: Edges of a cell of a larger one, about; cells of a task are 2 ** INSIDE by as many; tiles that part the areas which become one, at most.
CELL, INSIDE, FRONT = 300, 4, 8000
#: Tasks of a step over areas, at most.
TASKS = 1024
#: Conjugate gradients end when the residual is so much of the right side; those over tables fail after so many steps.
PRECISION, STEPS = 1e-10, 2000
_EDGE = ["a", "b", "dy", "dx", "weight"]


def gradients(a: np.ndarray, b: np.ndarray, shift: np.ndarray, weight: np.ndarray, n: int) -> np.ndarray:
    """Places (n, 2) with mean 0 that minimise the weighted squares of place[b] - place[a] - shift, for one component."""
    scatter = lambda v: np.stack([np.bincount(b, c, n) - np.bincount(a, c, n) for c in v.T], axis=1)
    place = np.zeros((n, 2))
    rest = scatter(weight[:, None] * shift)
    way, size = rest.copy(), (rest**2).sum(axis=0)
    enough = PRECISION**2 * np.maximum(size, 1e-300)
    for _ in range(10 * n + 100):
        if (size <= enough).all():
            break
        image = scatter(weight[:, None] * (way[b] - way[a]))
        step = size / np.maximum((way * image).sum(axis=0), 1e-300)
        place, rest = place + step * way, rest - step * image
        now = (rest**2).sum(axis=0)
        way, size = rest + now / np.maximum(size, 1e-300) * way, now
    else:
        raise RuntimeError("the conjugate gradients haven't converged")
    return place - place.mean(axis=0)


def _whole(edges: DataFrame, kind: str, cutoff: float | None, rounds: int) -> DataFrame:
    def solve(df: pd.DataFrame) -> pd.DataFrame:
        own, at = np.unique(np.concatenate([df["a"], df["b"]]), return_inverse=True)
        a, b, n = at[: len(df)], at[len(df) :], len(own)
        shift, base = df[["dy", "dx"]].to_numpy(float), df["weight"].to_numpy(float)
        place = gradients(a, b, shift, base, n)
        for _ in range(rounds if cutoff is not None else 0):
            off = np.hypot(*(place[b] - place[a] - shift).T)
            place = gradients(a, b, shift, base * np.minimum(1, cutoff / np.maximum(off, 1e-12)), n)
        return pd.DataFrame({"component": df["component"].iloc[0], "tile": own, "y": place[:, 0], "x": place[:, 1]})

    return edges.groupBy("component").applyInPandas(solve, f"component {kind}, tile {kind}, y double, x double")


def _scattered(edges: DataFrame, y: str, x: str) -> DataFrame:
    """Sums of weighted edge values: to b positive, to a negative."""
    ends = F.array(F.struct(F.col("b").alias("tile"), F.lit(1.0).alias("s")), F.struct(F.col("a").alias("tile"), F.lit(-1.0).alias("s")))
    out = edges.select("component", F.col(y).alias("_y"), F.col(x).alias("_x"), "w", F.explode(ends).alias("e"))
    return out.groupBy("component", F.col("e.tile").alias("tile")).agg(F.sum(F.col("e.s") * F.col("w") * F.col("_y")).alias("y"), F.sum(F.col("e.s") * F.col("w") * F.col("_x")).alias("x"))


def _steps(edges: DataFrame) -> DataFrame:
    """Places by conjugate gradients over the edge table; `w` is the edge's weight."""
    begin = _scattered(edges, "dy", "dx")
    zero = F.lit(0.0)
    now = saved(begin.select("component", "tile", zero.alias("py"), zero.alias("px"), F.col("y").alias("ry"), F.col("x").alias("rx"), F.col("y").alias("dy"), F.col("x").alias("dx")), "gradients")
    first = saved(now.groupBy("component").agg(F.sum(F.col("ry") ** 2).alias("sy"), F.sum(F.col("rx") ** 2).alias("sx")), "gradients")
    size, done = first, False
    for k in range(STEPS):
        open_ = size.join(first.select("component", F.col("sy").alias("fy"), F.col("sx").alias("fx")), "component").where((F.col("sy") > PRECISION**2 * F.col("fy")) | (F.col("sx") > PRECISION**2 * F.col("fx")))
        if k % 4 == 0 and open_.isEmpty():
            done = True
            break
        at = lambda end: now.select("component", F.col("tile").alias(end), F.col("dy").alias(f"{end}_y"), F.col("dx").alias(f"{end}_x"))  # noqa: B023, E731
        both = edges.drop("dy", "dx").join(at("a"), ["component", "a"]).join(at("b"), ["component", "b"]).withColumns({"gy": F.col("b_y") - F.col("a_y"), "gx": F.col("b_x") - F.col("a_x")})
        image = _scattered(both, "gy", "gx").select("component", "tile", F.col("y").alias("iy"), F.col("x").alias("ix"))
        joined = saved(now.join(image, ["component", "tile"]), "gradients")
        dots = joined.groupBy("component").agg(F.sum(F.col("dy") * F.col("iy")).alias("ty"), F.sum(F.col("dx") * F.col("ix")).alias("tx"))
        step = size.join(dots, "component").select("component", "sy", "sx", *[F.coalesce(F.col(f"s{c}") / F.nullif(F.col(f"t{c}"), zero), zero).alias(f"k{c}") for c in "yx"])
        moved = joined.join(step, "component").withColumns({f"p{c}": F.col(f"p{c}") + F.col(f"k{c}") * F.col(f"d{c}") for c in "yx"} | {f"r{c}": F.col(f"r{c}") - F.col(f"k{c}") * F.col(f"i{c}") for c in "yx"})
        moved = saved(moved.select("component", "tile", "py", "px", "ry", "rx", "dy", "dx"), "gradients")
        after = saved(moved.groupBy("component").agg(F.sum(F.col("ry") ** 2).alias("sy"), F.sum(F.col("rx") ** 2).alias("sx")), "gradients")
        turn = after.join(size.select("component", F.col("sy").alias("oy"), F.col("sx").alias("ox")), "component").select("component", *[F.coalesce(F.col(f"s{c}") / F.nullif(F.col(f"o{c}"), zero), zero).alias(f"b{c}") for c in "yx"])
        now = saved(moved.join(turn, "component").withColumns({f"d{c}": F.col(f"r{c}") + F.col(f"b{c}") * F.col(f"d{c}") for c in "yx"}).drop("by", "bx"), "gradients")
        size = after
    if not done and not open_.isEmpty():
        raise RuntimeError("the conjugate gradients haven't converged")
    mean = now.groupBy("component").agg(F.avg("py").alias("my"), F.avg("px").alias("mx"))
    return now.join(mean, "component").select("component", "tile", (F.col("py") - F.col("my")).alias("y"), (F.col("px") - F.col("mx")).alias("x"))


def _stepped(edges: DataFrame, cutoff: float | None, rounds: int) -> DataFrame:
    weighed = saved(edges.withColumn("w", F.col("weight")), "edges")
    out = _steps(weighed)
    for _ in range(rounds if cutoff is not None else 0):
        at = lambda end: out.select("component", F.col("tile").alias(end), F.col("y").alias(f"{end}_y"), F.col("x").alias(f"{end}_x"))  # noqa: B023, E731
        off = F.hypot(F.col("b_y") - F.col("a_y") - F.col("dy"), F.col("b_x") - F.col("a_x") - F.col("dx"))
        both = edges.join(at("a"), ["component", "a"]).join(at("b"), ["component", "b"])
        weighed = saved(both.select("component", *_EDGE, (F.col("weight") * F.least(F.lit(1.0), F.lit(cutoff) / F.greatest(off, F.lit(1e-12)))).alias("w")), "edges")
        out = _steps(weighed)
    return out


def _rooted(edges: DataFrame) -> DataFrame:
    """(tile, root, y, x): the least tile that edges connect with it, and its place from there along some edges. Tiles jump to their root's root in each round."""
    turned = edges.select(F.col("b").alias("a"), F.col("a").alias("b"), (-F.col("dy")).alias("dy"), (-F.col("dx")).alias("dx"))
    pairs = saved(edges.select("a", "b", "dy", "dx").unionAll(turned).groupBy("a", "b").agg(F.min_by(F.struct("dy", "dx"), F.struct("dy", "dx")).alias("d")).select("a", "b", "d.*"), "rooted")
    own = F.struct(F.col("tile").alias("root"), F.lit(0.0).alias("y"), F.lit(0.0).alias("x"))
    first = pairs.groupBy(F.col("a").alias("tile")).agg(F.min(F.struct(F.col("b").alias("root"), (-F.col("dy")).alias("y"), (-F.col("dx")).alias("x"))).alias("at"))
    now = saved(first.select("tile", F.when(F.col("at.root") < F.col("tile"), F.col("at")).otherwise(own).alias("at")).select("tile", "at.*"), "rooted")
    while True:
        near = pairs.join(now.withColumnRenamed("tile", "b"), "b").groupBy(F.col("a").alias("tile")).agg(F.min(F.struct("root", (F.col("y") - F.col("dy")).alias("y"), (F.col("x") - F.col("dx")).alias("x"))).alias("at"))
        step = now.join(near, "tile").select("tile", F.when(F.col("at.root") < F.col("root"), F.col("at")).otherwise(F.struct("root", "y", "x")).alias("at"), F.col("root").alias("old")).select("tile", "at.*", "old")
        jump = now.select(F.col("tile").alias("root"), F.col("root").alias("up"), F.col("y").alias("_y"), F.col("x").alias("_x"))
        after = saved(step.join(jump, "root").select("tile", F.col("up").alias("root"), (F.col("y") + F.col("_y")).alias("y"), (F.col("x") + F.col("_x")).alias("x"), "old"), "rooted")
        now, moved = after.drop("old"), not after.where("root <> old").isEmpty()
        if not moved:
            return now


def _cells(places: DataFrame, sides: dict) -> DataFrame:
    """(component, tile, i, j) with the tile's row and column among the 2 ** k by 2 ** k cells of its component, about as many tiles in each. sides: k by component."""
    jitter = F.col("y") + F.xxhash64("tile") / F.lit(2.0**63) * 1e-3  # tiles of one height are told apart
    spread = places.select("component", "tile", jitter.alias("y"), "x")
    most = max(sides.values())
    cuts = {r["component"]: np.array(r["cuts"]) for r in spread.groupBy("component").agg(F.percentile_approx("y", [k / 2**most for k in range(1, 2**most)] or [0.5], 20 * 2**most).alias("cuts")).collect()}

    @F.pandas_udf("int")
    def row(component: pd.Series, y: pd.Series) -> pd.Series:
        out, height = np.zeros(len(y), dtype="int32"), y.to_numpy()
        for c, at in component.groupby(component).indices.items():
            out[at] = np.searchsorted(cuts[c], height[at], side="right") >> (most - sides[c]) if most else 0
        return pd.Series(out)

    def columns(df: pd.DataFrame) -> pd.DataFrame:
        rank, n = df["x"].rank(method="first").to_numpy(dtype="int64") - 1, len(df)
        return df[["component", "tile", "i"]].assign(j=rank * 2 ** sides[df["component"].iloc[0]] // n)

    kind = places.schema["tile"].dataType.simpleString()
    return spread.withColumn("i", row("component", "y")).groupBy("component", "i").applyInPandas(columns, f"component {kind}, tile {kind}, i int, j int")


def _dealt(edges: DataFrame, cells: DataFrame) -> DataFrame:
    """The edges with the cell (i, j) that takes them and the levels at which their ends are solved (ea, eb).

    At level k four cells' areas become one. Of an edge between two cells one end parts them: it is solved once both cells are in one
    area. An edge goes to the cell of the end that is solved first; so all edges of a tile are in its area by then.
    """
    at = lambda end: cells.select("component", F.col("tile").alias(end), F.struct("i", "j").alias(f"_{end}"))
    both = edges.join(at("a"), ["component", "a"]).join(at("b"), ["component", "b"])
    apart = F.col("_a.i").bitwiseXOR(F.col("_b.i")).bitwiseOR(F.col("_a.j").bitwiseXOR(F.col("_b.j")))
    both = saved(both.withColumn("_k", F.when(apart > 0, F.length(F.bin(apart))).otherwise(0)), "edges")
    parting = both.where("_k > 0").groupBy("component", F.when(F.col("_a") < F.col("_b"), F.col("a")).otherwise(F.col("b")).alias("tile")).agg(F.max("_k").cast("int").alias("e"))
    level = lambda end: F.when(F.col(end) == F.col("component"), 99).otherwise(F.coalesce(f"e{end}", F.lit(0)))
    for end in "ab":
        both = both.join(parting.select("component", F.col("tile").alias(end), F.col("e").alias(f"e{end}")), ["component", end], "left")
    both = both.withColumns({"ea": level("a"), "eb": level("b")})
    return both.withColumn("_in", F.when(F.col("ea") <= F.col("eb"), F.col("_a")).otherwise(F.col("_b"))).select("component", *_EDGE, "ea", "eb", F.col("_in.i").alias("i"), F.col("_in.j").alias("j"))


def _wide(dealt: DataFrame) -> DataFrame:
    """(component): those with areas that more than FRONT tiles part."""
    ends = [dealt.where(f"e{c} BETWEEN 1 AND 98").select("component", F.col(c).alias("tile"), F.expr(f"shiftright(i, e{c})").alias("i"), F.expr(f"shiftright(j, e{c})").alias("j"), F.col(f"e{c}").alias("e")) for c in "ab"]
    n = ends[0].unionAll(ends[1]).distinct().groupBy("component", "i", "j", "e").agg(F.count("*").alias("n"))
    return saved(n.where(F.col("n") > FRONT).select("component").distinct(), "components")


def _summed(parts: list) -> tuple:
    """Equations (tiles, matrix, right side) of several areas as one."""
    own = np.unique(np.concatenate([p[0] for p in parts]))
    matrix, right = np.zeros((len(own), len(own))), np.zeros((len(own), 2))
    for tiles, m, r in parts:
        at = np.searchsorted(own, tiles)
        matrix[np.ix_(at, at)] += m
        right[at] += r
    return own, matrix, right


def _solved_out(tiles: np.ndarray, matrix: np.ndarray, right: np.ndarray, gone: np.ndarray) -> tuple:
    """(tiles solved, tiles left, answer), whose places are answer's last two columns less its others times the places of those left; and the equations of those left."""
    stay, n = ~gone, int((~gone).sum())
    answer = np.linalg.solve(matrix[np.ix_(gone, gone)], np.hstack([matrix[np.ix_(gone, stay)], right[gone]]))
    back = matrix[np.ix_(stay, gone)]
    return (tiles[gone], tiles[stay], answer), (tiles[stay], matrix[np.ix_(stay, stay)] - back @ answer[:, :n], right[stay] - back @ answer[:, n:])


def _area(df: pd.DataFrame, inside: int) -> tuple:
    """An area's tiles, their levels, the ends of its edges, the answers in the order in which they were found, and the equations of the tiles left. Tiles are numbers of `own` here."""
    own, at = np.unique(np.concatenate([df["a"], df["b"]]), return_inverse=True)
    a, b = at[: len(df)], at[len(df) :]
    level = np.zeros(len(own), dtype=int)
    level[a], level[b] = df["ea"], df["eb"]
    w, shift = df["w"].to_numpy(float), df[["dy", "dx"]].to_numpy(float)
    cell = df["i"].to_numpy().astype("int64") << 32 | df["j"].to_numpy()
    order = np.argsort(cell, kind="stable")
    parts: dict = {}
    for at in np.split(order, np.flatnonzero(np.diff(cell[order])) + 1):
        tiles, end = np.unique(np.concatenate([a[at], b[at]]), return_inverse=True)
        n, p, q = len(tiles), end[: len(at)], end[len(at) :]
        off = np.bincount(np.concatenate([p * n + q, q * n + p]), np.tile(-w[at], 2), n * n).reshape(n, n)
        push = w[at][:, None] * shift[at]
        right = np.stack([np.bincount(q, c, n) - np.bincount(p, c, n) for c in push.T], axis=1)
        parts[int(cell[at[0]])] = [(tiles, off - np.diag(off.sum(axis=1)), right)]
    answers = []
    for k in range(inside + 1):
        above: dict = {}
        for c, found in parts.items():
            tiles, matrix, right = _summed(found)
            answer, rest = _solved_out(tiles, matrix, right, level[tiles] == k)
            answers.append(answer)
            above.setdefault((c >> 33) << 32 | (c & 0xFFFFFFFF) >> 1, []).append(rest)
        parts = above
    (rest,) = parts.values()
    return own, level, a, b, answers, rest[0]


def _packed(key: tuple, tiles, levels, matrix, right, gone, answer) -> pd.DataFrame:
    return pd.DataFrame({"component": [key[0]], "i": [key[1]], "j": [key[2]], "tiles": [list(tiles)], "levels": [list(levels)], "matrix": [matrix.tobytes()], "right": [right.tobytes()], "gone": [list(gone)], "answer": [answer.tobytes()]})


def _unpacked(row) -> tuple:
    tiles = np.array(row.tiles)
    return tiles, np.frombuffer(row.matrix).reshape(len(tiles), len(tiles)), np.frombuffer(row.right).reshape(len(tiles), 2)


def _areas(df: DataFrame, up: int, k: int):
    """The rows by the area so many levels up. k: levels that these areas are under the whole; Spark doesn't know how much work a row is, so the number of tasks is given."""
    rows = df.withColumns({"_i": F.shiftright("i", up), "_j": F.shiftright("j", up)})
    return rows.repartition(min(2 * 4**k, TASKS), "component", "_i", "_j").groupBy("component", "_i", "_j")


def _known(edges: DataFrame, kind: str, levels: int, inside: int) -> tuple[DataFrame, list[DataFrame]]:
    """The places of the tiles that part areas: by area of level `inside` what it needs, and the rows of all, by level. `w` is the edge's weight."""
    front = f"component {kind}, i int, j int, tiles array<{kind}>, levels array<int>, matrix binary, right binary, gone array<{kind}>, answer binary"

    def first(key: tuple, df: pd.DataFrame) -> pd.DataFrame:
        own, level, _, _, _, (tiles, matrix, right) = _area(df, inside)
        return _packed(key, own[tiles], level[tiles], matrix, right, [], np.zeros(0))

    def above(k: int):
        def joined(key: tuple, df: pd.DataFrame) -> pd.DataFrame:
            rows = list(df.itertuples())
            tiles, matrix, right = _summed([_unpacked(r) for r in rows])
            level = np.zeros(len(tiles), dtype=int)
            for r in rows:
                level[np.searchsorted(tiles, np.array(r.tiles))] = r.levels
            answer, (left, matrix, right) = _solved_out(tiles, matrix, right, level == k)
            return _packed(key, left, level[level != k], matrix, right, answer[0], answer[2])

        return joined

    fronts = [saved(_areas(edges, inside, levels - inside).applyInPandas(first, front), "fronts")]
    for k in range(inside + 1, levels + 1):
        fronts.append(saved(_areas(fronts[-1].drop("gone", "answer"), 1, levels - k).applyInPandas(above(k), front), "fronts"))

    value = f"component {kind}, i int, j int, tiles array<{kind}>, y array<double>, x array<double>, solved boolean"

    def below(key: tuple, front: pd.DataFrame, given: pd.DataFrame) -> pd.DataFrame:
        row, known = front.iloc[0], given.iloc[0]
        stay, gone = np.array(row["tiles"]), np.array(row["gone"])
        at = dict(zip(known["tiles"], zip(known["y"], known["x"])))
        there = np.array([at[t] for t in stay]).reshape(-1, 2)
        answer = np.frombuffer(row["answer"]).reshape(len(gone), len(stay) + 2)
        place = answer[:, len(stay) :] - answer[:, : len(stay)] @ there
        tiles, all_ = [*stay, *gone], np.vstack([there, place])
        out = [(key[0], 2 * key[1] + i, 2 * key[2] + j, tiles, all_[:, 0], all_[:, 1], False) for i in (0, 1) for j in (0, 1)]
        return pd.DataFrame([*out, (key[0], key[1], key[2], list(gone), place[:, 0], place[:, 1], True)], columns=["component", "i", "j", "tiles", "y", "x", "solved"])

    zero = F.array(F.lit(0.0))
    known = fronts[-1].select("component", "i", "j", F.array("component").alias("tiles"), zero.alias("y"), zero.alias("x"))
    done = []
    for k, up in enumerate(reversed(fronts[1:])):
        out = saved(_areas(up.drop("levels", "matrix", "right"), 0, k).cogroup(_areas(known, 0, k)).applyInPandas(_if_both(below, value), value), "known")
        known = out.where("NOT solved").drop("solved")
        done.append(out.where("solved").select("component", F.explode(F.arrays_zip("tiles", "y", "x")).alias("_t")).select("component", F.col("_t.tiles").alias("tile"), "_t.y", "_t.x"))
    return known, done


def _if_both(work, schema: str):
    names = [c.split()[0] for c in schema.split(", ")]

    def of(key: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        return work(key, left, right) if len(left) and len(right) else pd.DataFrame({c: [] for c in names}, dtype=object)

    return of


def _within(df: pd.DataFrame, given: pd.DataFrame, inside: int) -> tuple:
    """An area's tiles, their levels, their places, and the ends of its edges, from the places of the tiles that part it from others."""
    own, level, a, b, answers, (left, _, _) = _area(df, inside)
    known = given.iloc[0]
    at = dict(zip(known["tiles"], zip(known["y"], known["x"])))
    place = np.zeros((len(own), 2))
    place[left] = np.array([at[t] for t in own[left]]).reshape(-1, 2)
    for gone, stay, answer in reversed(answers):
        place[gone] = answer[:, len(stay) :] - answer[:, : len(stay)] @ place[stay]
    return own, level, place, a, b


def _large(edges: DataFrame, places: DataFrame, sides: dict, cutoff: float | None, rounds: int) -> DataFrame:
    """Places of the tiles of large components: cells of tiles are solved for the tiles that part them, four areas at a time, up to one, and back (nested dissection)."""
    kind = edges.schema["a"].dataType.simpleString()
    inside = INSIDE  # tasks have the module's own value
    levels = max(*sides.values(), inside)
    dealt = saved(_dealt(edges, _cells(places, sides)).withColumn("w", F.col("weight")), "edges")
    wide = _wide(dealt)
    now = dealt.join(wide, "component", "left_anti")
    names, schema = now.columns, ", ".join(f"{c.name} {c.dataType.simpleString()}" for c in now.schema)

    def weighed(key: tuple, df: pd.DataFrame, given: pd.DataFrame) -> pd.DataFrame:
        _, _, place, a, b = _within(df, given, inside)
        off = np.hypot(*(place[b] - place[a] - df[["dy", "dx"]].to_numpy(float)).T)
        return df[names].assign(w=df["weight"] * np.minimum(1, cutoff / np.maximum(off, 1e-12)))

    def placed(key: tuple, df: pd.DataFrame, given: pd.DataFrame) -> pd.DataFrame:
        own, level, place, _, _ = _within(df, given, inside)
        mine = level <= inside
        return pd.DataFrame({"component": key[0], "tile": own[mine], "y": place[mine, 0], "x": place[mine, 1]})

    out = f"component {kind}, tile {kind}, y double, x double"
    for k in range(rounds + 1 if cutoff is not None else 1):
        known, done = _known(now, kind, levels, inside)
        groups = _areas(now, inside, levels - inside).cogroup(_areas(known, 0, levels - inside))
        if cutoff is None or k == rounds:
            break
        now = saved(groups.applyInPandas(_if_both(weighed, schema), schema), "edges")
    found = groups.applyInPandas(_if_both(placed, out), out)
    for part in done:
        found = found.unionByName(part)
    if not wide.isEmpty():
        found = found.unionByName(_stepped(edges.join(wide, "component", "left_semi"), cutoff, rounds))
    zero = F.lit(0.0)
    return found.unionByName(now.select("component").distinct().select("component", F.col("component").alias("tile"), zero.alias("y"), zero.alias("x")))


def solved(edges: DataFrame, cutoff: float | None = None, rounds: int = 5) -> DataFrame:
    """(component: its least tile, tile, y, x) of all tiles with an edge."""
    good = edges.select(*_EDGE).dropna().where("a <> b AND weight > 0")
    root = _rooted(good)
    kind = good.schema["a"].dataType.simpleString()
    own = saved(good.join(root.select(F.col("tile").alias("a"), F.col("root").alias("component")), "a"), "edges")
    size = own.groupBy("component").agg(F.count("*").alias("n"))
    large = saved(size.where(F.col("n") > WHOLE), "components")  # at most one for each WHOLE edges
    small = own.join(large, "component", "left_anti")
    places = _whole(small, kind, cutoff, rounds)
    sides = {r["component"]: max(0, math.ceil(math.log2(r["n"] / CELL) / 2)) for r in large.collect()}
    if sides:
        near = root.withColumnRenamed("root", "component").join(large, "component", "left_semi")
        places = places.unionByName(_large(own.join(large, "component", "left_semi"), near, sides, cutoff, rounds))
    places = saved(places, "places")
    base = places.where("tile = component").select("component", F.col("y").alias("_y"), F.col("x").alias("_x"))
    return places.join(base, "component").select("component", "tile", (F.col("y") - F.col("_y")).alias("y"), (F.col("x") - F.col("_x")).alias("x"))


def residuals(edges: DataFrame, places: DataFrame) -> DataFrame:
    """The edges with the distance between their shift and the places' (off)."""
    at = lambda end: places.select(F.col("tile").alias(end), F.col("y").alias(f"_{end}y"), F.col("x").alias(f"_{end}x"))
    both = edges.join(at("a"), "a").join(at("b"), "b")
    return both.withColumn("off", F.hypot(F.col("_by") - F.col("_ay") - F.col("dy"), F.col("_bx") - F.col("_ax") - F.col("dx"))).drop("_ay", "_ax", "_by", "_bx")
