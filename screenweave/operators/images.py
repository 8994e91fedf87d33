"""Image kernels on tiles: a row (keys..., y0, x0, h, w, pixels as float32 bytes) is one tile of a plane.

Kernels are numpy functions of one tile; `mapped` applies them in Arrow batches. What looks beyond a tile's edge takes
its halo from the neighbours by a grouped map: `with_halo` sends each tile just to the tiles around it. Models for
detection and segmentation are external: any function of a tile fits `mapped`.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Kernel = Callable[[np.ndarray], np.ndarray]


def pixels(data: bytes, h: int, w: int) -> np.ndarray:
    return np.frombuffer(data, dtype=np.float32).reshape(h, w)


def mapped(tiles: DataFrame, kernel: Kernel) -> DataFrame:
    """Tiles after a kernel; it may change their size."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = [np.ascontiguousarray(kernel(pixels(p, h, w)), dtype=np.float32) for p, h, w in zip(b["pixels"], b["h"], b["w"])]
            yield b.assign(pixels=[o.tobytes() for o in out], h=[o.shape[0] for o in out], w=[o.shape[1] for o in out])

    return tiles.mapInPandas(run, tiles.schema)


def with_halo(tiles: DataFrame, keys: list[str], size: int, halo: int, kernel: Kernel) -> DataFrame:
    """Tiles after a kernel that sees `halo` pixels of their neighbours (zeros off the plane). Tiles lie on a grid of `size`; halo <= size."""
    steps = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (-1, 0, 1) for j in (-1, 0, 1)])
    sent = tiles.withColumn("_s", F.explode(steps)).withColumns({"_ty": F.col("y0") + F.col("_s.i") * size, "_tx": F.col("x0") + F.col("_s.j") * size}).drop("_s")

    def run(group: pd.DataFrame) -> pd.DataFrame:
        ty, tx = int(group["_ty"].iloc[0]), int(group["_tx"].iloc[0])
        own = group[(group["y0"] == ty) & (group["x0"] == tx)]
        if own.empty:
            return own.drop(columns=["_ty", "_tx"])
        h, w = int(own["h"].iloc[0]), int(own["w"].iloc[0])
        canvas = np.zeros((h + 2 * halo, w + 2 * halo), dtype=np.float32)
        for y, x, th, tw, p in zip(group["y0"], group["x0"], group["h"], group["w"], group["pixels"]):
            a, b = max(y, ty - halo), max(x, tx - halo)
            c, d = min(y + th, ty + h + halo), min(x + tw, tx + w + halo)
            if a < c and b < d:
                canvas[a - ty + halo : c - ty + halo, b - tx + halo : d - tx + halo] = pixels(p, th, tw)[a - y : c - y, b - x : d - x]
        out = np.ascontiguousarray(kernel(canvas)[halo : halo + h, halo : halo + w], dtype=np.float32)
        return own.assign(pixels=[out.tobytes()]).drop(columns=["_ty", "_tx"])

    return sent.groupBy(*keys, "_ty", "_tx").applyInPandas(run, tiles.schema)


def to_pixels(tiles: DataFrame, keys: list[str], name: str = "value") -> DataFrame:
    """One row for each pixel (keys..., y, x, value)."""
    names = [*keys, "y", "x", name]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for r in b.to_dict("records"):
                v = pixels(r["pixels"], r["h"], r["w"])
                y, x = np.indices(v.shape)
                yield pd.DataFrame({**{k: r[k] for k in keys}, "y": (y + r["y0"]).ravel(), "x": (x + r["x0"]).ravel(), name: v.ravel().astype(float)})[names]

    schema = ", ".join(f"{k} {tiles.schema[k].dataType.simpleString()}" for k in keys)
    return tiles.mapInPandas(run, ", ".join(filter(None, [schema, f"y long, x long, {name} double"])))


def reduced(tiles: DataFrame, keys: list[str], how: str = "max") -> DataFrame:
    """Projection over the axes that aren't in keys: pixelwise max or mean of the tiles at one place, in partial sums."""
    at = [*keys, "y0", "x0", "h", "w"]

    def fold(df: pd.DataFrame) -> pd.DataFrame:
        h, w = int(df["h"].iloc[0]), int(df["w"].iloc[0])
        total = None
        for p, n in zip(df["pixels"], df["_n"]):
            v = pixels(p, h, w) * (n if how == "mean" else 1)
            total = v if total is None else np.maximum(total, v) if how == "max" else total + v
        n = int(df["_n"].sum())
        out = (total / n if how == "mean" else total).astype(np.float32)
        return df[at].iloc[:1].assign(pixels=[out.tobytes()], _n=n)

    schema = ", ".join(f"{k} {tiles.schema[k].dataType.simpleString()}" for k in at) + ", pixels binary, _n long"
    parts = tiles.select(*at, "pixels", F.lit(1).cast("long").alias("_n"), F.pmod(F.xxhash64("pixels"), F.lit(16)).alias("_salt"))
    return parts.groupBy(*at, "_salt").applyInPandas(fold, schema).groupBy(*at).applyInPandas(fold, schema).drop("_n")


# Kernels


def max_filter(width: int) -> Kernel:
    """Maximum over a square of `width` pixels (odd), one axis after the other."""
    half = width // 2

    def run(v: np.ndarray) -> np.ndarray:
        for axis in (0, 1):
            p = np.pad(v, [(half, half) if a == axis else (0, 0) for a in (0, 1)], constant_values=-np.inf)
            v = np.lib.stride_tricks.sliding_window_view(p, width, axis=axis).max(axis=-1)
        return v

    return run


def dilate(radius: int) -> Kernel:
    """Labels grown by a disc; where two labels meet the larger one wins, and labels never change."""

    def run(v: np.ndarray) -> np.ndarray:
        out = np.zeros_like(v)
        for dy in range(-radius, radius + 1):
            for dx in range(-radius, radius + 1):
                if dy * dy + dx * dx <= radius * radius:
                    a, b = slice(max(dy, 0), v.shape[0] + min(dy, 0)), slice(max(dx, 0), v.shape[1] + min(dx, 0))
                    c, d = slice(max(-dy, 0), v.shape[0] + min(-dy, 0)), slice(max(-dx, 0), v.shape[1] + min(-dx, 0))
                    out[a, b] = np.maximum(out[a, b], v[c, d])
        return np.where(v > 0, v, out)

    return run


def block_mean(factor: int = 2) -> Kernel:
    """Down by `factor`; blocks at the far edges may be smaller."""

    def run(v: np.ndarray) -> np.ndarray:
        h, w = (-(-n // factor) for n in v.shape)
        pad = np.pad(v, ((0, h * factor - v.shape[0]), (0, w * factor - v.shape[1])), constant_values=np.nan)
        return np.nanmean(pad.reshape(h, factor, w, factor), axis=(1, 3))

    return run


def strided(factor: int = 2) -> Kernel:
    return lambda v: v[::factor, ::factor]


def upscaled(factor: int) -> Kernel:
    return lambda v: np.repeat(np.repeat(v, factor, axis=0), factor, axis=1)


def smoothed(sigma: float) -> Kernel:
    """Gaussian smoothing with edges repeated."""
    n = max(1, int(4 * sigma + 0.5))
    k = np.exp(-0.5 * (np.arange(-n, n + 1) / sigma) ** 2)
    k /= k.sum()

    def run(v: np.ndarray) -> np.ndarray:
        for axis in (0, 1):
            p = np.pad(v, [(n, n) if a == axis else (0, 0) for a in (0, 1)], mode="edge")
            v = np.lib.stride_tricks.sliding_window_view(p, 2 * n + 1, axis=axis) @ k
        return v

    return run


def flatfield(profile: np.ndarray) -> Kernel:
    """Division by an illumination profile of maximum 1."""
    p = profile / profile.max()
    return lambda v: v / np.maximum(p, 1e-6)


def outside_discs(points: np.ndarray, radius: float) -> Kernel:
    """1 where no point is within the radius."""

    def run(v: np.ndarray) -> np.ndarray:
        y, x = np.indices(v.shape)
        near = np.zeros(v.shape, dtype=bool)
        for py, px in points:
            near |= (y - py) ** 2 + (x - px) ** 2 <= radius**2
        return (~near).astype(np.float32)

    return run


def warped(matrix: np.ndarray, shape: tuple[int, int], order: int = 1) -> Kernel:
    """Output pixel (y, x) from place matrix @ (y, x, 1) of the input, nearest (order 0) or bilinear, zeros outside."""

    def run(v: np.ndarray) -> np.ndarray:
        y, x = np.indices(shape)
        a, b, c = np.tensordot(matrix, np.stack([y, x, np.ones(shape)]), 1)
        a, b = a / c, b / c
        pick = lambda i, j: np.where((i >= 0) & (i < v.shape[0]) & (j >= 0) & (j < v.shape[1]), v[np.clip(i, 0, v.shape[0] - 1), np.clip(j, 0, v.shape[1] - 1)], 0)
        if order == 0:
            return pick(np.rint(a).astype(int), np.rint(b).astype(int))
        i, j = np.floor(a).astype(int), np.floor(b).astype(int)
        f, g = a - i, b - j
        return (1 - f) * (1 - g) * pick(i, j) + (1 - f) * g * pick(i, j + 1) + f * (1 - g) * pick(i + 1, j) + f * g * pick(i + 1, j + 1)

    return run


# Registration


def shift_between(a: np.ndarray, b: np.ndarray) -> tuple[int, int]:
    """The translation (dy, dx) that moves b onto a, by phase correlation."""
    f = np.fft.fft2(a) * np.conj(np.fft.fft2(b))
    peak = np.unravel_index(np.abs(np.fft.ifft2(f / np.maximum(np.abs(f), 1e-12))).argmax(), a.shape)
    return tuple(int(p - n if p > n // 2 else p) for p, n in zip(peak, a.shape))


def tile_shifts(rounds: DataFrame, keys: list[str], order: str) -> DataFrame:
    """(keys..., order, dy, dx): each round's translation onto the first one of its tile. A group is one tile's rounds."""

    def run(df: pd.DataFrame) -> pd.DataFrame:
        df = df.sort_values(order)
        images = [pixels(p, h, w) for p, h, w in zip(df["pixels"], df["h"], df["w"])]
        moves = [shift_between(images[0], v) for v in images]
        return df[[*keys, order]].assign(dy=[m[0] for m in moves], dx=[m[1] for m in moves])

    schema = ", ".join(f"{k} {rounds.schema[k].dataType.simpleString()}" for k in [*keys, order]) + ", dy int, dx int"
    return rounds.groupBy(*keys).applyInPandas(run, schema)


def ransac_affine(source: np.ndarray, target: np.ndarray, tolerance: float = 2.0, rounds: int = 500, least: int = 3, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """(3 x 3 matrix, inliers) that takes source points to target points; the identity without inliers if fewer than max(3, least) agree."""
    r, one = np.random.default_rng(seed), np.c_[source, np.ones(len(source))]
    best = np.zeros(len(source), dtype=bool)
    for _ in range(rounds if len(source) >= 3 else 0):
        at = r.choice(len(source), 3, replace=False)
        if abs(np.linalg.det(one[at])) < 1e-9:
            continue
        inside = np.linalg.norm(one @ np.linalg.solve(one[at], target[at]) - target, axis=1) <= tolerance
        if inside.sum() > best.sum():
            best = inside
    if best.sum() < max(3, least):
        return np.eye(3), np.zeros(len(source), dtype=bool)
    fit = np.linalg.lstsq(one[best], target[best], rcond=None)[0]
    return np.vstack([fit.T, [0, 0, 1]]), best


def refine_translation(a: np.ndarray, b: np.ndarray, coarse: tuple[int, int] = (50, 10), fine: tuple[int, int] = (8, 2)) -> tuple[int, int, float]:
    """(dy, dx, IoU) of the translation of mask b with the best overlap with a: a coarse grid, then a fine one around its best."""

    def iou(dy: int, dx: int) -> float:
        h, w = a.shape
        m = b[max(0, -dy) : h - max(0, dy), max(0, -dx) : w - max(0, dx)]
        n = a[max(0, dy) : h - max(0, -dy), max(0, dx) : w - max(0, -dx)]
        both = np.logical_and(m, n).sum()
        return both / max(1, a.sum() + b.sum() - both)

    best = (0, 0, iou(0, 0))
    for span, step in (coarse, fine):
        cy, cx, _ = best
        for dy in range(cy - span, cy + span + 1, step):
            for dx in range(cx - span, cx + span + 1, step):
                if abs(dy) < a.shape[0] and abs(dx) < a.shape[1] and (v := iou(dy, dx)) > best[2]:
                    best = (dy, dx, v)
    return best


def assignment(score: np.ndarray) -> list[tuple[int, int]]:
    """One-to-one pairs of greatest total score: shortest augmenting paths with potentials."""
    flip = score.shape[0] > score.shape[1]
    cost = -(score.T if flip else score)
    n, m = cost.shape
    u, v, match = np.zeros(n + 1), np.zeros(m + 1), np.full(m + 1, -1)
    for i in range(n):
        match[m], j, least, back, seen = i, m, np.full(m + 1, np.inf), np.full(m + 1, -1), np.zeros(m + 1, dtype=bool)
        while match[j] != -1:
            seen[j] = True
            reduced_ = cost[match[j]] - u[match[j]] - v[:m]
            better = ~seen[:m] & (reduced_ < least[:m])
            least[:m][better], back[:m][better] = reduced_[better], j
            free = np.where(seen[:m], np.inf, least[:m])
            k = int(free.argmin())
            delta = free[k]
            u[match[seen]] += delta
            v[seen] -= delta
            least[:m][~seen[:m]] -= delta
            j = k
        while j != m:
            match[j], j = match[back[j]], back[j]
    pairs = [(int(match[j]), j) for j in range(m) if match[j] != -1]
    return sorted((b, a) if flip else (a, b) for a, b in pairs)


def detection_scores(overlaps: DataFrame, keys: list[str], truths: int, predictions: int, thresholds: list[float]) -> DataFrame:
    """(keys..., threshold, tp, fp, fn, precision, recall) from (label_a: truth, label_b: prediction, iou) pairs of a group, matched one to one."""

    def run(df: pd.DataFrame) -> pd.DataFrame:
        a, i = np.unique(df["label_a"], return_inverse=True)
        b, j = np.unique(df["label_b"], return_inverse=True)
        score = np.zeros((len(a), len(b)))
        score[i, j] = df["iou"]
        hit = np.array([score[p] for p in assignment(score)])
        rows = []
        for t in thresholds:
            tp = int((hit >= t).sum())
            rows.append((t, tp, predictions - tp, truths - tp, tp / max(1, predictions), tp / max(1, truths)))
        out = pd.DataFrame(rows, columns=["threshold", "tp", "fp", "fn", "precision", "recall"])
        return out.assign(**{k: df[k].iloc[0] for k in keys})[[*keys, *out.columns]]

    schema = ", ".join(filter(None, [*(f"{k} {overlaps.schema[k].dataType.simpleString()}" for k in keys), "threshold double, tp long, fp long, fn long, precision double, recall double"]))
    return overlaps.groupBy(*keys).applyInPandas(run, schema)


def contrast_limits(values: DataFrame, keys: list[str], low: float = 0.01, high: float = 0.998) -> DataFrame:
    return values.groupBy(*keys).agg(F.percentile("value", F.lit(low)).alias("low"), F.percentile("value", F.lit(high)).alias("high"))


def crops(tiles: DataFrame, cells: DataFrame, keys: list[str], half: int) -> DataFrame:
    """Square crops (id, pixels) around cells (id, y, x) that lie wholly in a tile; crops with a zero on their edge are left out."""
    y, x = F.col("y").cast("int"), F.col("x").cast("int")
    inside = (y - half >= F.col("y0")) & (y + half <= F.col("y0") + F.col("h")) & (x - half >= F.col("x0")) & (x + half <= F.col("x0") + F.col("w"))
    extent = tiles.select(*keys, "y0", "x0", "h", "w").withColumns({"y1": F.col("y0") + F.col("h"), "x1": F.col("x0") + F.col("w")})
    from screenweave.operators.spatial import points_in_boxes

    placed = points_in_boxes(cells, extent, keys, 1024.0).where(inside).select(*keys, "y0", "x0", "id", y.alias("_y"), x.alias("_x"))
    both = placed.join(tiles, [*keys, "y0", "x0"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for r in b.to_dict("records"):
                v = pixels(r["pixels"], r["h"], r["w"])
                cut = v[r["_y"] - r["y0"] - half : r["_y"] - r["y0"] + half, r["_x"] - r["x0"] - half : r["_x"] - r["x0"] + half]
                edge = np.concatenate([cut[0], cut[-1], cut[:, 0], cut[:, -1]])
                if (edge != 0).all():
                    rows.append((r["id"], np.ascontiguousarray(cut).tobytes()))
            yield pd.DataFrame(rows, columns=["id", "pixels"])

    return both.mapInPandas(run, f"id {cells.schema['id'].dataType.simpleString()}, pixels binary")


def hopkins(points: np.ndarray, n: int = 100, seed: int = 0) -> float:
    """Clustering tendency: distances of uniform points to the data against those of data points to their nearest others; 0.5 for uniform data."""
    r = np.random.default_rng(seed)
    n = min(n, len(points))
    uniform = r.uniform(points.min(axis=0), points.max(axis=0), (n, points.shape[1]))
    own = points[r.choice(len(points), n, replace=False)]
    far = lambda q, k: np.partition(np.linalg.norm(q[:, None] - points[None], axis=2), k, axis=1)[:, k]
    u, w = far(uniform, 0).sum(), far(own, 1).sum()
    return float(u / (u + w))
