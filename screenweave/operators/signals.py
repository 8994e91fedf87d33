"""Signal and background of tiles from their planes and spots, and signal to noise around sampled spots.

Spots meet the planes (cycle, channel) of their tile, one tile a task at a time: a tile's planes and spots bound what is held. Background is
every pixel of the tile that no spot is near to; it isn't sampled. Around single spots, windows may reach into neighbouring tiles: each
tile gives its part of the window, and the parts are put together by spot.

Defined results: coordinates are rounded half to even; spots off their tile don't count. Tiles without spots, and planes without background,
have no rows. A spot's windows are clipped to the plane; without pixels under the percentile, or without spread, its ratio is null.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from screenweave.operators.rasters import SIZE, TILE, _kinds, _pixels

_STATS = "type string, mean double, median double, std double, count long, median_top double"


def widened(v: np.ndarray, width: int) -> np.ndarray:
    """Maximum over a square of `width` pixels around each; of an even square the larger half lies before the pixel."""
    for axis in (0, 1):
        edge = [(width // 2, width - 1 - width // 2) if a == axis else (0, 0) for a in (0, 1)]
        v = np.lib.stride_tricks.sliding_window_view(np.pad(v, edge, mode="symmetric"), width, axis=axis).max(axis=-1)
    return v


def far_from(y: np.ndarray, x: np.ndarray, shape: tuple[int, int], radius: int) -> np.ndarray:
    """True where no spot is within the radius: one pass over the disc's offsets, whatever the number of spots."""
    near = np.zeros(shape, dtype=bool)
    for dy in range(-radius, radius + 1):
        for dx in range(-radius, radius + 1):
            if dy * dy + dx * dx <= radius * radius:
                a, b = y + dy, x + dx
                ok = (a >= 0) & (a < shape[0]) & (b >= 0) & (b < shape[1])
                near[a[ok], b[ok]] = True
    return ~near


def _row(kind: str, v: np.ndarray, top: bool, times: np.ndarray | None = None) -> tuple:
    """Figures of values that occur so many times each (once)."""
    order = np.argsort(v, kind="stable")
    times = np.ones(len(v), np.int64) if times is None else times
    v, times = v[order], times[order]
    end = np.cumsum(times)
    n = int(end[-1])
    middle = lambda lo: float((v[np.searchsorted(end, (lo + n - 1) // 2, "right")] + v[np.searchsorted(end, (lo + n) // 2, "right")]) / 2)  # noqa: E731 -- median of the places from lo on
    mean = float((v * times).sum() / n)
    return kind, mean, middle(0), float(np.sqrt((times * (v - mean) ** 2).sum() / n)), n, middle(n - max(1, n // 10)) if top else None


def tile_stats(spots: DataFrame, tiles: DataFrame, keys: list[str] = (), size: int = SIZE, radius: int = 5, width: int = 10) -> DataFrame:
    """(keys, y0, x0, cycle, channel, type, mean, median, std, count, median_top): Signal (the widened plane at spots) and Background rows of each tile and plane."""
    keys = list(keys)
    place = [*keys, "_ty", "_tx"]
    at = spots.where("y IS NOT NULL AND x IS NOT NULL").select(*keys, F.bround("y").cast("long").alias("y"), F.bround("x").cast("long").alias("x"))
    at = at.withColumns({"_ty": F.floor(F.col("y") / size), "_tx": F.floor(F.col("x") / size)})
    at = at.groupBy(*place, "y", "x").agg(F.count("*").alias("n"))  # a tile's pixels bound what a task holds, whatever the number of spots
    planes = tiles.select(*keys, "cycle", "channel", *TILE).withColumns({"_ty": F.floor(F.col("y0") / size), "_tx": F.floor(F.col("x0") / size)})
    names = [*keys, "y0", "x0", "cycle", "channel", *[p.split()[0] for p in _STATS.split(", ")]]

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        for _, row in right.iterrows():
            plane = _pixels(row).astype(float)
            y, x = (left[c].to_numpy(np.int64) - row[f"{c}0"] for c in "yx")
            ok = (y >= 0) & (x >= 0) & (y < plane.shape[0]) & (x < plane.shape[1])
            if not ok.any():
                continue
            y, x, n = y[ok], x[ok], left["n"].to_numpy(np.int64)[ok]
            head = [*[row[k] for k in keys], row["y0"], row["x0"], row["cycle"], row["channel"]]
            back = plane[far_from(y, x, plane.shape, radius)]
            out.append((*head, *_row("Signal", widened(plane, width)[y, x], True, n)))
            if len(back):
                out.append((*head, *_row("Background", back, False)))
        return pd.DataFrame(out, columns=names)

    schema = f"{_kinds(tiles, keys)}y0 long, x0 long, {_kinds(tiles, ['cycle', 'channel'])}{_STATS}"
    return at.groupBy(*place).cogroup(planes.groupBy(*place)).applyInPandas(run, schema)


def tile_snr(stats: DataFrame, keys: list[str] = ()) -> DataFrame:
    """(keys, y0, x0, cycle, channel, snr): the signal's mean over the background's, in its deviations; not below 0, and 0 without a deviation or a background."""
    of = lambda kind, c: F.max(F.when(F.col("type") == kind, F.col(c)))
    wide = stats.groupBy(*keys, "y0", "x0", "cycle", "channel").agg(of("Signal", "mean").alias("_s"), of("Background", "mean").alias("_b"), of("Background", "std").alias("_d"))
    return wide.withColumn("snr", F.coalesce(F.greatest((F.col("_s") - F.col("_b")) / F.nullif(F.col("_d"), F.lit(0.0)), F.lit(0.0)), F.lit(0.0))).drop("_s", "_b", "_d")


def snr_by_round(spots: DataFrame, tiles: DataFrame, keys: list[str] = (), size: int = SIZE, samples: int = 50, near: int = 5, around: int = 50, percentile: float = 80.0) -> DataFrame:
    """(keys, cycle, channel, spots, snr): the mean over sampled spots of the largest value within `near` over the deviation of the values within `around` that are under the percentile.

    spots: keys, id, y, x; `samples` of each key, by the hash of the id.
    """
    from screenweave.operators.keyed import top_per_key

    keys = list(keys)
    own = spots.dropna(subset=["id", "y", "x"]).select(*keys, "id", F.col("y").cast("long").alias("y"), F.col("x").cast("long").alias("x"))
    chosen = top_per_key(own.withColumn("_all", F.lit(1)), [*keys, "_all"], [F.xxhash64("id"), "id"], samples).drop("_all")
    span = lambda c: F.sequence(F.floor((F.col(c) - around) / size), F.floor((F.col(c) + around - 1) / size))
    sent = chosen.withColumn("_ty", F.explode(span("y"))).withColumn("_tx", F.explode(span("x")))
    planes = tiles.select(*keys, "cycle", "channel", *TILE).withColumns({"_ty": F.floor(F.col("y0") / size), "_tx": F.floor(F.col("x0") / size)})
    place = [*keys, "_ty", "_tx"]
    kinds = f"{_kinds(tiles, keys)}{_kinds(chosen, ['id'])}{_kinds(tiles, ['cycle', 'channel'])}"
    names = [*keys, "id", "cycle", "channel", "top", "values"]

    def parts(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        for _, row in right.iterrows():
            plane = _pixels(row)
            for s in left.itertuples(index=False):
                y, x = s.y - row["y0"], s.x - row["x0"]
                cut = lambda r: plane[max(y - r, 0) : max(y + r, 0), max(x - r, 0) : max(x + r, 0)]  # noqa: B023, E731
                wide, close = cut(around), cut(near)
                if wide.size:
                    out.append((*[row[k] for k in keys], s.id, row["cycle"], row["channel"], float(close.max()) if close.size else None, wide.astype("<f8").tobytes()))
        return pd.DataFrame(out, columns=names)

    cropped = sent.groupBy(*place).cogroup(planes.groupBy(*place)).applyInPandas(parts, f"{kinds}top double, values binary")
    whole = cropped.groupBy(*keys, "id", "cycle", "channel").agg(F.max("top").alias("top"), F.collect_list("values").alias("values"))  # a window's parts: at most a few tiles

    def ratio(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            noise = []
            for values in b["values"]:
                v = np.frombuffer(b"".join(values), "<f8")
                low = v[v < np.percentile(v, percentile)]
                noise.append(float(low.std()) if len(low) and low.std() > 0 else None)
            yield b[[*keys, "id", "cycle", "channel", "top"]].assign(noise=pd.array(noise, dtype="Float64"))

    each = whole.mapInPandas(ratio, f"{kinds}top double, noise double")
    return each.groupBy(*keys, "cycle", "channel").agg(F.count("*").alias("spots"), F.avg(F.col("top") / F.col("noise")).alias("snr"))
