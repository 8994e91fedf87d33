"""Smaller operators of a screen: selections, unit and name conversions, registrations of a chain, audits, views and work lists."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from screenweave.functions.expressions import project_positions, snake_position

Keys = list[str]


# Selections


def confident(reads: DataFrame, threshold: float = 0.95, column: str = "confidence") -> DataFrame:
    """Reads of at least this confidence; none where the table has no such column."""
    return reads.where(F.col(column) >= threshold) if column in reads.columns else reads.limit(0)


def of_wells(rows: DataFrame, wells: list[str], column: str = "position") -> DataFrame:
    """Rows whose position begins with one of the wells (`A/1` or `A/1/0`); all rows without wells."""
    if not wells:
        return rows
    parts = [w.split("/")[:2] for w in wells]
    is_any = F.lit(False)
    for p in parts:
        is_any = is_any | (F.col(column) == "/".join(p)) | F.col(column).startswith("/".join(p) + "/")
    return rows.where(is_any)


def centre_positions(positions: DataFrame, n: int, total: int, seed: int, fraction: float = 0.5, index: str = "index") -> DataFrame:
    """n positions of a serpentine scan, drawn by a seeded hash from the max(n, fraction of all) that are nearest to the centre of the grid; all if there are no more than n."""
    if n >= total:
        return positions
    side = max(1, math.isqrt(total))
    at = snake_position(F.col(index), side)
    far = F.sqrt((at["row"] - side / 2) ** 2 + (at["column"] - side / 2) ** 2)
    inner = positions.withColumn("_d", far).orderBy("_d", index).limit(max(n, int(total * fraction))).drop("_d")
    return inner.withColumn("_h", F.xxhash64(F.lit(seed), F.col(index))).orderBy("_h", index).limit(n).drop("_h")


def evenly_spaced(rows: DataFrame, n: int, order: str) -> DataFrame:
    """n rows at even distances in an order of whole numbers from 0 (first and last included), by arithmetic on the number."""
    last = rows.agg(F.max(order).alias("_last"))
    k, at = F.col("_last"), F.col(order)
    # the number is the rounded place of some j in 0..n - 1
    j = F.round(at * (n - 1) / F.nullif(k, F.lit(0)))
    return rows.crossJoin(F.broadcast(last)).where((k < n) | (F.floor(j * k / max(n - 1, 1)) == at)).drop("_last")


def blank(rows: DataFrame, keys: Keys, least: str) -> DataFrame:
    """Keys that have a sample without any signal (its largest value is 0): a store that was written in part."""
    return rows.groupBy(*keys).agg(F.count("*").alias("samples"), F.count_if(F.col(least) == 0).alias("blank")).where("blank > 0")


def missing_rounds(wanted: DataFrame, available: DataFrame, key: str = "experiment") -> DataFrame:
    """(key, round) that are wanted (key, round) and beyond the number that there is (key, n_rounds); a key without a number lacks all."""
    return wanted.join(available, key, "left").where(F.col("round") >= F.coalesce("n_rounds", F.lit(0))).select(key, "round")


# Conversions


def equivalent_diameter(area: Column, scale: float) -> Column:
    """Diameter of the circle of an area in pixels, in units of `scale` a pixel."""
    return 2 * F.sqrt(area / math.pi) * scale


def in_units(df: DataFrame, lengths: Keys, areas: Keys, scale: float, suffix: str = "_um") -> DataFrame:
    """Lengths and areas in pixels as further columns in units of `scale` a pixel."""
    return df.withColumns({f"{c}{suffix}": F.col(c) * scale for c in lengths} | {f"{c}{suffix}2": F.col(c) * (scale * scale) for c in areas})


def significant(value: Column, digits: int = 2) -> Column:
    """A number as text with so many significant digits, never in powers of ten."""
    x = value.cast("double")
    places = F.greatest(F.lit(0), F.lit(digits - 1) - F.floor(F.log10(F.abs(x))).cast("int"))
    pattern = F.concat(F.lit("0"), F.when(places > 0, F.concat(F.lit("."), F.repeat(F.lit("0"), places))).otherwise(""))
    return F.when(F.abs(x) <= 1e-8, "0").otherwise(F.call_function("format_number", x, pattern))


def experiment_number(name: Column) -> Column:
    """33 of `ops0033` and of `op0033`; null for other names."""
    return F.nullif(F.regexp_extract(name, r"^ops?0*(\d+)", 1), F.lit("")).cast("int")


def unified_integers(df: DataFrame) -> DataFrame:
    """Double columns that hold whole numbers only (nulls aside) as long columns. One pass over the table tells which."""
    doubles = [f.name for f in df.schema if f.dataType.simpleString() in ("double", "float")]
    if not doubles:
        return df
    whole = lambda c: F.coalesce(F.bool_and(F.isnotnull(F.col(c)) & ~F.isnan(c) & (F.abs(c) < 2**53) & (F.col(c) == F.floor(c)) | F.col(c).isNull()), F.lit(False)) & (F.count(c) > 0)
    found = df.agg(*[whole(c).alias(c) for c in doubles]).first()
    return df.withColumns({c: F.col(c).cast("long") for c in doubles if found[c]})


def remapped(counts: DataFrame, codebook: DataFrame, length: int, offset: int, barcode: str = "barcode", code: str = "sgRNA") -> DataFrame:
    """Counts whose barcode is a code's first `length` bases get the code's bases from `offset` on; others keep theirs. Of codes with one beginning, the first."""
    keys = codebook.groupBy(project_positions(F.col(code), list(range(length))).alias("_key")).agg(F.min(code).alias("_code"))
    joined = counts.join(keys, F.col(barcode) == F.col("_key"), "left")
    return joined.withColumn(barcode, F.coalesce(F.expr(f"substring(_code, {offset + 1}, {length})"), F.col(barcode))).drop("_key", "_code")


def renamed_positions(tiles: DataFrame, layout: DataFrame, old: str = "position", new: str = "new_position") -> DataFrame:
    """Tiles under the names that a layout (old, new) gives to their positions: metadata only. Positions that the layout lacks are left out."""
    return tiles.join(layout.select(old, new), old).drop(old).withColumnRenamed(new, old)


def regrouped(df: DataFrame, first: Keys, last: Keys = ()) -> DataFrame:
    """The columns with these first and those last, where the frame has them."""
    middle = [c for c in df.columns if c not in first and c not in last]
    return df.select(*[c for c in first if c in df.columns], *middle, *[c for c in last if c in df.columns])


# Registrations: square matrices as arrays of rows


def multiplied(a: Column, b: Column) -> Column:
    """Product of two square matrices."""
    n = F.size(a)
    cell = lambda i, j: F.aggregate(F.sequence(F.lit(1), n), F.lit(0.0), lambda s, k: s + F.element_at(F.element_at(a, i), k) * F.element_at(F.element_at(b, k), j))
    return F.transform(F.sequence(F.lit(1), n), lambda i: F.transform(F.sequence(F.lit(1), n), lambda j: cell(i, j)))


def composed(matrices: DataFrame, keys: Keys, order: str, matrix: str = "m") -> DataFrame:
    """(keys, order, matrix): the product of a key's matrices up to each place of the order: step by step registrations as registrations to the first."""
    w = W.partitionBy(*keys).orderBy(order).rowsBetween(W.unboundedPreceding, 0)
    steps = matrices.withColumn("_all", F.collect_list(matrix).over(w))
    rest = F.slice(F.col("_all"), F.lit(2), F.size("_all"))
    return steps.select(*keys, order, F.aggregate(rest, F.element_at("_all", 1), lambda s, x: multiplied(x, s)).alias(matrix))


def affine_difference(a: Column, b: Column) -> Column:
    """translation (length), rotation (degrees) and scale (percent of a's) by which two affine matrices (y, x order) differ, with both determinants."""
    at = lambda m, i, j: m[i][j]
    det = lambda m: at(m, 0, 0) * at(m, 1, 1) - at(m, 0, 1) * at(m, 1, 0)
    turn = lambda m: F.atan2(at(m, 1, 0), at(m, 0, 0))
    size = lambda m: F.sqrt(det(m))
    moved = F.hypot(at(a, 0, 2) - at(b, 0, 2), at(a, 1, 2) - at(b, 1, 2))
    return F.struct(moved.alias("translation"), F.abs(F.degrees(turn(a) - turn(b))).alias("rotation_deg"), (100 * F.abs(size(a) - size(b)) / F.nullif(size(a), F.lit(0.0))).alias("scale_pct"), det(a).alias("determinant_a"), det(b).alias("determinant_b"))


# Audits and reports


def channel_audit(found: DataFrame, expected: DataFrame, keys: Keys) -> DataFrame:
    """(keys, index, channel, expected, finding) from channels that stores have and should have (keys, index, channel): ok, renamed, extra or missing."""
    b = expected.withColumnRenamed("channel", "expected")
    both = found.join(b, [*keys, "index"], "full_outer")
    finding = F.when(F.col("expected").isNull(), "extra").when(F.col("channel").isNull(), "missing").when(F.col("channel") != F.col("expected"), "renamed").otherwise("ok")
    return both.withColumn("finding", finding)


def combined_metrics(rows: DataFrame, keys: Keys, metrics: Keys, metric: str = "metric", value: str = "value") -> DataFrame:
    """Long metrics of pairs as one wide row for each key."""
    return rows.groupBy(*keys).pivot(metric, metrics).agg(F.first(value, ignorenulls=True))


def below_threshold(rows: DataFrame, keys: Keys, metric: str, threshold: float) -> DataFrame:
    """Keys whose metric is missing or under the threshold."""
    return rows.groupBy(*keys).agg(F.max(metric).alias(metric)).where(F.col(metric).isNull() | (F.col(metric) < threshold))


def cells_of(cells: DataFrame, gene: str, n: int, seed: int, ident: str = "cell", guide: str = "sgRNA", column: str = "gene") -> DataFrame:
    """Up to n cells of a gene, drawn by a seeded hash, by guide."""
    drawn = cells.where(F.col(column) == gene).withColumn("_h", F.xxhash64(F.lit(seed), F.col(ident))).orderBy("_h", ident).limit(n)
    return drawn.drop("_h").orderBy(guide, ident)


def control_pool(cells: DataFrame, gene: str = "gene", prefix: str = "NTC", segment: str = "segmentation_id", place: Keys = ("y", "x")) -> DataFrame:
    """Cells without gene or with one that begins with the prefix, that have a segment and a place."""
    named = F.col(gene).isNull() | F.col(gene).startswith(prefix)
    return cells.where(named & (F.col(segment) > 0)).dropna(subset=list(place))


def linking_report(unified: DataFrame, keys: Keys, sides: dict[str, str], barcode: str = "barcode") -> DataFrame:
    """By key: cells, and how many and what share in percent link to each side (name: its key column) and have a barcode; those that link to all sides."""
    n = F.count("*")
    every = F.lit(True)
    for c in sides.values():
        every = every & F.col(c).isNotNull()
    parts = {name: F.count(c) for name, c in sides.items()} | {"barcode": F.count_if(F.col(barcode).isNotNull() & (F.col(barcode) != "0")), "all": F.count_if(every)}
    return unified.groupBy(*keys).agg(n.alias("cells"), *[v.alias(f"with_{k}") for k, v in parts.items()], *[F.round(100.0 * v / n, 2).alias(f"pct_{k}") for k, v in parts.items()])


def overridden(configs: DataFrame, overrides: DataFrame, key: str, settings: str = "settings") -> DataFrame:
    """Configurations (key, settings: a map) with the key's overrides (key, settings) laid over them, setting by setting."""
    over = overrides.select(key, F.col(settings).alias("_over"))
    none = F.create_map().cast("map<string,string>")
    laid = F.map_zip_with(F.coalesce(F.col(settings), none), F.coalesce(F.col("_over"), none), lambda k, a, b: F.coalesce(b, a))
    return configs.join(over, key, "left").withColumn(settings, laid).drop("_over")


# Work lists: the channel algebra of a pipeline as tables


def combined(a: DataFrame, b: DataFrame) -> DataFrame:
    """Every item of one list with every item of another: work lists are small, the number of pairs is held against a bound."""
    n = [d.limit(100_001).count() for d in (a, b)]
    if max(n) > 100_000 or n[0] * n[1] > 1_000_000:
        raise ValueError("a work list has at most 100,000 items, two together at most a million pairs")
    return a.crossJoin(b)


def grouped(items: DataFrame, keys: Keys, item: str) -> DataFrame:
    """A key's items as one sorted array."""
    return items.groupBy(*keys).agg(F.sort_array(F.collect_list(item)).alias(item))


def batches(items: DataFrame, keys: Keys, item: str, size: int) -> DataFrame:
    """(keys, batch, items): a key's items in arrays of at most `size`, in their order."""
    k = F.row_number().over(W.partitionBy(*keys).orderBy(item)) - 1
    return grouped(items.withColumn("batch", F.floor(k / size)), [*keys, "batch"], item)


def time_limits(steps: DataFrame, wells: str = "n_wells", minutes: str = "minutes", per: int = 3) -> DataFrame:
    """A step's time limit times the number of groups of `per` wells, for more than `per` of them."""
    return steps.withColumn("limit_minutes", F.when(F.col(wells) > per, F.col(minutes) * F.ceil(F.col(wells) / per)).otherwise(F.col(minutes)))
