"""Scalar expressions. All run inside the JVM, none needs a Python worker."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def project_positions(text: Column, positions: list[int]) -> Column:
    """The characters at these places (from 0) of a string; places past its end are skipped."""
    if not positions:
        return F.when(text.isNotNull(), "")
    return F.concat(*[F.substring(text, p + 1, 1) for p in positions])


def characters(text: Column) -> Column:
    """The characters of a string as an array."""
    return F.filter(F.split(text, ""), lambda c: c != "")


def entropy(text: Column) -> Column:
    """Shannon entropy of a string's characters in bits: - sum p log2(p + 1e-9)."""
    n = F.length(text)
    share = lambda c: (n - F.length(F.replace(text, c, F.lit("")))) / n
    terms = F.transform(F.array_sort(F.array_distinct(characters(text))), lambda c: -share(c) * F.log2(share(c) + 1e-9))
    return F.aggregate(terms, F.lit(0.0), lambda a, x: a + x)


def argmax_base(intensities: Column, bases: Column) -> Column:
    """The base of the brightest channel; of ties the first."""
    return F.element_at(bases, F.array_position(intensities, F.array_max(intensities)).cast("int"))


def base_quality(intensities: Column) -> Column:
    """clip(2 (1 - ln(2 + second) / ln(2 + first)), 0, 1) of an array's two largest values, sorted by value and taken without sign."""
    ordered = F.sort_array(intensities, asc=False)
    first, second = F.abs(F.element_at(ordered, 1)), F.abs(F.element_at(ordered, 2))
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), 2 * (1 - F.log(2 + second) / F.log(2 + first))))


def well_key(well: Column) -> Column:
    """`A/1/0` and `A/1` become `A1`; others stay."""
    return F.regexp_replace(well, r"^([A-Za-z]+)/(\d+)(?:/\d+)?$", "$1$2")


def well_path(well: Column) -> Column:
    """`A1` becomes `A/1/0`; what has slashes stays."""
    return F.when(well.contains("/"), well).otherwise(F.regexp_replace(well, r"^([A-Za-z]+)(\d+)$", "$1/$2/0"))


def bounding_box(text: Column) -> Column:
    """Struct of the four integers in a text like `(1, 2, 30, 40)`; null if there aren't four."""
    parts = F.transform(F.regexp_extract_all(text, F.lit(r"(\d+)")), lambda x: x.cast("int"))
    names = ("min_row", "min_col", "max_row", "max_col")
    return F.when(F.size(parts) == 4, F.struct(*[F.element_at(parts, k + 1).alias(n) for k, n in enumerate(names)]))


def numbers(text: Column) -> Column:
    """The runs of digits in a text as an array of texts; one empty text if there are none."""
    return F.split(F.trim(F.regexp_replace(text, "[^0-9]+", " ")), " ")


def box_shape(box: Column, large: float) -> Column:
    """height, width, area, aspect (null for width 0) and whether both sides are at least `large`."""
    h, w = box["max_row"] - box["min_row"], box["max_col"] - box["min_col"]
    return F.struct(h.alias("height"), w.alias("width"), (h * w).alias("area"), F.when(w != 0, h / w).alias("aspect"), ((h >= large) & (w >= large)).alias("is_large"))


def box_or_window(box: Column, y: Column, x: Column, half: int, height: Column, width: Column) -> Column:
    """The box, or else a window of `half` around the point, clipped to the image."""
    edge = lambda v, top: F.greatest(F.lit(0), F.least(v, top)).cast("int")
    return F.coalesce(box, F.struct(edge(y - half, height).alias("min_row"), edge(x - half, width).alias("min_col"), edge(y + half, height).alias("max_row"), edge(x + half, width).alias("max_col")))


def snake_position(index: Column, columns: int) -> Column:
    """(row, column) of the index-th tile of a serpentine scan: odd rows run backwards."""
    row, col = F.floor(index / columns).cast("int"), (index % columns).cast("int")
    return F.struct(row.alias("row"), F.when(row % 2 == 1, columns - 1 - col).otherwise(col).alias("column"))


def affine_point(matrix: list[list[float]], y: Column, x: Column) -> Column:
    """Struct (y, x) of a 3 x 3 matrix in y, x order applied to a point."""
    rows = [matrix[k][0] * y + matrix[k][1] * x + matrix[k][2] for k in (0, 1, 2)]
    return F.struct((rows[0] / rows[2]).alias("y"), (rows[1] / rows[2]).alias("x"))


def swapped_axes(matrix: list[list[float]]) -> list[list[float]]:
    """A 3 x 3 matrix in x, y order as one in y, x order, and back."""
    at = (1, 0, 2)
    return [[matrix[i][j] for j in at] for i in at]


def drift(dy: Column, dx: Column) -> Column:
    """Magnitude and angle in degrees of a translation."""
    return F.struct(F.hypot(dx, dy).alias("magnitude"), F.degrees(F.atan2(dy, dx)).alias("angle_deg"))


def relative_status(reference: Column, candidate: Column, tolerance: float) -> Column:
    """pass, fail, both_nan, ref_nan or cand_nan for two numbers."""
    gone = lambda c: c.isNull() | F.isnan(c)
    off = F.abs(candidate - reference) / F.when(reference == 0, 1.0).otherwise(F.abs(reference))
    return F.when(gone(reference) & gone(candidate), "both_nan").when(gone(reference), "ref_nan").when(gone(candidate), "cand_nan").when(off <= tolerance, "pass").otherwise("fail")


def signal_metrics(signal: Column, noise: Column, signal_sd: Column, noise_sd: Column) -> Column:
    """snr, sbr, lld and z-prime of a signal against its background."""
    e = 1e-9
    return F.struct(
        ((signal - noise) / (noise_sd + e)).alias("snr"), (signal / (noise + e)).alias("sbr"), (3 * noise_sd / ((signal - noise) + e)).alias("lld"), (1 - 3 * (signal_sd + noise_sd) / (F.abs(signal - noise) + e)).alias("z_prime")
    )


def finite(x: Column) -> Column:
    return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))


def is_control(ident: Column, control: int = -1) -> Column:
    """Null ids are not controls."""
    return F.coalesce(ident == control, F.lit(False))


def gene_or_control(gene: Column, barcode: Column) -> Column:
    return F.coalesce(gene, F.concat(F.lit("NTC_"), barcode))


def vector_distance(a: Column, b: Column) -> Column:
    """L1 distance of two arrays."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: F.abs(x - y)), F.lit(0.0), lambda s, v: s + v)


def mismatches(a: Column, b: Column) -> Column:
    """Number of places at which two strings differ, over the shorter one's length."""
    n = F.least(F.length(a), F.length(b))
    places = F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>"))
    return F.size(F.filter(places, lambda i: F.substring(a, i, F.lit(1)) != F.substring(b, i, F.lit(1))))


def category(metric: Column, prefixes: list[tuple[str, str]], other: str = "other") -> Column:
    """The category of the first prefix that a metric's name begins with."""
    out = F.lit(other)
    for prefix, name in reversed(prefixes):
        out = F.when(metric.startswith(prefix), name).otherwise(out)
    return out
