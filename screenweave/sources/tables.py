"""Scans and sinks of tables: CSV by well, cached Parquet, keyed appends, safe overwrites, listings. All paths go through Spark's file systems."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def listing(spark: SparkSession, pattern: str) -> list[tuple[str, int, int]]:
    """(path, bytes, modified) of what matches a glob."""
    fs, p = _fs(spark, pattern)
    found = fs.globStatus(p)
    return sorted((str(s.getPath().toString()), int(s.getLen()), int(s.getModificationTime())) for s in found or [])


def completed(spark: SparkSession, path: str) -> bool:
    """Whether an output is there and not empty: a non-empty file, or a folder that was committed or holds something."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return False
    status = fs.getFileStatus(p)
    return status.getLen() > 0 if status.isFile() else len(fs.listStatus(p)) > 0


def read_wells(spark: SparkSession, pattern: str, schema: str) -> DataFrame:
    """CSV files of a glob with a header, and the well: the file name up to its first underscore."""
    df = spark.read.schema(schema).csv(pattern, header=True)
    return df.withColumn("well", F.regexp_extract(F.input_file_name(), r"([^/_]+)_[^/]*$", 1))


def read_optional(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A CSV table, or no rows where it is absent."""
    return spark.read.schema(schema).csv(path, header=True) if listing(spark, path) else spark.createDataFrame([], schema)


def drop_unnamed(df: DataFrame, prefix: str = "Unnamed") -> DataFrame:
    return df.select([c for c in df.columns if not c.startswith(prefix)])


def resolved(df: DataFrame, *candidates: str) -> str | None:
    """The first of these columns that the frame has."""
    return next((c for c in candidates if c in df.columns), None)


def write_csv(df: DataFrame, path: str) -> None:
    """An export; how many files it has is up to the frame's partitions."""
    df.write.mode("overwrite").csv(path, header=True)


def replace(df: DataFrame, path: str, backup: str | None = None) -> None:
    """Writes beside the old table and swaps, so that a frame may be read from the path that it replaces. The first old table is kept as backup.

    The old table is moved aside before the new one takes its name, and deleted after: if the driver is lost in between,
    the old rows are at `<path>.old` (or the backup) and the new ones at `<path>.new`.
    """
    spark = df.sparkSession
    fs, target = _fs(spark, path)
    _, new = _fs(spark, f"{path}.new")
    _, old = _fs(spark, backup or f"{path}.old")
    df.write.mode("overwrite").parquet(f"{path}.new")
    keep = bool(backup) and not fs.exists(old)
    _, aside = (fs, old) if keep else _fs(spark, f"{path}.old")
    if fs.exists(target):
        if not keep and fs.exists(aside):
            fs.delete(aside, True)
        fs.rename(target, aside)
    fs.rename(new, target)
    if not keep and fs.exists(aside):
        fs.delete(aside, True)


def cached(spark: SparkSession, path: str, build: Callable[[], DataFrame], force: bool = False) -> DataFrame:
    """The table at a path, built if it isn't there."""
    if force or not exists(spark, f"{path}/_SUCCESS"):
        build().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def upsert_partitions(df: DataFrame, path: str, key: str) -> None:
    """Replaces just the partitions of the keys that the frame has."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(key).parquet(path)


def read_key(spark: SparkSession, path: str, key: str, value) -> DataFrame:
    """One key's rows; only its partition is read."""
    return spark.read.parquet(path).where(F.col(key) == value)


def status_key(spark: SparkSession, pattern: str) -> str:
    """A digest of a listing, to key what was worked out from its files."""
    import hashlib

    return hashlib.sha256(json.dumps(listing(spark, pattern)).encode()).hexdigest()


def read_config(spark: SparkSession, path: str) -> dict:
    """A JSON or, where the yaml module is there, a YAML file as a dictionary."""
    text = "\n".join(r["value"] for r in spark.read.text(path, wholetext=True).collect())
    if not path.lower().endswith((".yaml", ".yml")):
        return json.loads(text)
    try:
        import yaml
    except ImportError as e:
        raise ValueError("reading YAML needs the yaml module") from e
    return yaml.safe_load(text) or {}


def cumulative_transforms(spark: SparkSession, pattern: str, field: str = "affine_transform_zyx") -> DataFrame:
    """(key, m, inverse) of the files of a glob `<key>_cumulative.yaml` (or .json): the 3 x 3 part in y, x of each 4 x 4 matrix, by the number or name before the underscore; `nuclei` is -1, `pre` -2."""
    found = {}
    for path, _, _ in listing(spark, pattern):
        name = path.rsplit("/", 1)[-1].split("_cumulative")[0]
        key = {"nuclei": "-1", "pre": "-2"}.get(name, name.removeprefix("round"))
        found[key] = [row[1:] for row in read_config(spark, path)[field][1:]]
    return affines(found, spark)


def rounds_as_time(stores: dict[int, DataFrame]) -> DataFrame:
    """Several rounds' tiles as one frame with the round as time: a view, no copy."""
    out = None
    for t, df in sorted(stores.items()):
        part = df.withColumn("t", F.lit(t))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out


def affines(matrices: dict[str, list[list[float]]], spark: SparkSession) -> DataFrame:
    """(key, m, inverse) of square matrices by key."""
    import numpy as np

    rows = [(k, [[float(x) for x in r] for r in m], np.linalg.inv(np.array(m, dtype=float)).tolist()) for k, m in matrices.items()]
    return spark.createDataFrame(rows, "key string, m array<array<double>>, inverse array<array<double>>")
