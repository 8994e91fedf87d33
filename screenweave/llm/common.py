"""Small things that the operators of this subpackage share: held-out folds, scratch tables, chunks of texts."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Texts of a batch are handled in chunks of about so many characters, so that working arrays stay small.
CHUNK_CHARS = 500_000
#: Bytes of an Arrow batch between the JVM and Python: a batch is held on both sides, and once more as strings.
BATCH_BYTES = 8 << 20
#: Spark's setting for deleting a query's shuffle files when it ends; else they stay until the driver happens to collect its garbage.
CLEANED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def bounded(spark: SparkSession) -> None:
    """Bounds Arrow batches by their bytes, as texts may be long."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def tidy() -> None:
    """Gives freed memory back to the system: Python workers live on between tasks, beside an executor's heap."""
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bounded(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(doc_id: str, n: int) -> Column:
    """crc32 of the id as text, mod n; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % n


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, changed where the frame has such columns already."""
    have = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in have:
            name = f"_{name}"
        have.add(name.lower())
        out.append(name)
    return out


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir; where it is unset, on one machine as in tests, one under the warehouse."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        found = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/scratch"
    return found.rstrip("/")


def written(df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
    """The frame as a table in the shared folder, read again: cuts lineage and survives lost executors. The shuffle files that it took are deleted."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(CLEANED, "false")
    spark.conf.set(CLEANED, "true")
    try:
        df.write.option("compression", codec).parquet(path)
    finally:
        spark.conf.set(CLEANED, before)
    return spark.read.schema(df.schema).parquet(path)


def dropped(df: DataFrame) -> None:
    """Deletes the files of a written() table."""
    sc = df.sparkSession.sparkContext
    for file in df.inputFiles()[:1]:
        path = sc._jvm.org.apache.hadoop.fs.Path(file).getParent()
        path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


def chunks(texts, limit: int = CHUNK_CHARS) -> Iterator[slice]:
    """Slices of consecutive texts of at most about `limit` characters; a longer text is a slice of its own."""
    begin, size = 0, 0
    for i, t in enumerate(texts):
        n = len(t) if t is not None else 0
        if size and size + n > limit:
            yield slice(begin, i)
            begin, size = i, 0
        size += n
    if begin < len(texts):
        yield slice(begin, len(texts))
