"""Numbers by place: the position of rows in files, joins by position, dense numbers of values. No task sees all rows.

`positions` numbers the rows of files in the order of the files' names and of the rows in them. Spark tells each row its file and the
block of it that the task reads; rows of a block come in their order. Counting by block gives each block its offset, a running sum
over one row for each block. The numbers don't depend on which task reads which block.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from screenweave.operators.scratch import saved

#: Blocks of values that are numbered side by side.
RANGES = 64


def positions(files: DataFrame, name: str = "position") -> DataFrame:
    """The rows of a frame that reads files (nothing but selections and filters of columns before), with their place from 0."""
    block = {"_file": F.col("_metadata.file_path"), "_block": F.col("_metadata.file_block_start"), "_at": F.monotonically_increasing_id()}
    rows = files.select("*", *[v.alias(k) for k, v in block.items()])
    own = rows.groupBy("_file", "_block").agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(W.orderBy("_file", "_block").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))  # a row for each block
    offsets = own.withColumn("_offset", before - F.col("_first")).drop("_first", "_n")
    return rows.join(offsets, ["_file", "_block"]).withColumn(name, F.col("_at") + F.col("_offset")).drop("_file", "_block", "_at", "_offset")


def joined_by_position(observations: DataFrame, points: DataFrame) -> DataFrame:
    """The rows of one file table with those of another at the same place: what the second has beyond the first's end is cut off, what it lacks is null. Columns of the second that the first has too are left out."""
    left, right = positions(observations), positions(points)
    extra = [c for c in points.columns if c.lower() not in {x.lower() for x in observations.columns}]
    return left.join(right.select("position", *extra), "position", "left")


def dense(df: DataFrame, value: str, name: str = "number") -> DataFrame:
    """(value, name): the distinct values numbered 1..n in their order, in ranges side by side."""
    own = df.select(value).distinct().repartitionByRange(RANGES, value)
    ranged = saved(own.withColumn("_range", F.spark_partition_id()), "ranges")
    before = F.coalesce(F.sum("_n").over(W.orderBy("_range").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    offsets = ranged.groupBy("_range").agg(F.count("*").alias("_n")).withColumn("_before", before).drop("_n")
    local = ranged.withColumn("_k", F.row_number().over(W.partitionBy("_range").orderBy(value)))
    return local.join(offsets, "_range").select(value, (F.col("_before") + F.col("_k")).alias(name))


def first_by_hash(df: DataFrame, keys: list[str], hashed: Column, wanted: str, digits: int = 4) -> DataFrame:
    """By key, as many rows as the column `wanted` says, in the order of a hash that is a text of hexadecimal digits.

    Rows are counted by the hash's first digits; only rows of the digits at which the number is reached are ranked.
    """
    rows = df.withColumn("_h", hashed).withColumn("_p", F.substring("_h", 1, digits))
    by = rows.groupBy(*keys, "_p").agg(F.count("*").alias("_n"))
    before = by.withColumn("_before", F.coalesce(F.sum("_n").over(W.partitionBy(*keys).orderBy("_p").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    both = rows.join(before, [*keys, "_p"]).where(F.col("_before") < F.col(wanted))
    cut = F.col("_before") + F.col("_n") > F.col(wanted)
    ranked = both.where(cut).withColumn("_k", F.row_number().over(W.partitionBy(*keys, "_p").orderBy("_h"))).where(F.col("_before") + F.col("_k") <= F.col(wanted)).drop("_k")
    return both.where(~cut).unionByName(ranked).drop("_h", "_p", "_n", "_before")
