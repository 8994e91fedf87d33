"""Structured Streaming: windowed counts with late data, sessions, first arrivals, and a queue of files worked off as it fills."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def windowed(events: DataFrame, keys: list[str], width: str, late: str, slide: str | None = None) -> DataFrame:
    """(begin, end, keys..., n, total) by event time; rows later than `late` are dropped once their window is closed."""
    w = F.window("ts", width, slide) if slide else F.window("ts", width)
    out = events.withWatermark("ts", late).groupBy(w, *keys).agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    return out.select(F.col("window.start").alias("begin"), F.col("window.end").alias("end"), *keys, "n", "total")


def sessions(events: DataFrame, key: str, gap: str, late: str) -> DataFrame:
    out = events.withWatermark("ts", late).groupBy(F.session_window("ts", gap), key).agg(F.count("*").alias("n"))
    return out.select(key, F.col("session_window.start").alias("begin"), F.col("session_window.end").alias("end"), "n")


def first_arrivals(events: DataFrame, keys: list[str], late: str) -> DataFrame:
    """Each key's first row within the watermark."""
    return events.withWatermark("ts", late).dropDuplicatesWithinWatermark(keys)


def work_off(spark: SparkSession, folder: str, schema: str, checkpoint: str, work: Callable[[DataFrame, int], None], files: int = 8) -> None:
    """Hands the JSON files of a folder that are new since the last call to `work`, in batches of so many files, each exactly once by the checkpoint."""
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files).json(folder)
    stream.writeStream.foreachBatch(work).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
