"""Tables in the shared folder that cut a plan's lineage."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def shared(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir; where none is set, on one machine only, one under the warehouse."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        root = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/scratch"
    return root.rstrip("/")


def saved(df: DataFrame, name: str) -> DataFrame:
    """The frame as a table in the shared folder, read again: finished work survives lost executors."""
    spark = df.sparkSession
    path = f"{shared(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
