"""Wells that are complete, as a stateful stream: a well is told once, when all its tiles have arrived or its time is up.

Rows (well, tile, ts, expected, due): a tile's arrival, how many different tiles the well has, and until when it may take. The state of a
well is the set of its tiles so far, one value; it is emptied when the well is told; what stays is one flag. The time is event time: a well
whose tiles aren't all there is told as incomplete once the watermark has passed `due`. Tiles after `due` don't count.

`batch` gives the same answer from a whole table. A stream that is replayed, or that goes on from its checkpoint, tells each well once.

Defined results: rows without well or tile are left out; repeated tiles count once, and no more than `expected` are told; of different `expected` or `due` of a well those of its
first row count (in `batch` the least ones).
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Stands for a null number.
NONE = -(2**63)
TOLD = "well string, tiles long, expected long, complete boolean"


class Wells(StatefulProcessor):
    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        # each use of the state is a message to the JVM, so a well takes one value: at most one reading and one writing a batch
        self.well = handle.getValueState("arrived", "tiles array<string>, expected long, told boolean")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        before = self.well.get()
        tiles, expected, told = before or ([], None, False)
        there, due = set(tiles or ()), None
        known = len(there)
        for part in rows:
            if told:
                continue
            there.update(t for t in part["tile"].tolist() if t is not None)
            if expected is None:
                expected = next((e for e in part["expected"].tolist() if e != NONE), None)
            if due is None:
                due = next((d for d in part["due"].tolist() if d != NONE), None)
        if told:
            return
        if expected is not None and len(there) >= expected:
            yield self.tell(key, len(there), expected)
            return
        if before is None and due is not None:
            self.handle.registerTimer(due)
        if before is None or len(there) > known or expected != before[1]:
            self.well.update((sorted(there), expected, False))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        state = self.well.get()
        if state is not None and not state[2]:
            yield self.tell(key, len(state[0]), state[1])

    def tell(self, key, n: int, expected: int | None) -> pd.DataFrame:
        self.well.update(([], expected, True))
        return pd.DataFrame({"well": [key[0]], "tiles": [n if expected is None else min(n, expected)], "expected": [expected], "complete": [expected is not None and n >= expected]})

    def close(self) -> None:
        pass


def told(arrivals: DataFrame, late: str) -> DataFrame:
    """The wells of a stream of arrivals (a streaming frame), told as they complete or run out; `late`: by how much rows may be out of order."""
    rows = arrivals.where("well IS NOT NULL AND tile IS NOT NULL").withWatermark("ts", late)
    # what a row counts for is worked out here: workers get its tile, null if it doesn't count, and numbers
    number = lambda c: F.coalesce(c, F.lit(NONE))
    rows = rows.select(F.col("well").cast("string").alias("well"), F.when(F.col("ts") <= F.col("due"), F.col("tile").cast("string")).alias("tile"), "ts", number(F.col("expected").cast("long")).alias("expected"), number(F.unix_millis(F.col("due").cast("timestamp"))).alias("due"))
    return rows.groupBy("well").transformWithStateInPandas(Wells(), TOLD, "append", "EventTime")


def run(spark: SparkSession, arrivals: DataFrame, late: str, path: str, checkpoint: str) -> None:
    """Works off what has arrived, adds the wells that can be told to the Parquet table at `path`, and remembers the rest in the checkpoint."""
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", PROVIDER)
    try:
        told(arrivals, late).writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start().awaitTermination()
    finally:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", before)


def batch(arrivals: DataFrame) -> DataFrame:
    """The same from a whole table."""
    rows = arrivals.where("well IS NOT NULL AND tile IS NOT NULL")
    counted = F.when(F.col("ts") <= F.col("due"), F.col("tile"))
    out = rows.groupBy(F.col("well").cast("string").alias("well")).agg(F.countDistinct(counted).alias("tiles"), F.min("expected").cast("long").alias("expected"))
    return out.withColumns({"complete": F.coalesce(F.col("tiles") >= F.col("expected"), F.lit(False)), "tiles": F.least("tiles", "expected")})
