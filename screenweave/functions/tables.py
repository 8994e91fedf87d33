"""Table functions (Python UDTFs) for SQL: `register` gives them to a session.

* `tile_grid(height, width, size, overlap)`: the tiles of a plane, the last ones clipped, each grown by the overlap within it.
* `islands(TABLE(SELECT key, at ...) PARTITION BY (key) ORDER BY (at), gap)`: stretches of a key's rows whose neighbours are at most `gap`
  apart, in one pass over each partition's sorted rows: the state is one stretch. Null places are passed over.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Row, SparkSession
from pyspark.sql.functions import udtf


@udtf(returnType="tile int, y0 int, x0 int, y1 int, x1 int")
class TileGrid:
    def eval(self, height: int, width: int, size: int, overlap: int) -> Iterator[tuple]:
        if size < 1:
            raise ValueError("tiles have a size of 1 or more")
        across = -(-width // size)
        for y in range(0, height, size):
            for x in range(0, width, size):
                yield y // size * across + x // size, max(0, y - overlap), max(0, x - overlap), min(height, y + size + overlap), min(width, x + size + overlap)


@udtf(returnType="key long, first long, last long, n long")
class Islands:
    """Rows (key, at) come by partition, sorted by `at`."""

    def __init__(self):
        self.now: list[int] | None = None

    def eval(self, row: Row, gap: int) -> Iterator[tuple]:
        key, at = row[0], row[1]
        if at is None:
            return
        if self.now is not None and at - self.now[2] <= gap:
            self.now[2] = at
            self.now[3] += 1
        else:
            if self.now is not None:
                yield tuple(self.now)
            self.now = [key, at, at, 1]

    def terminate(self) -> Iterator[tuple]:
        if self.now is not None:
            yield tuple(self.now)


def register(spark: SparkSession) -> None:
    spark.udtf.register("tile_grid", TileGrid)
    spark.udtf.register("islands", Islands)
