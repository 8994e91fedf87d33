"""A sink of zarr arrays (version 3) that tasks fill shard by shard and the driver commits.

`written` cuts tiles along the shards, brings the pieces of a shard together and hands them to the `zarr_tiles` writer. A task
assembles one shard at a time, writes it under a name of its own and moves it to its place when it is whole: a killed task
leaves no half shard, and a second attempt or a speculative copy puts the same bytes there. A new array is built in a folder
beside its place; the driver's commit writes the metadata last and then moves the folder, an abort removes it, so readers
see the old array or the new one. Appending keeps the array and replaces whole shards, with what they held before below
the new tiles; the array's shape, chunks and type must be the ones it has.

Resharding is a read and a write (`resharded`). Moving needs a file system that can (local, HDFS): object stores can't.

Defined results: pixels that no tile covers have the fill value 0; chunks of 0 only aren't stored. Of tiles that overlap, the one
whose bytes sort last lies on top, whatever the order of rows. Tiles beyond the shape are cut. No tiles give an array of 0.
"""

from __future__ import annotations

import json
import struct
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSourceArrowWriter, WriterCommitMessage

from screenweave.sources.arrays import Array, _bytes, _open, register

_PARTS = ".parts"


def metadata(shape: list[int], chunks: list[int], shard: list[int] | None, dtype: str, level: int = 3) -> dict:
    """The array's zarr.json. `shard`: a file's shape, a multiple of the chunks; None: a file for each chunk."""
    inner = [{"name": "bytes", "configuration": {"endian": "little"}}, {"name": "zstd", "configuration": {"level": level, "checksum": False}}]
    codecs = inner
    if shard is not None:
        if any(s % c for s, c in zip(shard, chunks)):
            raise ValueError("a shard's shape must be a multiple of the chunks'")
        codecs = [{"name": "sharding_indexed", "configuration": {"chunk_shape": chunks, "codecs": inner, "index_codecs": inner[:1], "index_location": "end"}}]
    return {
        "zarr_format": 3, "node_type": "array", "shape": shape, "data_type": np.dtype(dtype).name, "fill_value": False if np.dtype(dtype).kind == "b" else 0, "attributes": {}, "codecs": codecs,
        "chunk_grid": {"name": "regular", "configuration": {"chunk_shape": shard or chunks}}, "chunk_key_encoding": {"name": "default", "configuration": {"separator": "/"}},
    }


@dataclass
class Wrote(WriterCommitMessage):
    shards: int


class ShardWriter(DataSourceArrowWriter):
    """Rows (key: the shard's place, index, y0, x0, h, w, dtype, data), those of a shard in one task and next to each other."""

    def __init__(self, options: dict, overwrite: bool):
        self.path = options["path"].rstrip("/")
        self.meta = json.loads(options["metadata"])
        self.new = overwrite
        system, place = _open(self.path)
        held = _bytes(system, f"{place}/zarr.json")
        if not overwrite and held is not None:
            have = json.loads(held)
            if any(have[k] != self.meta[k] for k in ("shape", "data_type", "chunk_grid", "codecs")):
                raise ValueError("the array has another shape, type or layout")
        elif not overwrite:
            self.new = True
        self.into = f"{self.path}.new-{uuid.uuid4().hex}" if self.new else self.path

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        array, held, key, shards = Array.of(self.into, self.meta), [], None, 0
        for b in iterator:
            for row in b.to_pylist():
                if row["key"] != key and held:
                    self.shard(array, key, held)
                    held, shards = [], shards + 1
                key = row["key"]
                held.append(row)
        if held:
            self.shard(array, key, held)
            shards += 1
        return Wrote(shards)

    def shard(self, array: Array, key: str, rows: list[dict]) -> None:
        """Writes one shard: what it holds already, and the tiles on top."""
        at = [int(k) for k in key.split("/")]
        parts = array.shard or [1] * len(at)
        size = [c * p for c, p in zip(array.chunks, parts)]
        start = [k * s for k, s in zip(at, size)]
        whole = np.zeros(size, dtype=array.dtype)
        if not self.new:
            for inner in np.ndindex(*parts):
                place = [k * p + i for k, p, i in zip(at, parts, inner)]
                if all(p * c < n for p, c, n in zip(place, array.chunks, array.shape)):
                    old = array.chunk(place)
                    whole[tuple(slice(i * c, i * c + n) for i, c, n in zip(inner, array.chunks, old.shape))] = old
        for row in sorted(rows, key=lambda r: (r["index"], r["y0"], r["x0"], r["h"], r["w"], r["data"])):
            tile = np.frombuffer(row["data"], dtype=row["dtype"]).reshape(row["h"], row["w"])
            if not np.can_cast(tile.dtype, array.dtype, "same_kind"):
                raise ValueError(f"{tile.dtype} doesn't fit {array.dtype}")
            lead = tuple(i - s for i, s in zip(row["index"], start))
            span = [(max(o, s), min(o + n, s + m, total)) for o, s, n, m, total in zip((row["y0"], row["x0"]), start[-2:], tile.shape, size[-2:], array.shape[-2:])]
            to = tuple(slice(a - s, b - s) for (a, b), s in zip(span, start[-2:]))
            whole[(*lead, *to)] = tile[tuple(slice(a - o, b - o) for (a, b), o in zip(span, (row["y0"], row["x0"])))]
        self.put(f"c/{key}", self.encoded(array, whole, parts))

    def encoded(self, array: Array, whole: np.ndarray, parts: list[int]) -> bytes:
        import zstandard

        level = (self.meta["codecs"][0]["configuration"]["codecs"] if array.shard else self.meta["codecs"])[1]["configuration"]["level"]
        body, index, at = [], [], 0
        for inner in np.ndindex(*parts):
            chunk = whole[tuple(slice(i * c, i * c + c) for i, c in zip(inner, array.chunks))]
            if chunk.any() or not array.shard:
                data = zstandard.ZstdCompressor(level=level).compress(np.ascontiguousarray(chunk).tobytes())
                body.append(data)
                index.append((at, len(data)))
                at += len(data)
            else:
                index.append((2**64 - 1, 2**64 - 1))
        if array.shard:
            body.append(b"".join(struct.pack("<QQ", *x) for x in index))
        return b"".join(body)

    def put(self, name: str, data: bytes) -> None:
        """Writes a file under another name and moves it to its place."""
        system, top = _open(self.into)
        part = f"{top}/{_PARTS}/{uuid.uuid4().hex}"
        for file in (part, f"{top}/{name}"):
            system.create_dir(file.rsplit("/", 1)[0], recursive=True)
        with system.open_output_stream(part) as f:
            f.write(data)
        system.move(part, f"{top}/{name}")

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        from pyarrow import fs

        system, top = _open(self.into)
        if self.new:
            self.put("zarr.json", json.dumps(self.meta).encode())
        if system.get_file_info(f"{top}/{_PARTS}").type == fs.FileType.Directory:
            system.delete_dir(f"{top}/{_PARTS}")
        if self.new:
            place = _open(self.path)[1]
            if system.get_file_info(place).type == fs.FileType.Directory:
                system.delete_dir(place)
            system.move(top, place)

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        from pyarrow import fs

        system, top = _open(self.into)
        gone = top if self.new else f"{top}/{_PARTS}"
        if system.get_file_info(gone).type == fs.FileType.Directory:
            system.delete_dir(gone)


def written(tiles: DataFrame, path: str, shape: list[int], chunks: list[int], dtype: str, shard: list[int] | None = None, append: bool = False) -> None:
    """Writes tiles (index: the leading axes, y0, x0, h, w, dtype, data) as the array at `path`."""
    if not len(shape) == len(chunks) >= 2 or shard is not None and len(shard) != len(shape):
        raise ValueError("shape, chunks and shard need the same number of axes, two or more")
    register(tiles.sparkSession)
    size = shard or chunks
    if any(c != 1 for c in size[:-2]):
        raise ValueError("leading axes are written one place at a time")
    inside = tiles.where((F.col("y0") < shape[-2]) & (F.col("x0") < shape[-1]) & (F.col("y0") + F.col("h") > 0) & (F.col("x0") + F.col("w") > 0))
    span = lambda o, n, s, total: F.sequence(F.floor(F.greatest(F.col(o), F.lit(0)) / s), F.floor((F.least(F.col(o) + F.col(n), F.lit(total)) - 1) / s))
    cut = inside.withColumn("_ty", F.explode(span("y0", "h", size[-2], shape[-2]))).withColumn("_tx", F.explode(span("x0", "w", size[-1], shape[-1])))
    key = F.concat_ws("/", *([F.array_join(F.col("index").cast("array<string>"), "/")] if len(shape) > 2 else []), F.col("_ty").cast("string"), F.col("_tx").cast("string"))
    rows = cut.select(key.alias("key"), F.col("index").cast("array<int>").alias("index"), F.col("y0").cast("long").alias("y0"), F.col("x0").cast("long").alias("x0"), F.col("h").cast("int").alias("h"), F.col("w").cast("int").alias("w"), "dtype", "data")
    rows.repartition("key").sortWithinPartitions("key").write.format("zarr_tiles").option("metadata", json.dumps(metadata(shape, chunks, shard, dtype))).mode("append" if append else "overwrite").save(path)


def tiles_of(spark: SparkSession, path: str) -> DataFrame:
    """The tiles of the array or arrays at `path`, a tile for each chunk."""
    register(spark)
    return spark.read.format("zarr_tiles").load(path)


def resharded(spark: SparkSession, path: str, to: str, chunks: list[int], shard: list[int] | None = None) -> None:
    """Copies the array at `path` with other chunks and shards."""
    system, place = _open(path)
    a = Array.of(path, json.loads(_bytes(system, f"{place}/zarr.json") or _bytes(system, f"{place}/.zarray")))
    written(tiles_of(spark, path), to, list(a.shape), chunks, np.dtype(a.dtype).newbyteorder("<").str, shard)
