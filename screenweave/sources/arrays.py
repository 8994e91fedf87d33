"""Spark data sources of array files: `npy` points, `zarr` and `zarr_tiles` planes, `zarr_columns` (versions 2 and 3).

The driver reads the arrays' metadata only and deals ranges of chunks; a task reads its own chunks, or of a sharded chunk
the parts that it needs, through the file system that the path names (local, HDFS, S3: what pyarrow opens), and gives
Arrow batches. Chunks that aren't there have the fill value. Compression: zlib, gzip, zstd, and blosc containers of lz4,
zlib and zstd with byte shuffle; stores with other codecs (blosc's bit shuffle, lz4 or bz2 by themselves) are refused.

Values keep their types: `zarr_tiles` gives an array's own type and bytes, `zarr_columns` integers as long. `zarr` is for image
kernels and gives float32; integers that float32 can't hold are an error there, not rounded.
"""

from __future__ import annotations

import fnmatch
import gzip
import itertools
import json
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition

#: Chunks that one task reads.
CHUNKS = 16
#: Rows of a batch.
ROWS = 100_000


def _open(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith(("/", "file:")) else fs.FileSystem.from_uri(f"/{path}")


def _files(path: str, pattern: str) -> list[str]:
    """Files below a path whose names match, sorted; the path itself if it is a file."""
    from pyarrow import fs

    system, at = _open(path)
    if system.get_file_info(at).type == fs.FileType.File:
        return [at]
    found = system.get_file_info(fs.FileSelector(at, recursive=True, allow_not_found=True))
    return sorted(f.path for f in found if f.type == fs.FileType.File and fnmatch.fnmatch(f.base_name, pattern))


def _bytes(system, path: str, begin: int = 0, size: int | None = None) -> bytes | None:
    """A file's bytes, or some of them (from the end, if begin is negative); None if there is no such file."""
    try:
        with system.open_input_file(path) as f:
            f.seek(begin if begin >= 0 else f.size() + begin)
            return f.read(size)
    except FileNotFoundError:
        return None


# Codecs


def _shuffled(data: bytes, width: int) -> bytes:
    """Undoes the byte shuffle; a rest shorter than an element stays as it is."""
    n = len(data) // width
    body = np.frombuffer(data, np.uint8, n * width).reshape(width, n).T.tobytes()
    return body + data[n * width :]


def _zstd(data: bytes, size: int | None = None) -> bytes:
    import zstandard

    return zstandard.ZstdDecompressor().decompressobj().decompress(data) if size is None else zstandard.ZstdDecompressor().decompress(data, max_output_size=size)


def _lz4(data: bytes, size: int) -> bytes:
    import pyarrow as pa

    return pa.Codec("lz4_raw").decompress(data, size, asbytes=True)


#: Compressors of a blosc container by the number in its flags, fixed values of the format.
_BLOSC = {1: _lz4, 3: lambda d, n: zlib.decompress(d), 4: _zstd}


def blosc(data: bytes) -> bytes:
    """The content of a blosc (version 1) container."""
    flags, width = data[2], data[3]
    total, block, _ = struct.unpack("<III", data[4:16])
    if flags & 2:  # stored as it is
        return data[16 : 16 + total]
    if flags & 4:
        raise ValueError("blosc bit shuffle isn't supported")
    number = flags >> 5
    if number not in _BLOSC:
        raise ValueError(f"blosc compressor {number} isn't supported")
    n = -(-total // block) if block else 0
    out = []
    for k, at in enumerate(struct.unpack(f"<{n}I", data[16 : 16 + 4 * n])):
        size = min(block, total - k * block)
        # whole blocks may be split into one stream for each byte of an element
        streams = width if not flags & 16 and size == block and width > 1 and size % width == 0 else 1
        parts = []
        for _ in range(streams):
            (length,) = struct.unpack("<I", data[at : at + 4])
            raw = data[at + 4 : at + 4 + length]
            parts.append(raw if length == size // streams else _BLOSC[number](raw, size // streams))
            at += 4 + length
        whole = b"".join(parts)
        out.append(_shuffled(whole, width) if flags & 1 and width > 1 else whole)
    return b"".join(out)


def _decoded(raw: bytes, codecs: list[dict]) -> bytes:
    """Undoes the byte codecs of a chunk, last first."""
    for c in reversed(codecs):
        kind = c["name"]
        if kind in ("zlib", "gzip"):
            raw = (zlib if kind == "zlib" else gzip).decompress(raw)
        elif kind == "zstd":
            raw = _zstd(raw)
        elif kind == "blosc":
            raw = blosc(raw)
        elif kind == "shuffle":
            raw = _shuffled(raw, c["configuration"]["elementsize"])
        elif kind == "crc32c":
            raw = raw[:-4]
        else:
            raise ValueError(f"codec {kind} isn't supported")
    return raw


@dataclass
class Array:
    """What is needed to read an array's chunks, from either version's metadata. `shard`: shape of the files' parts in chunks if the chunks lie in shards."""

    store: str
    shape: list[int]
    chunks: list[int]
    dtype: str
    fill: object
    order: list[int] | None
    codecs: list[dict]
    prefix: str
    separator: str
    shard: list[int] | None = None
    index_codecs: int = 0
    index_first: bool = False
    strings: bool = False

    @classmethod
    def of(cls, store: str, m: dict) -> Array:
        if m.get("zarr_format", 2) == 2:
            codecs = [{"name": f["id"], "configuration": f} for f in m.get("filters") or [] if f["id"] != "vlen-utf8"]
            codecs += [{"name": m["compressor"]["id"], "configuration": m["compressor"]}] if m.get("compressor") else []
            strings = any(f["id"] == "vlen-utf8" for f in m.get("filters") or [])
            order = list(range(len(m["shape"])))[::-1] if m.get("order") == "F" else None
            return cls(store, m["shape"], m["chunks"], m["dtype"], m.get("fill_value"), order, codecs, "", m.get("dimension_separator", "."), strings=strings)
        key = m.get("chunk_key_encoding", {"name": "default"})
        separator = (key.get("configuration") or {}).get("separator", "/" if key["name"] == "default" else ".")
        chunks, codecs, shard, index, first = m["chunk_grid"]["configuration"]["chunk_shape"], m.get("codecs", []), None, 0, False
        if codecs and codecs[0]["name"] == "sharding_indexed":
            c = codecs[0]["configuration"]
            shard, chunks, codecs = [a // b for a, b in zip(chunks, c["chunk_shape"])], c["chunk_shape"], c["codecs"]
            index, first = sum(x["name"] == "crc32c" for x in c.get("index_codecs", [])), c.get("index_location", "end") == "start"
        order, little, strings = None, True, False
        rest = []
        for c in codecs:
            if c["name"] == "transpose":
                order = c["configuration"]["order"]
            elif c["name"] == "bytes":
                little = (c.get("configuration") or {}).get("endian", "little") == "little"
            elif c["name"] == "vlen-utf8":
                strings = True
            else:
                rest.append(c)
        kind = "|O" if strings else np.dtype({"bool": "?"}.get(m["data_type"], m["data_type"])).newbyteorder("<" if little else ">").str
        prefix = "c" + separator if key["name"] == "default" else ""
        return cls(store, m["shape"], chunks, kind, m.get("fill_value"), order, rest, prefix, separator, shard, index, first, strings)

    def grid(self) -> list[int]:
        return [-(-n // c) for n, c in zip(self.shape, self.chunks)]

    def raw(self, at: list[int]) -> bytes | None:
        """The decoded bytes of a chunk; None if it isn't stored."""
        system, store = _open(self.store)
        name = lambda key: f"{store}/{self.prefix}{self.separator.join(map(str, key))}" if key else f"{store}/{self.prefix.rstrip(self.separator) or '0'}"
        if self.shard is None:
            data = _bytes(system, name(at))
        else:
            file, n = name([a // s for a, s in zip(at, self.shard)]), int(np.prod(self.shard))
            size = 16 * n + 4 * self.index_codecs
            index = _bytes(system, file, 0 if self.index_first else -size, size)
            if index is None:
                return None
            inner = int(np.ravel_multi_index([a % s for a, s in zip(at, self.shard)], self.shard))
            begin, length = struct.unpack("<QQ", index[16 * inner : 16 * inner + 16])
            data = None if begin == 2**64 - 1 else _bytes(system, file, begin, length)
        return None if data is None else _decoded(data, self.codecs)

    def chunk(self, at: list[int]) -> np.ndarray:
        """A chunk, cut to the array."""
        raw = self.raw(at)
        start = [a * c for a, c in zip(at, self.chunks)]
        cut = tuple(slice(0, n - s) for n, s in zip(self.shape, start))
        if raw is None:
            fill = "" if self.strings and self.fill is None else 0 if self.fill is None else self.fill
            return np.full(self.chunks, fill, dtype=object if self.strings else self.dtype)[cut]
        if self.strings:
            return np.array(_strings(raw), dtype=object).reshape(self.chunks)[cut]
        flat = np.frombuffer(raw, dtype=self.dtype)
        if self.order is None:
            return flat.reshape(self.chunks)[cut]
        return flat.reshape([self.chunks[k] for k in self.order]).transpose(np.argsort(self.order))[cut]


def _strings(raw: bytes) -> list[str]:
    (n,), at, out = struct.unpack("<I", raw[:4]), 4, []
    for _ in range(n):
        (size,) = struct.unpack("<I", raw[at : at + 4])
        out.append(raw[at + 4 : at + 4 + size].decode())
        at += 4 + size
    return out


def zarr_arrays(path: str, pattern: str = "*") -> list[Array]:
    """The arrays below a path whose place in it matches the pattern."""
    system, top = _open(path)
    out = []
    for file in [*_files(path, ".zarray"), *_files(path, "zarr.json")]:
        m = json.loads(_bytes(system, file))
        store = file.rsplit("/", 1)[0]
        if "shape" in m and fnmatch.fnmatch(store[len(top) :].strip("/"), pattern):
            scheme = path[: path.index("://") + 3] if "://" in path and not path.startswith("file:") else ""
            out.append(Array.of(f"{scheme}{store}" if scheme else store, m))
    return out


class Part(InputPartition):
    def __init__(self, value):
        super().__init__(value)
        self.value = value


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.options = options["path"], options


class NpyReader(_Reader):
    def partitions(self) -> list[InputPartition]:
        return [Part(f) for f in _files(self.path, "*.npy")]

    def read(self, partition: Part) -> Iterator[pa.RecordBatch]:
        import io

        system, _ = _open(self.path)
        name = partition.value.rsplit("/", 1)[-1].removesuffix(".npy")
        points = np.load(io.BytesIO(_bytes(system, partition.value))).astype(float).reshape(-1, 2)
        for k in range(0, len(points), ROWS):
            part = points[k : k + ROWS]
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(part)), pa.array(np.arange(k, k + len(part))), *(pa.array(np.ascontiguousarray(c)) for c in part.T)], names=["file", "spot_id", "y", "x"])


class NpySource(DataSource):
    """(file, spot_id, y, x) of arrays of shape (n, 2)."""

    @classmethod
    def name(cls) -> str:
        return "npy"

    def schema(self) -> str:
        return "file string, spot_id long, y double, x double"

    def reader(self, schema) -> DataSourceReader:
        return NpyReader(self.options)


class ZarrReader(_Reader):
    """Options: `arrays`, a pattern of places below the path; `window`, `y0,y1,x0,x1` in pixels; `index`, a JSON list of the wanted places of the leading axes (null: all)."""

    def partitions(self) -> list[InputPartition]:
        window = [int(x) for x in self.options["window"].split(",")] if self.options.get("window") else None
        wanted = json.loads(self.options.get("index") or "[]")
        out = []
        for a in zarr_arrays(self.path, self.options.get("arrays", "*")):
            if len(a.shape) < 2:
                continue
            spans = []
            for axis, (n, c) in enumerate(zip(a.grid(), a.chunks)):
                lead = axis - (len(a.shape) - 2)
                if lead >= 0 and window:
                    lo, hi = window[2 * lead], min(window[2 * lead + 1], a.shape[axis])
                    spans.append(range(lo // c, -(-hi // c)) if hi > lo else range(0))
                elif lead < 0 and axis < len(wanted) and wanted[axis] is not None:
                    spans.append(sorted({k // c for k in wanted[axis]}))
                else:
                    spans.append(range(n))
            total = int(np.prod([len(x) for x in spans]))
            out += [Part((a, spans, range(k, min(k + CHUNKS, total)), window, wanted)) for k in range(0, total, CHUNKS)]
        return out

    def planes(self, part: tuple) -> Iterator[tuple[str, list[int], int, int, np.ndarray]]:
        """(store, index, y0, x0, plane) of each plane of a task's chunks."""
        a, spans, group, window, wanted = part
        for k in group:
            at = [span[j] for span, j in zip(spans, np.unravel_index(k, [len(x) for x in spans]))]
            chunk = a.chunk(at)
            start = [k * c for k, c in zip(at, a.chunks)]
            y0, x0 = start[-2:]
            if window:
                ys = slice(max(window[0] - y0, 0), max(window[1] - y0, 0))
                xs = slice(max(window[2] - x0, 0), max(window[3] - x0, 0))
                chunk, y0, x0 = chunk[..., ys, xs], y0 + ys.start, x0 + xs.start
            for lead in np.ndindex(*chunk.shape[:-2]):
                index = [int(s + k) for s, k in zip(start[:-2], lead)]
                if any(axis < len(wanted) and wanted[axis] is not None and k not in wanted[axis] for axis, k in enumerate(index)):
                    continue
                if chunk[lead].size:
                    yield a.store, index, y0, x0, chunk[lead]

    def read(self, partition: Part) -> Iterator[pa.RecordBatch]:
        for store, index, y0, x0, plane in self.planes(partition.value):
            yield pa.RecordBatch.from_pylist([{"store": store, "index": index, "y0": y0, "x0": x0, "h": plane.shape[0], "w": plane.shape[1], "pixels": floats(plane).tobytes()}], _PLANES)


class TilesReader(ZarrReader):
    def read(self, partition: Part) -> Iterator[pa.RecordBatch]:
        for store, index, y0, x0, plane in self.planes(partition.value):
            plane = np.ascontiguousarray(plane, dtype=plane.dtype.newbyteorder("<"))
            yield pa.RecordBatch.from_pylist([{"store": store, "index": index, "y0": y0, "x0": x0, "h": plane.shape[0], "w": plane.shape[1], "dtype": plane.dtype.str, "data": plane.tobytes()}], _TILES)


_PLANES = pa.schema([("store", pa.string()), ("index", pa.list_(pa.int32())), ("y0", pa.int32()), ("x0", pa.int32()), ("h", pa.int32()), ("w", pa.int32()), ("pixels", pa.binary())])
_TILES = pa.schema([("store", pa.string()), ("index", pa.list_(pa.int32())), ("y0", pa.int64()), ("x0", pa.int64()), ("h", pa.int32()), ("w", pa.int32()), ("dtype", pa.string()), ("data", pa.binary())])


def floats(plane: np.ndarray) -> np.ndarray:
    """The plane as float32; integers that float32 can't hold are an error."""
    out = np.ascontiguousarray(plane, dtype=np.float32)
    if plane.dtype.kind in "iu" and plane.dtype.itemsize > 2 and plane.size and (int(plane.max()) > 1 << 24 or int(plane.min()) < -(1 << 24)):
        raise ValueError("integers beyond 2^24 don't fit float32: read them as zarr_tiles")
    return out


class ZarrSource(DataSource):
    """Planes of chunks as tiles: (store, index: the leading axes, y0, x0, h, w, pixels)."""

    @classmethod
    def name(cls) -> str:
        return "zarr"

    def schema(self) -> str:
        return "store string, index array<int>, y0 int, x0 int, h int, w int, pixels binary"

    def reader(self, schema) -> DataSourceReader:
        return ZarrReader(self.options)


class TilesSource(DataSource):
    """Planes of chunks in their own type, as `operators.rasters` has tiles: (store, index: the leading axes, y0, x0, h, w, dtype, data). Also a sink, see `sources.zarr_sink`."""

    @classmethod
    def name(cls) -> str:
        return "zarr_tiles"

    def schema(self) -> str:
        return "store string, index array<int>, y0 long, x0 long, h int, w int, dtype string, data binary"

    def reader(self, schema) -> DataSourceReader:
        return TilesReader(self.options)

    def writer(self, schema, overwrite: bool) -> DataSourceWriter:
        from screenweave.sources.zarr_sink import ShardWriter

        return ShardWriter(self.options, overwrite)


class ColumnsReader(_Reader):
    def partitions(self) -> list[InputPartition]:
        names = (self.options.get("arrays") or "*").split(",")
        _, top = _open(self.path)
        out = []
        for name in names:
            for a in zarr_arrays(self.path, name):
                place = _open(a.store)[1][len(top) :].strip("/")
                out += [Part((a, place, list(group))) for group in itertools.batched(range(a.grid()[0]), CHUNKS)]
        return out

    def read(self, partition: Part) -> Iterator[pa.RecordBatch]:
        a, place, group = partition.value
        rest = a.grid()[1:]
        for at in group:
            for tail in np.ndindex(*rest):
                chunk = a.chunk([at, *tail])
                begin = [k * c for k, c in zip([at, *tail], a.chunks)]
                where = [w.ravel() + b for w, b in zip(np.indices(chunk.shape), begin)]
                flat, n = chunk.ravel(), chunk.size
                for k in range(0, n, ROWS):
                    part = flat[k : k + ROWS]
                    index = np.stack([w[k : k + ROWS] for w in where[1:]], axis=1).astype(np.int32) if len(where) > 1 else np.zeros((len(part), 0), np.int32)
                    index = pa.ListArray.from_arrays(np.arange(len(part) + 1, dtype=np.int32) * index.shape[1], index.ravel())
                    none = lambda t: pa.nulls(len(part), t)  # noqa: B023, E731
                    whole = not a.strings and part.dtype.kind in "iub"
                    number = pa.array(part.astype(np.int64)) if whole and not (part.dtype == np.dtype("u8") and part.max(initial=0) >= 1 << 63) else none(pa.int64())
                    value = none(pa.float64()) if a.strings else pa.array(part.astype(float))
                    text = pa.array([str(v) for v in part], pa.string()) if a.strings else none(pa.string())
                    yield pa.RecordBatch.from_arrays([pa.array([place] * len(part)), pa.array(where[0][k : k + ROWS].astype(np.int64)), index, value, number, text], names=["array", "row", "index", "value", "number", "text"])


class ColumnsSource(DataSource):
    """Arrays by their first axis: (array: the place below the path, row, index: the other axes, value, number, text). Integers have a number, exactly, besides the value. For tables that are stored as one array for each column."""

    @classmethod
    def name(cls) -> str:
        return "zarr_columns"

    def schema(self) -> str:
        return "array string, row long, index array<int>, value double, number long, text string"

    def reader(self, schema) -> DataSourceReader:
        return ColumnsReader(self.options)


def register(spark: SparkSession) -> None:
    for source in (NpySource, ZarrSource, TilesSource, ColumnsSource):
        spark.dataSource.register(source)


# Tables that are stored as arrays


def _wide(rows: DataFrame, names: dict[str, str], keys: list[str] = ["row"]) -> DataFrame:  # noqa: B006
    """A column for each array of `names` (place: column), one row for each row of the arrays."""
    of = lambda place: F.max(F.when(F.col("array") == place, F.col("value")))
    return rows.groupBy(*keys).agg(*[of(p).alias(c) for p, c in names.items()])


def track_graph(spark: SparkSession, path: str, props: list[str]) -> tuple[DataFrame, DataFrame]:
    """Nodes (id and the wanted properties) and edges (src, dst) of a track graph in a zarr group: nodes/ids, nodes/props/<name>/values, edges/ids."""
    read = lambda arrays: spark.read.format("zarr_columns").option("arrays", arrays).load(path)
    places = {"nodes/ids": "id"} | {f"nodes/props/{p}/values": p for p in props}
    rows = read(",".join(places))
    ids = rows.where("array = 'nodes/ids'").select("row", F.col("number").alias("id"))
    nodes = ids.join(_wide(rows, {p: c for p, c in places.items() if c != "id"}), "row", "left").drop("row") if props else ids.drop("row")
    pair = read("edges/ids").groupBy("row").agg(*[F.max(F.when(F.col("index")[0] == k, F.col("number"))).alias(n) for k, n in enumerate(("src", "dst"))])
    return nodes, pair.drop("row")


def observations(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """(row, columns) of an annotated matrix's `obs` group in a zarr store: plain columns as numbers or texts, categorical ones (codes and categories) as texts. The matrix isn't read."""
    arrays_ = ",".join(f"obs/{c}{suffix}" for c in columns for suffix in ("", "/codes", "/categories"))
    rows = spark.read.format("zarr_columns").option("arrays", arrays_).load(path)
    out = rows.where(~F.col("array").endswith("/categories")).select("row").distinct()
    shown = F.coalesce("text", F.col("number").cast("string"), F.when(F.col("value") == F.floor("value"), F.col("value").cast("long").cast("string")).otherwise(F.col("value").cast("string")))
    for c in columns:
        plain = rows.where(F.col("array") == f"obs/{c}").select("row", shown.alias(c))
        codes = rows.where(F.col("array") == f"obs/{c}/codes").select("row", F.col("number").alias("_code"))
        names = rows.where(F.col("array") == f"obs/{c}/categories").select(F.col("row").alias("_code"), shown.alias(c))
        out = out.join(plain.unionByName(codes.join(names, "_code", "left").select("row", c)), "row", "left")
    return out
