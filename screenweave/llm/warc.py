"""WARC archives: writing records, reading them back, and assembling transactions.

`write` turns each row (id, url, payload) into a request, a response or revisit, and a metadata record. Of the rows with
equal payloads of MIN_REVISIT bytes or more, the one with the smallest id is the response; the others are revisits that
refer to it and don't hold the payload. Request and metadata records name their response or revisit by
WARC-Concurrent-To. Archives are text files of Spark's writer, one gzip stream each, with a bounded number of records.

Which payloads repeat is found from ids and digests alone. Up to SENT repeated digests are sent to all tasks, and no
payload moves. Beyond, a table of BITS bits, whose size is fixed, tells the rows that may repeat; only those meet by
digest, and all others are written where they were read.

`read` streams archive files of any size, record by record: Spark's text reader decompresses (several gzip members in
one file too) and cuts at the words that begin a record; where a block holds these words itself, the pieces are put
together again by its content length. `assemble` groups the records by the identifier that they are concurrent to and
gives one nested row for each capture. No record is lost: captures without an identifier have a row each, of captures with
the same one each has a row with a `repeat` number, and more than ATTACHED requests or metadata records of a capture go on
in rows of higher numbers, so rows are bounded. One identifier's records meet in one task, which sorts them on disk.

Defined results: a null payload is empty; a null id is written and read as null, and sorts last among equal payloads;
of rows with equal id and payload one is the response. A null url is written as `about:blank` and read as null; line
ends in urls are percent-encoded. Requests or metadata whose capture is missing form a row with null response. No rows
give no captures. Records of other kinds (warcinfo) belong to no capture. Damage doesn't raise: a record without a valid
content length has null block_bytes and no payload, and the next one is read; a block that is shorter than its content
length (a cut archive) has digest_ok false and what is there as payload; a response without an empty line after its HTTP
header has null payload and digest_ok false; numbers that don't parse are null. A broken or cut gzip stream ends its file's
records; such a file, and any that doesn't end with a whole record and its line ends, is incomplete: `files` says so for each
file, and `read(truncated=True)` gives it one more row, of kind `truncated`. A file without a first record has no row.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from screenweave.llm.common import BATCH_BYTES, bounded, shared_dir, table, tidy, written

MIN_REVISIT = 100
#: Captures in one archive file, three records each.
CAPTURES = 400
#: Requests, and metadata records, in one row of a capture.
ATTACHED = 1000
#: Bits of the table that tells which digests may repeat: at most BITS / 64 rows, some 40 MB as a hash table.
BITS = 1 << 25
#: Repeated digests up to this number (some 100 bytes each) are broadcast.
SENT = 200_000
_END = "\r\n\r\n"
_CUT = b"\r\n\r\n"
#: What ends a record and begins the next one.
_SEPARATOR = b"\r\n\r\nWARC/1."
_DATE = "2024-01-01T00:00:00Z"
_NO_URL = "about:blank"
RECORD = "record_id string, kind string, concurrent_to string, date string, url string, page_id long, refers_to string, refers_to_page long, content_type string, block_bytes long, payload_bytes long, payload_digest string, digest_ok boolean, payload binary"


def _urn(kind: str, page: Column, row: Column) -> Column:
    h = F.md5(F.concat_ws("|", F.lit(kind), F.coalesce(page.cast("string"), F.lit("")), row.cast("string")))
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *[F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]), F.lit(">"))


def _record(headers: list[tuple[str, Column]], block: Column) -> Column:
    """A record without the two line ends that follow it. Headers with a null value are left out."""
    lines = [F.concat(F.lit(f"{k}: "), v) for k, v in [*headers, ("Content-Length", F.octet_length(block).cast("string"))]]
    return F.concat(F.concat_ws("\r\n", F.lit("WARC/1.1"), *lines), F.lit(_END), block)


def _repeats(rows: DataFrame) -> DataFrame:
    """(digest, first): the digests of MIN_REVISIT bytes or more that several rows have, and the row that is the response."""
    last = F.lit(2**63 - 1)
    long = rows.where(F.col("n") >= MIN_REVISIT).select("page_id", "row", "digest")
    return long.groupBy("digest").agg(F.min(F.struct(F.coalesce("page_id", last).alias("order"), "row", "page_id")).alias("first"), F.count("*").alias("of")).where("of > 1").drop("of")


def _met(rows: DataFrame, firsts: DataFrame) -> DataFrame:
    """The rows with `first`, of which only those meet by digest that the bit table doesn't rule out."""
    h = F.xxhash64("digest")
    word, bit = F.pmod(h, F.lit(BITS // 64)), F.shiftrightunsigned(h, 58).cast("int")
    # at most BITS / 64 rows: broadcast whatever the input
    bits = firsts.groupBy(word.alias("word")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), bit)).alias("bits"))
    told = rows.withColumns({"word": word, "bit": bit}).join(F.broadcast(bits), "word", "left")
    may = (F.col("n") >= MIN_REVISIT) & F.coalesce(F.call_function("shiftright", F.col("bits"), F.col("bit")).bitwiseAND(F.lit(1)) == 1, F.lit(False))
    told = told.withColumn("may", may).drop("word", "bit", "bits")
    never = told.where("not may").withColumn("first", F.lit(None).cast(firsts.schema["first"].dataType))
    return never.unionByName(told.where("may").join(firsts, "digest", "left")).drop("may")


def records(pages: DataFrame, key: str = "page_id", url: str = "url", payload: str = "html") -> DataFrame:
    """A row for each page: page_id, and the texts of its three records."""
    rows = pages.select(F.col(key).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), F.coalesce(F.col(payload).cast("string"), F.lit("")).alias("payload"), F.monotonically_increasing_id().alias("row"))
    rows = rows.withColumns({"digest": F.sha2("payload", 256), "n": F.octet_length("payload")})
    firsts = written(_repeats(rows), "repeats")
    if firsts.count() <= SENT:
        rows = rows.join(F.broadcast(firsts), "digest", "left")
    else:
        rows = _met(rows, firsts)
    again = F.col("first").isNotNull() & (F.col("first.row") != F.col("row"))
    at = F.regexp_replace(F.regexp_replace(F.coalesce("url", F.lit(_NO_URL)), "\r", "%0D"), "\n", "%0A")
    own = _urn("capture", F.col("page_id"), F.col("row"))
    page = F.col("page_id").cast("string")
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("n").cast("string"), F.lit(_END))
    shared = [("WARC-Date", F.lit(_DATE)), ("WARC-Target-URI", at), ("WARC-Page-ID", page)]
    capture = _record(
        [("WARC-Type", F.when(again, "revisit").otherwise("response")), ("WARC-Record-ID", own), *shared, ("WARC-Payload-Digest", F.concat(F.lit("sha256:"), "digest")),
         ("WARC-Profile", F.when(again, "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")), ("WARC-Refers-To", F.when(again, _urn("capture", F.col("first.page_id"), F.col("first.row")))),
         ("WARC-Refers-To-Page-ID", F.when(again, F.col("first.page_id").cast("string"))), ("Content-Type", F.lit("application/http;msgtype=response"))],
        F.when(again, http).otherwise(F.concat(http, "payload")),
    )
    request = _record([("WARC-Type", F.lit("request")), ("WARC-Record-ID", _urn("request", F.col("page_id"), F.col("row"))), ("WARC-Concurrent-To", own), *shared, ("Content-Type", F.lit("application/http;msgtype=request"))], F.concat(F.lit("GET "), at, F.lit(f" HTTP/1.1{_END}")))
    metadata = _record([("WARC-Type", F.lit("metadata")), ("WARC-Record-ID", _urn("metadata", F.col("page_id"), F.col("row"))), ("WARC-Concurrent-To", own), *shared, ("Content-Type", F.lit("application/warc-fields"))], F.concat(F.lit("fetchTimeMs: "), (F.col("n") % 997).cast("string"), F.lit("\r\n")))
    return rows.select("page_id", F.array(request, capture, metadata).alias("records"))


def write(pages: DataFrame, path: str, **columns: str) -> None:
    """Writes the archives of `pages` into the folder `path`."""
    lines = records(pages, **columns).select(F.explode("records").alias("value"))
    lines.write.option("lineSep", _END).option("compression", "gzip").option("maxRecordsPerFile", 3 * CAPTURES).text(path)


def _fields(head: bytes) -> tuple[str, dict[str, str]]:
    first, *lines = head.decode("utf-8", "replace").split("\r\n")
    return first, {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}


def _number(text: str | None) -> int | None:
    """A whole number of up to 18 digits, or null."""
    return int(text) if text is not None and re.fullmatch(r"-?[0-9]{1,18}", text) else None


def record(data: bytes, payloads: bool = True) -> tuple:
    """One record, from `WARC/1.` to the end of its block, as RECORD has it."""
    head, _, block = data.partition(_CUT)
    _, f = _fields(head)
    size = _number(f.get("content-length"))
    url, kind = f.get("warc-target-uri"), f.get("warc-type")
    body, n, digest, ok, length = None, None, f.get("warc-payload-digest", "").rpartition(":")[2] or None, None, None
    if size is not None and size >= 0:
        whole, block = len(block) >= size, block[:size]
        length = len(block)
        if kind in ("response", "revisit") and f.get("content-type", "").startswith("application/http"):
            http, empty, content = block.partition(_CUT)
            if kind == "revisit":
                n = _number(_fields(http)[1].get("content-length"))
            elif empty:
                body, n = content, len(content)
                found = hashlib.sha256(body).hexdigest()
                ok = whole and digest in (None, found)
                digest = found
            else:
                ok = False
    return (f.get("warc-record-id"), kind, f.get("warc-concurrent-to"), f.get("warc-date"), None if url == _NO_URL else url, _number(f.get("warc-page-id")), f.get("warc-refers-to"), _number(f.get("warc-refers-to-page-id")), f.get("content-type"), length, n, digest, ok, body if payloads else None)


def _begun(piece: bytes) -> tuple[bytes, int] | None:
    """A piece that begins a record, and how many bytes its block still lacks (negative: how many follow the block)."""
    data = piece if piece.startswith(b"WARC/1.") else b"WARC/1." + piece
    head, cut, block = data.partition(_CUT)
    if not cut or b"\r\n" not in head:
        return None  # before the first record, or no record at all
    return data, (_number(_fields(head)[1].get("content-length")) or 0) - len(block)


def whole_by_file(pieces: Iterator[tuple[str | None, bytes]], broken: list[str | None]) -> Iterator[tuple[str | None, bytes]]:
    """Each file's records from the pieces (file, bytes between two separators) of archive files, in their order.

    A separator within a block belongs to the block: pieces are added until the content length is reached. One that the
    reader has overlooked is found behind the block. Files that don't end with a whole record and line ends are added to `broken`.
    """
    now, parts, missing, last, begun_any = None, [], 0, b"", False

    def closed() -> Iterator[tuple[str | None, bytes]]:
        nonlocal parts, missing, last
        while parts and missing <= 0:
            data = b"".join(parts)
            yield now, data[: len(data) + missing]
            last, found, rest = data[len(data) + missing :].partition(_SEPARATOR)
            begun = _begun(rest) if found else None
            parts, missing = ([begun[0]], begun[1]) if begun else ([], 0)

    def ended() -> None:
        if begun_any and (parts or not last or last.strip(b"\r\n")):
            broken.append(now)

    for file, piece in pieces:
        if parts and file == now:
            parts += [_SEPARATOR, piece]
            missing -= len(_SEPARATOR) + len(piece)
        else:
            if file != now:
                ended()
                last, begun_any = b"", False
            if parts:  # the file ended within the block
                yield now, b"".join(parts)
            now, begun = file, _begun(piece)
            parts, missing = ([begun[0]], begun[1]) if begun else ([], 0)
            begun_any |= bool(begun)
        yield from closed()
    ended()
    if parts:
        yield now, b"".join(parts)


def whole(pieces: Iterator[tuple[str | None, bytes]]) -> Iterator[bytes]:
    """The records alone."""
    return (data for _, data in whole_by_file(pieces, []))


def read(spark: SparkSession, path: str, payloads: bool = True, truncated: bool = False) -> DataFrame:
    """A row for each record of the archives in a folder. Uncompressed archives of more than one split should be compressed first: only a gzip file is read by one task from its beginning.

    `truncated`: with the record's `file`, and a row of kind `truncated` for each incomplete file.
    """
    bounded(spark)
    schema = f"{RECORD}, file string" if truncated else RECORD
    names = [x.split()[0] for x in schema.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pieces = ((f, bytes(v)) for b in batches for f, v in zip(b["file"], b["value"]))
        rows, size, broken = [], 0, []
        for file, data in whole_by_file(pieces, broken):
            rows.append((*record(data, payloads), file) if truncated else record(data, payloads))
            size += len(data) if payloads else 500
            if size > BATCH_BYTES:
                yield _frame(rows, names)
                rows, size = [], 0
        if truncated:
            rows += [(None, "truncated", *[None] * (len(names) - 3), file) for file in broken]
        yield _frame(rows, names)
        tidy()

    lines = spark.read.option("lineSep", _SEPARATOR.decode()).option("ignoreCorruptFiles", True).text(path)
    return lines.select(F.col("_metadata.file_path").alias("file"), F.col("value").cast("binary").alias("value")).mapInPandas(run, schema)


def files(spark: SparkSession, path: str) -> DataFrame:
    """(file, records, complete) of the archives in a folder: whether each ends with a whole record."""
    cut = F.col("kind") == "truncated"
    return read(spark, path, payloads=False, truncated=True).groupBy("file").agg(F.count_if(~F.coalesce(cut, F.lit(False))).alias("records"), (F.count_if(cut) == 0).alias("complete"))


def _frame(rows: list[tuple], names: list[str]) -> pd.DataFrame:
    out = pd.DataFrame(rows, columns=names, dtype=object)
    return out.astype({c: "Int64" for c in ("page_id", "refers_to_page", "block_bytes", "payload_bytes")} | {"digest_ok": "boolean"})


def assemble(found: DataFrame) -> DataFrame:
    """Nested rows of captures: capture_id, repeat (0 for an identifier's first), capture (the response or revisit), requests, metadata."""
    kinds = {"request": "request", "metadata": "metadata"} | dict.fromkeys(("response", "revisit", "resource", "conversion"), "capture")
    part = F.create_map(*[F.lit(x) for kv in kinds.items() for x in kv])[F.col("kind")]
    known = F.coalesce("concurrent_to", "record_id")
    rows = found.where(F.col("kind").isin(*kinds)).select(
        known.alias("capture_id"), F.when(known.isNull(), F.monotonically_increasing_id()).alias("_own"), part.alias("_part"), F.struct(*[c for c in found.columns if c != "concurrent_to"]).alias("_record"),
    )
    key = F.coalesce(F.col("capture_id"), F.col("_own").cast("string"))
    order = Window.partitionBy(key, F.col("capture_id").isNull(), "_part").orderBy("_record.page_id", "_record.record_id", "_record.url", "_record.payload_digest", "_record.block_bytes")
    place = F.row_number().over(order) - 1
    numbered = rows.withColumn("repeat", F.when(F.col("_part") == "capture", place).otherwise(F.floor(place / ATTACHED)).cast("int"))
    of = lambda part: F.when(F.col("_part") == part, F.col("_record"))
    return numbered.groupBy(key.alias("_key"), F.col("capture_id").isNull().alias("_none"), "repeat").agg(
        F.any_value("capture_id").alias("capture_id"), F.any_value(of("capture"), ignoreNulls=True).alias("capture"),
        F.sort_array(F.collect_list(of("request"))).alias("requests"), F.sort_array(F.collect_list(of("metadata"))).alias("metadata"),
    ).drop("_key", "_none")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{shared_dir(spark)}/warc-{uuid.uuid4().hex}"
    write(table(spark, sf_dir, "pages"), path)
    captures = assemble(read(spark, path, payloads=False))
    c = F.col("capture")
    return captures.select(
        c.page_id.alias("page_id"), c.payload_bytes.alias("payload_bytes"), c.payload_digest.alias("payload_digest"), c.kind.alias("record_type"), c.refers_to_page.alias("refers_to"),
        c.url.alias("url"), c.digest_ok.alias("digest_ok"), F.size("requests").alias("n_requests"), F.size("metadata").alias("n_metadata"),
    )


ORACLE = f"""
WITH p AS (SELECT page_id, url, coalesce(html, '') AS h FROM pages),
d AS (SELECT *, octet_length(encode(h)) AS n, sha256(h) AS digest FROM p),
f AS (SELECT *, min(page_id) OVER (PARTITION BY digest) AS first FROM d)
SELECT page_id, n AS payload_bytes, digest AS payload_digest,
  CASE WHEN n >= {MIN_REVISIT} AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN n >= {MIN_REVISIT} AND page_id <> first THEN first END AS refers_to,
  url, CASE WHEN n >= {MIN_REVISIT} AND page_id <> first THEN NULL ELSE true END AS digest_ok, 1 AS n_requests, 1 AS n_metadata
FROM f"""
