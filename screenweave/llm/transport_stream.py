"""Media columns: payloads in MPEG transport streams.

`mux` stores a payload as one programme with one private data stream: a PAT and a PMT before each random-access point,
then PES packets of `unit` bytes with a 90 kHz presentation time, cut into packets of 188 bytes with continuity
counters; the first packet of a random-access unit carries the indicator and a clock reference. `demux` reads such bytes
back: it finds the stream through PAT and PMT (with their CRCs checked), checks continuity counters, reassembles the
PES packets and lists presentation times and random-access points.

Defined results: null and empty payloads are stored as one block of padding. Equal payloads give equal streams. Damaged
streams don't raise: lost sync, broken CRCs, gaps and broken headers are counted, and what can be read is returned. A
packet that repeats the one before with the same counter is a duplicate, which the standard allows: it is counted and
passed over. A jump of the counter that a discontinuity indicator announces is no gap. A PES packet with a gap in it is
left out; headers and tables may cross packets. Bytes after the last whole packet are not read.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from screenweave.llm.common import chunks, table, written

# Fixed values of ISO/IEC 13818-1.
SIZE, SYNC, PAT_PID, NULL_PID = 188, 0x47, 0, 0x1FFF
PRIVATE_DATA, PRIVATE_STREAM_1 = 0x06, 0xBD
CRC_POLYNOMIAL = 0x04C11DB7

PMT_PID, ES_PID, PROGRAM = 0x1000, 0x0100, 1
TICKS = 3600  # between units: 1/25 s


def _crc_table() -> list[int]:
    out = []
    for i in range(256):
        c = i << 24
        for _ in range(8):
            c = (c << 1) ^ CRC_POLYNOMIAL if c & 0x80000000 else c << 1
        out.append(c & 0xFFFFFFFF)
    return out


_CRC = _crc_table()


def crc32_mpeg(data: bytes) -> int:
    c = 0xFFFFFFFF
    for b in data:
        c = (c << 8 & 0xFFFFFFFF) ^ _CRC[c >> 24 ^ b]
    return c


def _section(table_id: int, number: int, body: bytes) -> bytes:
    head = bytes([table_id]) + (0xB000 | len(body) + 9).to_bytes(2, "big") + number.to_bytes(2, "big") + b"\xc1\x00\x00"
    return head + body + crc32_mpeg(head + body).to_bytes(4, "big")


_PAT = (b"\x00" + _section(0, 1, PROGRAM.to_bytes(2, "big") + (0xE000 | PMT_PID).to_bytes(2, "big"))).ljust(184, b"\xff")
_PMT = (b"\x00" + _section(2, PROGRAM, (0xE000 | ES_PID).to_bytes(2, "big") + b"\xf0\x00" + bytes([PRIVATE_DATA]) + (0xE000 | ES_PID).to_bytes(2, "big") + b"\xf0\x00")).ljust(184, b"\xff")


def _time(value: int, mark: int = 2) -> bytes:
    return bytes([mark << 4 | value >> 29 & 14 | 1]) + (value >> 14 & 0xFFFE | 1).to_bytes(2, "big") + ((value << 1 & 0xFFFE) | 1).to_bytes(2, "big")


def _when(b: bytes) -> int:
    return (b[0] >> 1 & 7) << 30 | (int.from_bytes(b[1:3], "big") >> 1) << 15 | int.from_bytes(b[3:5], "big") >> 1


def _clock(value: int) -> bytes:
    return (value << 15 | 0x7E00).to_bytes(6, "big")


def _head(pid: int, start: bool, control: int, counter: int) -> bytes:
    return bytes([SYNC]) + (start << 14 | pid).to_bytes(2, "big") + bytes([control << 4 | counter & 15])


#: Headers of packets inside a PES packet, by counter.
_INNER = [_head(ES_PID, False, 1, k) for k in range(16)]


def padded(payload: bytes | None, block: int = 64) -> bytes:
    payload = payload or b""
    return payload.ljust(max(1, -(-len(payload) // block)) * block, b"\0")


def mux(payload: bytes, unit: int = 4096, every: int = 8) -> bytes:
    """The payload's bytes as a transport stream; every `every`-th unit is a random-access point."""
    out, tables, counter = [], 0, 0
    for k, at in enumerate(range(0, max(1, len(payload)), unit)):
        data, pts, access = payload[at : at + unit], k * TICKS, k % every == 0
        pes = b"\0\0\1" + bytes([PRIVATE_STREAM_1]) + (len(data) + 8).to_bytes(2, "big") + b"\x84\x80\x05" + _time(pts) + data
        if access:
            out += [_head(PAT_PID, True, 1, tables), _PAT, _head(PMT_PID, True, 1, tables), _PMT]
            tables += 1
        adaptation = (b"\x50" + _clock(pts)) if access else b""
        room = 184 - (len(adaptation) + 1 if access else 0)
        first = pes[:room]
        if len(first) < room:
            adaptation = (adaptation or b"\0" * (room - len(first) > 1)).ljust(room - len(first) + len(adaptation) - (0 if access else 1), b"\xff")
            field_ = bytes([len(adaptation)]) + adaptation
        else:
            field_ = bytes([len(adaptation)]) + adaptation if access else b""
        out += [_head(ES_PID, True, 3 if field_ else 1, counter), field_, first]
        counter += 1
        end = room + (len(pes) - room) // 184 * 184 if len(pes) > room else len(pes)
        for i in range(room, end, 184):
            out += [_INNER[counter & 15], pes[i : i + 184]]
            counter += 1
        if end < len(pes):
            rest = pes[end:]
            gap = 183 - len(rest)
            out += [_head(ES_PID, False, 3, counter), bytes([gap]) + (b"\0".ljust(gap, b"\xff") if gap else b""), rest]
            counter += 1
    return b"".join(out)


@dataclass
class Stream:
    payload: bytes = b""
    times: list[int] = field(default_factory=list)
    #: (presentation time, byte offset of the packet) of each random-access point
    access: list[tuple[int, int]] = field(default_factory=list)
    packets: int = 0
    sync_errors: int = 0
    crc_errors: int = 0
    gaps: int = 0
    header_errors: int = 0
    repeated: int = 0

    def feature(self) -> str:
        points = hashlib.md5(repr(self.access).encode()).hexdigest()[:8]
        return f"units={len(self.times)};last={self.times[-1] if self.times else -1};access={len(self.access)};points={points};packets={self.packets};gaps={self.gaps};sync={self.sync_errors};crc={self.crc_errors}"


class Sections:
    """Collects the PSI sections of one table from packet payloads: a section may cross packets, and a packet may hold several."""

    def __init__(self, table_id: int):
        self.table_id, self.data, self.seen, self.errors = table_id, b"", b"", 0

    def add(self, body: bytes, start: bool, lost: bool) -> list[bytes]:
        """The entries of the sections that end in this payload."""
        if lost:
            self.data = b""
        if start:
            if body == self.seen:  # the same table once more
                return []
            rest, errors, alone = 1 + body[0], self.errors, not self.data
            # what is before the pointer ends a section, what is after begins the next
            out = self._whole(self.data + body[1:rest]) if self.data else []
            self.data = body[rest:]
            out += self._whole(self.data)
            self.seen = body if alone and self.errors == errors else b""
            return out
        if self.data:
            self.seen = b""
            return self._whole(self.data + body)
        return []

    def _whole(self, data: bytes) -> list[bytes]:
        out = []
        while len(data) >= 3 and data[0] != 0xFF:
            size = 3 + (int.from_bytes(data[1:3], "big") & 0xFFF)
            if len(data) < size:
                self.data = data
                return out
            section, data = data[:size], data[size:]
            if size < 12 or section[0] != self.table_id or crc32_mpeg(section):
                self.errors += 1
            else:
                out.append(section[8:-4])
        self.data = data if data and data[0] != 0xFF else b""
        return out


def _programme(entries: bytes) -> int:
    """The PID of the first programme's table in a PAT, -1 if there is none."""
    for i in range(0, len(entries) - 3, 4):
        if int.from_bytes(entries[i : i + 2], "big"):
            return int.from_bytes(entries[i + 2 : i + 4], "big") & 0x1FFF
    return -1


def _private(entries: bytes) -> int:
    """The PID of the first private data stream in a PMT, -1 if there is none."""
    i = 4 + (int.from_bytes(entries[2:4], "big") & 0xFFF)
    while i + 5 <= len(entries):
        if entries[i] == PRIVATE_DATA:
            return int.from_bytes(entries[i + 1 : i + 3], "big") & 0x1FFF
        i += 5 + (int.from_bytes(entries[i + 3 : i + 5], "big") & 0xFFF)
    return -1


def demux(media: bytes) -> Stream:
    out = Stream()
    pmt_pid = es_pid = -1
    last: dict[int, tuple[int, int, int]] = {}  # by PID: counter, and where its packet's content begins and ends
    pat, pmt = Sections(0), Sections(2)
    unit: list[bytes] = []
    parts: list[bytes] = []
    began, access = 0, False

    def close() -> None:
        if not unit:
            return
        pes = b"".join(unit)
        unit.clear()
        begin = 9 + pes[8] if len(pes) > 8 else 0
        if pes[:4] != b"\0\0\1\xbd" or not begin or len(pes) < begin:
            out.header_errors += 1
            return
        if pes[7] & 128 and begin >= 14:
            pts = _when(pes[9:14])
            out.times.append(pts)
            if access:
                out.access.append((pts, began))
        size = int.from_bytes(pes[4:6], "big")
        if size and len(pes) < 6 + size:
            out.header_errors += 1
        parts.append(pes[begin : 6 + size if size else len(pes)])

    for at in range(0, len(media) - SIZE + 1, SIZE):
        out.packets += 1
        if media[at] != SYNC:
            out.sync_errors += 1
            continue
        pid, flags, start = (media[at + 1] & 31) << 8 | media[at + 2], media[at + 3], bool(media[at + 1] & 64)
        if pid == NULL_PID:
            continue
        begin, random, lost = at + 4, False, False
        if flags & 32:
            size = media[begin]
            if size > 183:
                out.header_errors += 1
                continue
            marks = media[begin + 1] if size else 0
            random = bool(marks & 64)
            if marks & 128:  # discontinuity indicator
                last.pop(pid, None)
            begin += 1 + size
        if not flags & 16:
            continue
        before = last.get(pid)
        if before is not None and before[0] != (flags - 1) & 15:
            if before[0] == flags & 15 and media[begin : at + SIZE] == media[before[1] : before[2]]:
                out.repeated += 1
                continue
            out.gaps += 1
            lost = True
            if pid == es_pid:
                unit.clear()
        last[pid] = flags & 15, begin, at + SIZE
        if begin >= at + SIZE:
            continue
        body = media[begin : at + SIZE]
        if pid == es_pid:
            if start:
                close()
                began, access = at, random
                unit.append(body)
            elif unit:
                unit.append(body)
        elif pid == PAT_PID:
            for entries in pat.add(body, start, lost):
                pmt_pid = _programme(entries)
        elif pid == pmt_pid:
            for entries in pmt.add(body, start, lost):
                es_pid = _private(entries)
    close()
    out.crc_errors = pat.errors + pmt.errors
    out.payload = b"".join(parts)
    return out


def encoded(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(doc_id, n_bytes, media): each text's UTF-8 bytes, padded, as a transport stream."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            texts = b["text"].tolist()
            for part in chunks(texts):
                raw = [b"" if t is None else t.encode("utf-8", "surrogatepass") for t in texts[part]]
                yield pd.DataFrame({"doc_id": b["key"].iloc[part].to_numpy(), "n_bytes": [len(r) for r in raw], "media": [mux(padded(r)) for r in raw]})

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text")).mapInPandas(run, f"doc_id {kind}, n_bytes long, media binary")


def decoded(media: DataFrame) -> DataFrame:
    """What is read from a table of encoded(): payload size and digests, digest of the stored form, features, times and random-access points."""
    kind = media.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for key, n, m in zip(b["doc_id"], b["n_bytes"], b["media"]):
                m = bytes(m)
                s = demux(m)
                rows.append((key, n, len(s.payload), hashlib.sha256(s.payload).hexdigest(), zlib.crc32(s.payload[-64:]), len(m), hashlib.sha256(m).hexdigest(), s.feature(), s.packets, s.gaps + s.sync_errors + s.crc_errors + s.header_errors, [t for t, _ in s.access], [o for _, o in s.access]))
            yield pd.DataFrame(rows, columns=["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "packets", "errors", "access_times", "access_offsets"])

    return media.mapInPandas(run, f"doc_id {kind}, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, packets long, errors long, access_times array<long>, access_offsets array<long>")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The streams are written as a media column of a table in the shared folder and read from there."""
    return decoded(written(encoded(table(spark, sf_dir, "documents")), "media"))
