"""WARC records in ZIP packages: writing, and reading by ranges without extraction.

A package holds ``archive/data.warc.gz`` (records, each its own gzip member) and ``indexes/index.cdxj`` (a line of JSON
for each record), both stored, not compressed, so that a byte range of the package is a byte range of the member. Members
and packages always carry ZIP64 fields, as a streamed member's size is not known when it begins.

Files go to the shared folder through ``pyarrow.fs``, one or more for each task, under names that no other attempt of the
task uses; only the list that the finished tasks return is read, so lost executors leave nothing half-written behind it.
"""

from __future__ import annotations

import base64
import hashlib
import json
import struct
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamis.llm.common import arrow_map, materialise, scratch
from tamis.session import reach

DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
#: A package ends after so many records or bytes.
MOST_RECORDS, MOST_BYTES = 20_000, 1 << 28
READ_BYTES = 4 << 20
DATE = "2024-01-01T00:00:00Z"
#: Record ids are UUIDs of this prefix and the page's id; the second prefix marks a missing id.
_ID, _NO_ID = 0x7A61B1E5_0000_8000 << 64, 0x7A61B1E5_0001_8000 << 64
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _urn(page: int | None) -> str:
    return f"<urn:uuid:{uuid.UUID(int=_NO_ID if page is None else _ID | (page & 0xFFFFFFFFFFFFFFFF))}>"


def _page(urn: str) -> int | None:
    n = uuid.UUID(urn[len("<urn:uuid:") : -1]).int
    if n >> 64 == _NO_ID >> 64:
        return None
    return struct.unpack(">q", (n & 0xFFFFFFFFFFFFFFFF).to_bytes(8, "big"))[0]


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """A WARC record: a revisit, without its payload, if ``refers_to`` is given, else a response."""
    target = "".join(c if " " < c else f"%{ord(c):02X}" for c in (url or "urn:none"))
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {_urn(page)}",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {target}",
        f"WARC-Payload-Digest: sha1:{payload_digest(payload)}",
        *([] if refers_to is None else [f"WARC-Refers-To: {_urn(refers_to)}", f"WARC-Profile: {PROFILE}"]),
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes) -> dict:
    """Headers (lower-case names), ``http`` headers and ``payload`` (None for a revisit) of one record."""
    end = data.index(b"\r\n\r\n")
    lines = data[:end].decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    out: dict = dict((k.lower(), v.strip()) for k, _, v in (x.partition(":") for x in lines[1:]))
    block = data[end + 4 : end + 4 + int(out["content-length"])]
    cut = block.index(b"\r\n\r\n")
    out["http"] = dict((k.lower(), v.strip()) for k, _, v in (x.partition(":") for x in block[:cut].decode().split("\r\n")[1:]))
    out["payload"] = block[cut + 4 :] if out["warc-type"] == "response" else None
    return out


# ZIP --------------------------------------------------------------------------------------------------------------


class PackageWriter:
    """Stored members, streamed one after another; sizes follow each member and stand in the central directory."""

    def __init__(self, stream):
        self.stream, self.at = stream, 0
        self.members: list[tuple[bytes, int, int, int]] = []
        self._open: list | None = None

    def _put(self, data: bytes) -> None:
        self.stream.write(data)
        self.at += len(data)

    def begin(self, name: str) -> None:
        raw = name.encode()
        self._open = [raw, self.at, 0, 0]
        extra = struct.pack("<HHQQ", 1, 16, 0, 0)
        self._put(struct.pack("<IHHHHHIIIHH", 0x04034B50, 45, 0x0808, 0, 0, 0x21, 0, 0xFFFFFFFF, 0xFFFFFFFF, len(raw), len(extra)) + raw + extra)

    def write(self, data: bytes) -> None:
        self._open[2] = zlib.crc32(data, self._open[2])
        self._open[3] += len(data)
        self._put(data)

    def end(self) -> None:
        raw, start, crc, size = self._open
        self._put(struct.pack("<IIQQ", 0x08074B50, crc, size, size))
        self.members.append((raw, start, crc, size))
        self._open = None

    def close(self) -> None:
        first = self.at
        for raw, start, crc, size in self.members:
            extra = struct.pack("<HHQQQ", 1, 24, size, size, start)
            self._put(struct.pack("<IHHHHHHIIIHHHHHII", 0x02014B50, 45, 45, 0x0808, 0, 0, 0x21, crc, 0xFFFFFFFF, 0xFFFFFFFF, len(raw), len(extra), 0, 0, 0, 0, 0xFFFFFFFF) + raw + extra)
        length, end64, n = self.at - first, self.at, len(self.members)
        self._put(struct.pack("<IQHHIIQQQQ", 0x06064B50, 44, 45, 45, 0, 0, n, n, length, first))
        self._put(struct.pack("<IIQI", 0x07064B50, 0, end64, 1))
        self._put(struct.pack("<IHHHHIIH", 0x06054B50, 0, 0, 0xFFFF, 0xFFFF, 0xFFFFFFFF, 0xFFFFFFFF, 0))


class Package:
    """A ZIP file read by ranges: ``members`` maps a stored member's name to (first byte of its data, size)."""

    def __init__(self, file, size: int):
        self.file, self.size = file, size
        tail_at = max(0, size - 65_557 - 76)
        tail = self.read(tail_at, size - tail_at)
        at = tail.rfind(b"PK\x05\x06")
        if at < 0:
            raise ValueError("no end of central directory")
        _, _, _, _, count, length, first, _ = struct.unpack_from("<IHHHHIIH", tail, at)
        if at >= 20 and tail[at - 20 : at - 16] == b"PK\x06\x07":
            end64 = struct.unpack_from("<IIQI", tail, at - 20)[2]
            big = self.read(end64, 56)
            if big[:4] != b"PK\x06\x06":
                raise ValueError("no ZIP64 end of central directory")
            count, length, first = struct.unpack_from("<QQQ", big, 32)
        self.members: dict[str, tuple[int, int]] = {}
        directory, at = self.read(first, length), 0
        for _ in range(count):
            head = struct.unpack_from("<IHHHHHHIIIHHHHHII", directory, at)
            if head[0] != 0x02014B50:
                raise ValueError("broken central directory")
            method, packed, whole, n_name, n_extra, n_comment, start = head[4], head[8], head[9], head[10], head[11], head[12], head[16]
            name = directory[at + 46 : at + 46 + n_name].decode()
            packed, start = self._big(directory[at + 46 + n_name : at + 46 + n_name + n_extra], whole, packed, start)
            at += 46 + n_name + n_extra + n_comment
            if method == 0:
                local = self.read(start, 30)
                if local[:4] != b"PK\x03\x04":
                    raise ValueError("broken local header")
                a, b = struct.unpack_from("<HH", local, 26)
                self.members[name] = (start + 30 + a + b, packed)

    @staticmethod
    def _big(extra: bytes, whole: int, packed: int, start: int) -> tuple[int, int]:
        """Size and place, from the ZIP64 field where the plain fields are full."""
        i = 0
        while i + 4 <= len(extra):
            kind, n = struct.unpack_from("<HH", extra, i)
            if kind == 1:
                j = i + 4 + 8 * (whole == 0xFFFFFFFF)
                if packed == 0xFFFFFFFF:
                    packed = struct.unpack_from("<Q", extra, j)[0]
                    j += 8
                if start == 0xFFFFFFFF:
                    start = struct.unpack_from("<Q", extra, j)[0]
            i += 4 + n
        return packed, start

    def read(self, at: int, n: int) -> bytes:
        self.file.seek(at)
        got = self.file.read(n)
        if len(got) != n:
            raise ValueError(f"the package ends {n - len(got)} bytes early")
        return got

    def _within(self, folder: str, ends: tuple[str, ...]) -> list[str]:
        return sorted(m for m in self.members if m.startswith(f"{folder}/") and m.endswith(ends))

    def index(self) -> list[dict]:
        """The entries of all indexes, by archive and place; an entry that names no archive is of the only one."""
        archives = self._within("archive", (".warc.gz", ".warc"))
        out = []
        for name in self._within("indexes", (".cdxj", ".cdx")):
            for line in self.read(*self.members[name]).splitlines():
                if line.strip() and not line.startswith(b"!"):
                    entry = json.loads(line.split(b" ", 2)[2])
                    entry |= {k: int(entry[k]) for k in ("offset", "length")}
                    own = entry.setdefault("filename", archives[0].removeprefix("archive/") if len(archives) == 1 else "")
                    if f"archive/{own}" not in archives:
                        raise ValueError(f"no archive {own!r} in the package")
                    out.append(entry)
        return sorted(out, key=lambda e: (e["filename"], e["offset"]))

    def records(self) -> Iterator[tuple[dict, bytes]]:
        """(index entry, record) in order; neighbouring ranges are read together up to ``READ_BYTES``."""
        entries, i = self.index(), 0
        while i < len(entries):
            j, first, own = i, entries[i]["offset"], entries[i]["filename"]
            start, size = self.members[f"archive/{own}"]
            while j < len(entries) and entries[j]["filename"] == own and (j == i or entries[j]["offset"] + entries[j]["length"] - first <= READ_BYTES):
                j += 1
            end = max(e["offset"] + e["length"] for e in entries[i:j])
            if end > size:
                raise ValueError(f"the index goes beyond archive {own!r}")
            data = self.read(start + first, end - first)
            for e in entries[i:j]:
                part = data[e["offset"] - first : e["offset"] - first + e["length"]]
                yield e, zlib.decompress(part, wbits=31) if own.endswith(".gz") else part
            i = j


def open_package(path: str) -> Package:
    system, at = fs.FileSystem.from_uri(path)
    return Package(system.open_input_file(at), system.get_file_info(at).size)


# Spark ------------------------------------------------------------------------------------------------------------


def write_packages(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """The written list: (path, records). Of equal payloads the smallest page id is the response, others revisit it."""
    named = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), F.coalesce(html_col, F.lit("")).alias("html"))
    keyed = named.withColumn("sha", F.unhex(F.sha1(F.encode("html", "utf-8"))))
    again = keyed.groupBy("sha").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1").select("sha", "first")
    again = materialise(again, "payloads")
    told = keyed.join(again, "sha", "left").select("page_id", "url", "html", F.expr("CASE WHEN first = page_id THEN NULL ELSE first END").alias("refers"))

    def run(batches):
        system, base = fs.FileSystem.from_uri(folder)
        system.create_dir(base, recursive=True)
        task = TaskContext.get()
        stem, n, done = f"part-{task.partitionId():06d}-{task.taskAttemptId()}-{uuid.uuid4().hex[:8]}", 0, []
        writer = None
        lines: list[bytes] = []

        def finish() -> None:
            nonlocal writer
            writer.end()
            writer.begin(INDEX)
            for line in lines:
                writer.write(line)
            writer.end()
            writer.close()
            writer.stream.close()
            done.append((f"{folder}/{stem}-{n:04d}.zip", len(lines)))
            lines.clear()
            writer = None

        size = 0
        for batch in batches:
            for i in range(batch.num_rows):
                page, url, html, refers = (batch.column(c)[i].as_py() for c in range(4))
                if writer is None:
                    n += 1
                    size = 0
                    writer = PackageWriter(system.open_output_stream(f"{base}/{stem}-{n:04d}.zip"))
                    writer.begin(DATA)
                pack = zlib.compressobj(3, wbits=31)
                data = pack.compress(record(page, url, html.encode(), refers)) + pack.flush()
                writer.write(data)
                entry = {"page": page, "filename": DATA.removeprefix("archive/"), "offset": size, "length": len(data)}
                lines.append(f"{page} {DATE} {json.dumps(entry)}\n".encode())
                size += len(data)
                if len(lines) >= MOST_RECORDS or size >= MOST_BYTES:
                    finish()
        if writer is not None:
            finish()
        if done:
            yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done]), pa.array([d[1] for d in done], pa.int64())], names=["path", "records"])

    reach(pages.sparkSession)
    return materialise(told.mapInArrow(run, "path string, records long"), "packages")


def read_packages(packages: DataFrame) -> DataFrame:
    """A row for each record of the listed packages; a response's digest and size are those of the payload read."""

    def make():
        def step(batch):
            for path in batch.column("path").to_pylist():
                rows: list[tuple] = []
                for entry, data in open_package(path).records():
                    rows.append(_row(entry, data))
                    if len(rows) == 4096:
                        yield _rows(rows)
                        rows = []
                yield _rows(rows)

        return step

    n = max(1, min(2000, packages.count()))
    spread = packages.repartition(n, "path")
    return arrow_map(spread, ["path"], "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string", make)


def _row(entry: dict, data: bytes) -> tuple:
    got = parse_record(data)
    said = got["warc-payload-digest"].removeprefix("sha1:")
    size = int(got["http"]["content-length"])
    if got["payload"] is not None and (payload_digest(got["payload"]) != said or len(got["payload"]) != size):
        raise ValueError(f"record of page {entry['page']} is damaged")
    refers = got.get("warc-refers-to")
    return _page(got["warc-record-id"]), size, said, got["warc-type"], refers and _page(refers), got["warc-target-uri"]


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string())
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url"]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names)


def round_trip(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``pages`` written to packages in the shared folder and read back.

    Defined cases: null html is an empty payload; rows that share the smallest id of their payload are all responses; a
    row without an id revisits the smallest id of its payload, or is a response where none has an id; a null url is
    ``urn:none``; payloads of any length are written whole; an empty table writes nothing and gives no rows; other columns are left aside.
    """
    folder = scratch(pages.sparkSession, "warc")
    return read_packages(write_packages(pages, folder, id_col, url_col, html_col))
