"""WARC records packed in ZIP archives: written by tasks, read back by ranges.

An archive holds two stored members: ``archive/data.warc.gz``, where every record is a gzip
member of its own, and ``indexes/index.cdxj``, a line for each record with its offset and
length in the first. A reader finds the members by the central directory at the archive's end, reads the index, and
then reads ranges of records straight out of the archive; nothing is unpacked to disk. Archives are in shared storage; a
manifest names those that count, so files that a lost task left behind are never read.
"""

from __future__ import annotations

import gzip
import hashlib
import json
import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from chronofold.functions import col_of
from chronofold.operators.sizing import BROADCAST_BYTES, measure
from chronofold.operators.skew import salted_join
from chronofold.sources.scratch import freeze, new_folder

DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
ARCHIVE_BYTES = 48 * 1024 * 1024
READ_BYTES = 4 * 1024 * 1024
# Digests of copied pages that every task may get.
COPIED_BYTES = BROADCAST_BYTES
LEAST_REVISIT = 1000
WARC_DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
# Signatures of the ZIP format.
LOCAL, CENTRAL, END = 0x04034B50, 0x02014B50, 0x06054B50
END64, LOCATOR64 = 0x06064B50, 0x07064B50
FULL16, FULL32 = 0xFFFF, 0xFFFFFFFF


def pack(members: list[tuple[str, bytes]]) -> bytes:
    """A ZIP archive of stored members, with ZIP64 directories whatever its size."""
    out, directory = bytearray(), bytearray()
    for name, data in members:
        raw, crc, at = name.encode(), zlib.crc32(data), len(out)
        sizes = struct.pack("<HHQQ", 1, 16, len(data), len(data))
        out += struct.pack("<IHHHHHIIIHH", LOCAL, 45, 0x800, 0, 0, 0x21, crc, FULL32, FULL32, len(raw), len(sizes))
        out += raw + sizes + data
        extra = struct.pack("<HHQQQ", 1, 24, len(data), len(data), at)
        directory += struct.pack(
            "<IHHHHHHIIIHHHHHII", CENTRAL, 45, 45, 0x800, 0, 0, 0x21, crc, FULL32, FULL32, len(raw), len(extra), 0, 0, 0, 0, FULL32
        )
        directory += raw + extra
    at, n = len(out), len(members)
    out += directory
    end = len(out)
    out += struct.pack("<IQHHIIQQQQ", END64, 44, 45, 45, 0, 0, n, n, len(directory), at)
    out += struct.pack("<IIQI", LOCATOR64, 0, end, 1)
    out += struct.pack("<IHHHHIIH", END, 0, 0, FULL16, FULL16, FULL32, FULL32, 0)
    return bytes(out)


@dataclass(frozen=True)
class Member:
    name: str
    offset: int
    size: int
    crc: int


class Archive:
    """The stored members of a ZIP archive, by its central directory, ZIP64 or not."""

    def __init__(self, file: pa.NativeFile) -> None:
        self.file = file
        self.size = file.size()
        self.members = {m.name: m for m in self._directory()}

    def read(self, offset: int, size: int) -> bytes:
        if offset < 0 or offset + size > self.size:
            raise ValueError(f"range {offset}+{size} lies outside an archive of {self.size} bytes")
        return self.file.read_at(size, offset)

    def _directory(self) -> Iterator[Member]:
        tail_at = max(0, self.size - 22 - FULL16)
        tail = self.read(tail_at, self.size - tail_at)
        at = tail.rfind(struct.pack("<I", END))
        if at < 0 or len(tail) - at < 22:
            raise ValueError("no end of central directory: not a ZIP archive, or cut short")
        _, _, _, n, size, offset, _ = struct.unpack_from("<HHHHIIH", tail, at + 4)
        if FULL16 == n or FULL32 in (size, offset):
            locator = self.read(tail_at + at - 20, 20)
            signature, _, end64, _ = struct.unpack("<IIQI", locator)
            if signature != LOCATOR64:
                raise ValueError("the ZIP64 locator is missing")
            signature, *_, n, size, offset = struct.unpack("<IQHHIIQQQQ", self.read(end64, 56))
            if signature != END64:
                raise ValueError("the ZIP64 end of central directory is missing")
        raw, at = self.read(offset, size), 0
        for _ in range(n):
            fields = struct.unpack_from("<IHHHHHHIIIHHHHHII", raw, at)
            if fields[0] != CENTRAL:
                raise ValueError("the central directory is damaged")
            method, crc, packed, full, names, extras, comments, start = (fields[i] for i in (4, 7, 8, 9, 10, 11, 12, 16))
            name = raw[at + 46 : at + 46 + names].decode()
            extra = raw[at + 46 + names : at + 46 + names + extras]
            full, packed, start = self._wide(extra, [full, packed, start])
            at += 46 + names + extras + comments
            if method == 0 and full == packed:
                yield Member(name, self._content(start), full, crc)

    @staticmethod
    def _wide(extra: bytes, values: list[int]) -> list[int]:
        """Sizes and offset, from the ZIP64 field where they don't fit 32 bits."""
        at = 0
        while at + 4 <= len(extra):
            kind, size = struct.unpack_from("<HH", extra, at)
            if kind == 1:
                wide = iter(struct.unpack_from(f"<{size // 8}Q", extra, at + 4))
                return [next(wide) if v == FULL32 else v for v in values]
            at += 4 + size
        return values

    def _content(self, start: int) -> int:
        head = struct.unpack("<IHHHHHIIIHH", self.read(start, 30))
        if head[0] != LOCAL:
            raise ValueError("a member's local header is damaged")
        return start + 30 + head[9] + head[10]

    def member(self, name: str) -> bytes:
        """All of a small member, checked."""
        m = self.members[name]
        data = self.read(m.offset, m.size)
        if zlib.crc32(data) != m.crc:
            raise ValueError(f"checksum of {name} differs")
        return data

    def records(self, index: list[dict]) -> Iterator[tuple[dict, bytes]]:
        """The bytes of indexed records; neighbours are fetched in one range."""
        data = self.members[DATA]
        i = 0
        index = sorted(index, key=lambda e: e["offset"])
        while i < len(index):
            j, start = i + 1, index[i]["offset"]
            end = start + index[i]["length"]
            while j < len(index) and index[j]["offset"] == end and end - start < READ_BYTES:
                end += index[j]["length"]
                j += 1
            if end > data.size:
                raise ValueError("the index points beyond the archived member")
            block = self.read(data.offset + start, end - start)
            for entry in index[i:j]:
                yield entry, block[entry["offset"] - start : entry["offset"] - start + entry["length"]]
            i = j


def header_value(value: str) -> str:
    """A value that stays on its line; other characters are kept."""
    return value.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A")


def record(row: dict) -> bytes:
    """A WARC record: the payload under HTTP headers, or for a revisit the headers alone."""
    payload = row["payload"]
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {row['size']}\r\n\r\n".encode()
    revisit = row["refers_to"] is not None
    block = http if revisit else http + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:page:{'' if row['id'] is None else row['id']}>",
        f"WARC-Date: {WARC_DATE}",
        f"WARC-Payload-Digest: sha1:{row['digest']}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if row["url"] is not None:
        lines.append(f"WARC-Target-URI: {header_value(row['url'])}")
    if revisit:
        lines += [f"WARC-Refers-To: <urn:page:{row['refers_to']}>", f"WARC-Profile: {PROFILE}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def headers_of(raw: bytes) -> dict[str, str]:
    return dict(line.split(": ", 1) for line in raw.decode().split("\r\n")[1:])


def parsed(raw: bytes) -> dict:
    """The fields of a record; the payload's digest is checked."""
    head, body = raw.split(b"\r\n\r\n", 1)
    if not head.startswith(b"WARC/1."):
        raise ValueError("not a WARC record")
    warc = headers_of(head)
    block = body[: int(warc["Content-Length"])]
    if body[len(block) :] != b"\r\n\r\n":
        raise ValueError("a WARC record is cut short")
    http, payload = block.split(b"\r\n\r\n", 1)
    size, digest = int(headers_of(http)["Content-Length"]), warc["WARC-Payload-Digest"].removeprefix("sha1:")
    if warc["WARC-Type"] == "response":
        found = hashlib.sha1(payload).hexdigest()
        if len(payload) != size or found != digest:
            raise ValueError(f"payload of {warc['WARC-Record-ID']} differs from its digest")
    name = lambda v: re.fullmatch(r"<urn:page:(-?\d*)>", v)[1]
    number = lambda v: int(v) if v else None
    url = warc.get("WARC-Target-URI")
    return {
        "id": number(name(warc["WARC-Record-ID"])),
        "url": url and url.replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%"),
        "size": size,
        "digest": digest,
        "type": warc["WARC-Type"],
        "refers_to": number(name(warc["WARC-Refers-To"])) if "WARC-Refers-To" in warc else None,
        "payload": payload if warc["WARC-Type"] == "response" else None,
    }


def with_revisits(df: DataFrame, key: str, url: str, html: str) -> DataFrame:
    """id, url, payload, size, digest and refers_to: the largest id with an equal large payload."""
    payload = F.coalesce(col_of(html).cast("binary"), F.lit(b"").cast("binary"))
    rows = df.select(col_of(key).cast("long").alias("id"), col_of(url).cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumns({"size": F.octet_length("payload").cast("long"), "digest": F.sha1("payload")})
    large = rows.where(F.col("size") >= LEAST_REVISIT).groupBy("digest", "size")
    copied = large.agg(F.max("id").alias("top"), F.count("*").alias("n")).where("n > 1").drop("n")
    copied = freeze(copied)
    on = ["digest", "size"]
    # a page that is found very often is dealt over many tasks
    rows = rows.join(F.broadcast(copied), on, "left") if measure(copied).fits(COPIED_BYTES) else salted_join(rows, copied, on, "left")
    refers = F.when(F.col("top") > F.coalesce("id", F.lit(-(2**63))), F.col("top"))
    return rows.select("id", "url", "size", "digest", refers.alias("refers_to"), "payload").withColumn(
        "payload", F.when(F.col("refers_to").isNull(), F.col("payload"))
    )


def write_archives(df: DataFrame, folder: str, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Write a record for each row; returns the manifest: path, records and bytes of each archive.

    Of rows with equal payloads of at least 1000 bytes the one with the largest key is a response and the
    others revisit it; all others are responses. A null html is an empty payload, a null
    key is not a largest one, and rows that share the largest key are all responses. An empty
    table writes no archive. Keys are whole numbers.
    """
    rows = with_revisits(df, key, url, html)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = fs.FileSystem.from_uri(folder)
        system.create_dir(base, recursive=True)

        def close(data: bytearray, index: list[bytes]) -> pa.RecordBatch:
            name = f"part-{uuid.uuid4().hex}.zip"
            packed = pack([(DATA, bytes(data)), (INDEX, b"".join(index))])
            with system.open_output_stream(f"{base}/{name}") as out:
                out.write(packed)
            return pa.RecordBatch.from_pydict({"path": [f"{folder}/{name}"], "records": [len(index)], "bytes": [len(packed)]})

        data, index = bytearray(), []
        for batch in batches:
            for row in batch.to_pylist():
                raw = gzip.compress(record(row), compresslevel=1, mtime=0)
                entry = {"offset": len(data), "length": len(raw), "type": "revisit" if row["refers_to"] is not None else "response"}
                index.append(f"{'' if row['id'] is None else row['id']} {WARC_DATE} {json.dumps(entry)}\n".encode())
                data += raw
                if len(data) >= ARCHIVE_BYTES:
                    yield close(data, index)
                    data, index = bytearray(), []
        if index:
            yield close(data, index)

    return freeze(rows.mapInArrow(write, "path string, records bigint, bytes bigint"))


def read_archives(spark: SparkSession, manifest: DataFrame, payload: bool = True) -> DataFrame:
    """The records of the archives: id, url, size, digest, type, refers_to and, if asked for, payload.

    Tasks get whole archives, which are bounded in size. Damaged archives, indexes and
    records raise an error.
    """
    fields = "id bigint, url string, size bigint, digest string, type string, refers_to bigint"
    schema = fields + (", payload binary" if payload else "")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [("id", pa.int64()), ("url", pa.string()), ("size", pa.int64()), ("digest", pa.string()), ("type", pa.string()), ("refers_to", pa.int64())]
        kinds += [("payload", pa.binary())] if payload else []
        for batch in batches:
            for path in batch.column(0).to_pylist():
                system, place = fs.FileSystem.from_uri(path)
                with system.open_input_file(place) as file:
                    archive = Archive(file)
                    index = [json.loads(x.split(" ", 2)[2]) for x in archive.member(INDEX).decode().splitlines()]
                    rows = []
                    for _, raw in archive.records(index):
                        rows.append(parsed(gzip.decompress(raw)))
                        if len(rows) == 500:
                            yield pa.RecordBatch.from_pylist(rows, schema=pa.schema(kinds))
                            rows = []
                    if rows:
                        yield pa.RecordBatch.from_pylist(rows, schema=pa.schema(kinds))

    # rows of the manifest are tiny, so they are dealt by number: a task for each archive
    numbered = manifest.select("path", F.row_number().over(Window.orderBy("path")).alias("number"))
    dealt = numbered.repartitionByRange(max(1, manifest.count()), "number")
    return dealt.select("path").mapInArrow(read, schema)


def archive_round_trip(df: DataFrame, key: str = "page_id", url: str = "url", html: str = "html", payload: bool = False) -> DataFrame:
    """Write the rows as archives in the shared folder and read all of them back."""
    spark = df.sparkSession
    manifest = write_archives(df, new_folder(spark, "warc"), key, url, html)
    return read_archives(spark, manifest, payload)
