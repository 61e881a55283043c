import hashlib
import io
import zipfile
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from chronofold.llm import warc_zip as w
from chronofold.sources.scratch import new_folder

SCHEMA = "page_id bigint, url string, html string, path string, size string, digest string"


def pages():
    big, other = "<p>é</p>" * 300, "x" * 1000
    rows = [(1, "http://a/", big), (2, "http://b/\r\nX: y%0D", big), (3, None, big), (4, "u", "x" * 999), (5, "u", "x" * 999), (6, "u", None), (7, "u", "")]
    rows += [(8, "u", other), (9, "u", other), (9, "u", other), (None, "u", other), (None, None, None), (10, "u", "\r\n\r\n" * 400), (11, "u", "long " * 400_000)]
    return rows


def expected(rows):
    top = {}
    for k, _, html in rows:
        if k is not None and len((html or "").encode()) >= 1000:
            top[html] = max(k, top.get(html, k))
    out = Counter()
    for k, url, html in rows:
        raw = (html or "").encode()
        refers = top.get(html) if html in top and (k is None or k < top[html]) else None
        out[k, url, len(raw), hashlib.sha1(raw).hexdigest(), "response" if refers is None else "revisit", refers, raw if refers is None else None] += 1
    return out


@pytest.mark.parametrize("archive_bytes", [w.ARCHIVE_BYTES, 1])
def test_round_trip(spark, monkeypatch, archive_bytes):
    monkeypatch.setattr(w, "ARCHIVE_BYTES", archive_bytes)
    df = spark.createDataFrame([(*r, "c", "c", "c") for r in pages()], SCHEMA)
    out = w.archive_round_trip(df, payload=True)
    got = Counter(tuple(bytes(v) if isinstance(v, bytearray) else v for v in r) for r in out.collect())
    assert got == expected(pages())


def test_archives_are_read_in_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(w, "ARCHIVE_BYTES", 300)
    df = spark.createDataFrame([(i, None, f"{i} " * 700, "c", "c", "c") for i in range(120)], SCHEMA)
    manifest = w.write_archives(df, new_folder(spark, "warc"))
    files = manifest.count()
    assert files > 20 and spark.conf.get("spark.sql.adaptive.enabled") == "true"
    tasks = w.read_archives(spark, manifest).groupBy(F.spark_partition_id()).count()
    assert tasks.count() > 0.9 * files
    assert tasks.agg(F.sum("count")).first()[0] == 120


def test_copies_beyond_what_is_sent(spark, monkeypatch):
    monkeypatch.setattr(w, "COPIED_BYTES", 0)
    df = spark.createDataFrame([(*r, "c", "c", "c") for r in pages()], SCHEMA)
    got = Counter(tuple(bytes(v) if isinstance(v, bytearray) else v for v in r) for r in w.archive_round_trip(df, payload=True).collect())
    assert got == expected(pages())


def test_a_payload_larger_than_an_archive(spark, monkeypatch):
    monkeypatch.setattr(w, "ARCHIVE_BYTES", 1000)
    big = "".join(chr(33 + i * i % 90) for i in range(50_000))
    df = spark.createDataFrame([(1, "u", big, "c", "c", "c"), (2, "u", "small", "c", "c", "c")], SCHEMA)
    rows = {r["id"]: r["payload"] for r in w.archive_round_trip(df, payload=True).collect()}
    assert {k: bytes(v) for k, v in rows.items()} == {1: big.encode(), 2: b"small"}


def test_no_rows_no_archive(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert w.archive_round_trip(df).count() == 0


def test_archives_left_by_a_lost_task_are_not_read(spark):
    df = spark.createDataFrame([(*r, "c", "c", "c") for r in pages()], SCHEMA)
    folder = new_folder(spark, "warc")
    w.write_archives(df, folder)
    manifest = w.write_archives(df, folder)
    assert w.read_archives(spark, manifest, payload=False).count() == len(pages())


def test_archives_are_zip_files_others_can_read():
    packed = w.pack([("a/b", b"hello"), (w.INDEX, b"")])
    with zipfile.ZipFile(io.BytesIO(packed)) as z:
        assert z.read("a/b") == b"hello" and z.testzip() is None


@pytest.mark.parametrize("comment", [b"", b"PK\x05\x06 in a comment" * 3])
@pytest.mark.parametrize("zip64", [False, True])
def test_archives_of_others_can_be_read(comment, zip64):
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as z:
        with z.open("stored", "w", force_zip64=zip64) as f:
            f.write(b"some bytes")
        z.writestr(zipfile.ZipInfo("packed"), b"y" * 500, compress_type=zipfile.ZIP_DEFLATED)
        z.writestr("last", b"z")
    archive = w.Archive(pa.BufferReader(buffer.getvalue()))
    assert set(archive.members) == {"stored", "last"}
    assert archive.member("stored") == b"some bytes" and archive.member("last") == b"z"


def test_damage_is_found():
    packed = bytearray(w.pack([("a", b"hello")]))
    packed[packed.index(b"hello")] ^= 1
    with pytest.raises(ValueError, match="checksum"):
        w.Archive(pa.BufferReader(bytes(packed))).member("a")
    for cut in (0, 10, len(packed) - 30, len(packed) - 1):
        with pytest.raises(ValueError):
            w.Archive(pa.BufferReader(bytes(packed[:cut])))
    row = {"id": 1, "url": None, "size": 3, "digest": hashlib.sha1(b"abc").hexdigest(), "refers_to": None, "payload": b"abd"}
    with pytest.raises(ValueError, match="digest"):
        w.parsed(w.record(row))
