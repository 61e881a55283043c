"""Token ids of documents in coded files, in order of the documents, and back."""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from chronofold.functions import col_of
from chronofold.llm import id_coder
from chronofold.llm.batches import small_batches, use_small_batches
from chronofold.llm.encoder import CHUNK, encoder
from chronofold.llm.jvm import functions
from chronofold.sources.scratch import freeze, new_folder

MAGIC = b"TOKR0001"
END_ID = 0
# Ids of a part, of which a worker gets several at once.
PART = 64 * id_coder.BLOCK
# Characters of a text by which rows of one key are dealt to tasks.
PREFIX = 64


def coded(texts: list[str], tokenizer: str) -> tuple[np.ndarray, np.ndarray]:
    """All ids in a row, ``END_ID`` after each text, and how many each text has with it."""
    ids, counts = encoder(tokenizer).encode(texts)
    ended = np.full(len(ids) + len(counts), END_ID, np.int32)
    kept = np.ones(len(ended), bool)
    kept[np.cumsum(counts + 1) - 1] = False
    ended[kept] = ids
    return ended, counts + 1


def chunks(texts: list[str]) -> Iterator[list[str]]:
    """Runs of texts with about ``CHUNK`` characters, or one text."""
    run, size = [], 0
    for text in texts:
        if run and size + len(text) > CHUNK:
            yield run
            run, size = [], 0
        run.append(text)
        size += len(text)
    if run:
        yield run


class Parts:
    """Cuts the ids of a task into parts of ``PART``, each with the documents that came since the one before."""

    def __init__(self) -> None:
        self.held: list[np.ndarray] = []
        self.waiting = 0
        self.keys: list[int | None] = []
        self.counts: list[int] = []

    def add(self, keys: list[int | None], ids: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
        if len(ids) and (ids.min() < 0 or ids.max() > id_coder.MOST_ID):
            raise ValueError(f"ids must lie between 0 and {id_coder.MOST_ID}")
        self.keys += keys
        self.counts += counts.tolist()
        self.held.append(ids.astype("<u2"))
        self.waiting += len(ids)
        if self.waiting >= PART:
            yield from self.cut(PART)

    def cut(self, least: int = 1) -> Iterator[pa.RecordBatch]:
        """Parts while at least so many ids wait."""
        ids, at = np.concatenate([np.zeros(0, "<u2"), *self.held]), 0
        while len(ids) - at >= least:
            part = ids[at : at + PART]
            at += len(part)
            row = (part.tobytes(), self.keys, self.counts)
            types = (pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, types)], ["ids", "keys", "counts"])
            self.keys, self.counts = [], []
        self.held, self.waiting = [ids[at:].copy()], len(ids) - at


class FileWriter:
    """A file: the coded ids in parts, then the documents with their counts, then where those begin."""

    def __init__(self, folder: str) -> None:
        system, base = fs.FileSystem.from_uri(folder)
        system.create_dir(base, recursive=True)
        name = f"part-{uuid.uuid4().hex}.tok"
        self.path, self.out = f"{folder}/{name}", system.open_output_stream(f"{base}/{name}")
        self.out.write(MAGIC)
        self.keys: list[int | None] = []
        self.counts: list[int] = []

    def add(self, keys: list[int | None], counts: list[int], code: bytes) -> None:
        self.keys += keys
        self.counts += counts
        self.out.write(struct.pack("<Q", len(code)) + code)

    def close(self) -> tuple[str, int, int]:
        known = np.array([k is not None for k in self.keys], np.uint8)
        keys = np.array([k or 0 for k in self.keys], "<i8")
        table = keys.tobytes() + known.tobytes() + np.array(self.counts, "<i8").tobytes()
        self.out.write(struct.pack("<Q", 0) + table)
        self.out.write(struct.pack("<QI", len(self.keys), zlib.crc32(table)) + MAGIC)
        self.out.close()
        return self.path, len(self.keys), sum(self.counts)


def file_parts(path: str) -> Iterator[tuple[bytes | None, bytes | None]]:
    """The table of a file's documents, then its coded parts: of each pair one is None."""
    system, place = fs.FileSystem.from_uri(path)
    with system.open_input_file(place) as file:
        end = file.size() - 20
        n, crc = struct.unpack("<QI", file.read_at(12, end))
        if file.read_at(8, end + 12) != MAGIC or file.read_at(8, 0) != MAGIC:
            raise ValueError(f"{path} is not a token file, or is cut short")
        table = file.read_at(17 * n, end - 17 * n)
        if zlib.crc32(table) != crc:
            raise ValueError(f"checksum of the documents in {path} differs")
        yield table, None
        at = 8
        while True:
            (size,) = struct.unpack("<Q", file.read_at(8, at))
            if not size:
                break
            yield None, file.read_at(size, at + 8)
            at += 8 + size


class Documents:
    """Documents of a file in runs, from the ids of its parts."""

    def __init__(self, path: str, table: bytes) -> None:
        n = len(table) // 17
        self.path, self.done, self.held = path, 0, []
        self.keys = np.frombuffer(table, "<i8", n)
        self.known = np.frombuffer(table, np.uint8, n, 8 * n).astype(bool)
        self.counts = np.frombuffer(table, "<i8", n, 9 * n)
        self.ends = np.cumsum(self.counts)
        self.came = 0

    def add(self, ids: bytes) -> tuple[pa.Array, np.ndarray, np.ndarray]:
        """Keys of the documents that are whole now, their ids in a row, and how many each has."""
        self.held.append(np.frombuffer(ids, "<u2"))
        self.came += len(self.held[-1])
        run = slice(self.done, int(np.searchsorted(self.ends, self.came, side="right")))
        used, found = int(self.counts[run].sum()), np.zeros(0, "<u4")
        if used:
            held = np.concatenate(self.held)
            found, self.held = held[:used].astype("<u4"), [held[used:]]
        self.done = run.stop
        return pa.array(self.keys[run], pa.int64(), mask=~self.known[run]), found, self.counts[run]

    def close(self) -> None:
        if self.done < len(self.counts) or any(map(len, self.held)):
            raise ValueError(f"{self.path} holds other ids than its documents have")


def id_functions(spark: SparkSession) -> list[Callable[[Column | str], Column]]:
    """``id_coder.encode`` and ``decode`` for columns; ids are 16-bit numbers in a row, lowest byte first."""
    return functions(spark, "id_coder.java", EncodeIds="binary", DecodeIds="binary")


def write_tokens(df: DataFrame, folder: str, tokenizer: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Write the ids of all rows, in ascending order of the key; returns the manifest.

    The manifest has a row for each file: path, docs, tokens, and start, the number of ids in the files
    before it. Every document ends with id 0; a null or empty text has that alone. Null keys come first, rows with
    one key are in order of their text, and are dealt to tasks by how it begins; only rows with one key and one beginning
    share a file. Keys are whole numbers. An empty table writes no file.
    """
    slim = df.select(col_of(key).cast("long").alias("key"), col_of(text).alias("text"))
    by = F.col("key").asc_nulls_first()
    slim = slim.repartitionByRange(by, F.substring("text", 1, PREFIX)).sortWithinPartitions(by, "text")

    def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, begins = Parts(), None
        for batch in batches:
            keys = batch.column(0).to_pylist()
            texts = [t or "" for t in batch.column(1).to_pylist()]
            if begins is None and len(batch):
                begins = batch.column(1)[:1].to_pylist()
                begins = [b and b[:PREFIX] for b in begins]
            done = 0
            for run in chunks(texts):
                for part in parts.add(keys[done : done + len(run)], *coded(run, tokenizer)):
                    yield part.append_column("begins", pa.array(begins, pa.string()))
                done += len(run)
        for part in parts.cut():
            yield part.append_column("begins", pa.array(begins, pa.string()))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer, first, begins = None, None, None
        for batch in batches:
            for code, keys, counts, begin in zip(*(c.to_pylist() for c in batch.columns)):
                if writer is None:
                    writer, first, begins = FileWriter(folder), keys[0], begin
                writer.add(keys, counts, code)
        if writer is not None:
            path, docs, tokens = writer.close()
            found = {"path": [path], "first": pa.array([first], pa.int64()), "begins": pa.array([begins], pa.string())}
            yield pa.RecordBatch.from_pydict(found | {"docs": [docs], "tokens": [tokens]})

    encode, _ = id_functions(df.sparkSession)
    parts = slim.mapInArrow(tokens, "ids binary, keys array<bigint>, counts array<bigint>, begins string")
    parts = parts.select(encode("ids").alias("code"), "keys", "counts", "begins")
    with small_batches(df.sparkSession):
        files = freeze(parts.mapInArrow(write, "path string, first bigint, begins string, docs bigint, tokens bigint"))
    # a row for each file
    order = Window.orderBy(F.col("first").asc_nulls_first(), F.col("begins").asc_nulls_first())
    number = F.row_number().over(order) - 1
    start = F.coalesce(F.sum("tokens").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return freeze(files.withColumns({"number": number, "start": start}).drop("first", "begins"))


def read_tokens(spark: SparkSession, manifest: DataFrame, ids: bool = True) -> DataFrame:
    """From the files: key, start, n_tokens, ids_crc32 and, if asked for, ids of each document.

    Damaged files, blocks and document tables raise an error.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("path", "start", "documents", "code")
        types = (pa.string(), pa.int64(), pa.binary(), pa.binary())
        for batch in batches:
            for path, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for documents, code in file_parts(path):
                    row = (path, start, documents, code)
                    yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, types)], names)

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file, begin = None, 0
        for batch in batches:
            for path, start, documents, part in zip(*(c.to_pylist() for c in batch.columns)):
                if documents is not None:
                    if file is not None:
                        file.close()
                    file, begin = Documents(path, documents), start
                    continue
                keys, found, counts = file.add(part)
                ends = np.cumsum(counts)
                raw = memoryview(found).cast("B")
                sums = [zlib.crc32(raw[4 * (e - c) : 4 * e]) for c, e in zip(counts.tolist(), ends.tolist())]
                columns = {
                    "key": keys,
                    "start": pa.array(ends - counts + begin),
                    "n_tokens": pa.array(counts.astype(np.int64)),
                    "ids_crc32": pa.array(sums, pa.int64()),
                }
                if ids:
                    columns["ids"] = pa.ListArray.from_arrays(
                        pa.array(np.concatenate([[0], ends]).astype(np.int32)), pa.array(found.astype(np.int32))
                    )
                yield pa.RecordBatch.from_pydict(columns)
                begin += len(found)
        if file is not None:
            file.close()

    files = manifest.count()
    dealt = manifest.select("path", "start", "number").repartitionByRange(max(1, files), "number")
    _, decode = id_functions(spark)
    use_small_batches(spark)
    parts = dealt.select("path", "start").mapInArrow(read, "path string, start bigint, documents binary, code binary")
    parts = parts.select("path", "start", "documents", decode("code").alias("ids"))
    schema = "key bigint, start bigint, n_tokens bigint, ids_crc32 bigint" + (", ids array<int>" if ids else "")
    return parts.mapInArrow(assemble, schema)


def token_round_trip(
    df: DataFrame, tokenizer: str, text: str = "text", key: str = "doc_id", ids: bool = False
) -> DataFrame:
    """Write the ids of the rows into the shared folder and read all of them back."""
    spark = df.sparkSession
    return read_tokens(spark, write_tokens(df, new_folder(spark, "tokens"), tokenizer, text, key), ids)
