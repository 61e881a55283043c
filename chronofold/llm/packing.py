"""Packing of documents into token sequences of one size: bounded-space online best fit."""

from __future__ import annotations

import math
import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from chronofold.functions import col_of
from chronofold.llm.batches import small_batches
from chronofold.llm.encoder import CHUNK, encoder
from chronofold.sources.scratch import freeze

SIZE, END_ID = 1024, 2
# Bins that a task holds open: the memory of a task, some 10 MB. A task gets about twice as many pieces.
OPEN_BINS = 1 << 16
PIECES = 2 * OPEN_BINS


class Bins:
    """At most ``most`` open bins; a bit is set for each amount of free space that some bin has."""

    def __init__(self, size: int = SIZE, most: int = OPEN_BINS) -> None:
        self.size, self.most = size, most
        self.waiting: list[deque[int]] = [deque() for _ in range(size + 1)]
        self.bits = self.open = self.made = 0

    def _take(self, free: int) -> int:
        """The oldest bin with so much free space, no longer open."""
        number = self.waiting[free].popleft()
        if not self.waiting[free]:
            self.bits ^= 1 << free
        self.open -= 1
        return number

    def place(self, length: int) -> tuple[int, int]:
        """The bin, and the place in it, of a piece: the fullest open bin that can hold it, or a new one.

        A full bin closes at once. Where more than ``most`` are open, the fullest closes.
        """
        fitting = self.bits >> length
        if fitting:
            free = length + (fitting & -fitting).bit_length() - 1
            number = self._take(free)
        else:
            free, number = self.size, self.made
            self.made += 1
        left = free - length
        if left:
            if not self.waiting[left]:
                self.bits |= 1 << left
            self.waiting[left].append(number)
            self.open += 1
            if self.open > self.most:
                self._take((self.bits & -self.bits).bit_length() - 1)
        return number, self.size - free


def cut(total: int, size: int) -> list[tuple[int, int]]:
    """Start and length of the pieces of so many ids; the first has what is over."""
    first = total % size or size
    return [(0, first), *((start, size) for start in range(first, total, size))]


def pieces(
    df: DataFrame, tokenizer: str, size: int = SIZE, end_id: int = END_ID, text: str = "text", key: str = "doc_id",
    ids: bool = False,
) -> DataFrame:
    """The ids of each row's text and ``end_id``, in pieces of at most ``size``.

    Returns key, piece, start, length, ids_crc32 and, if asked for, ids. A null text is an empty one, and its
    piece is ``end_id`` alone. Rows with one key, or none, are documents of their own.
    """
    kind = df.schema[key].dataType.simpleString()
    schema = f"key {kind}, piece int, start bigint, length bigint, ids_crc32 bigint" + (", ids array<int>" if ids else "")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(tokenizer)
        for batch in batches:
            texts, done = batch.column(1).to_pylist(), 0
            while done < len(texts):
                run, held = [], 0
                while done + len(run) < len(texts) and (not run or held < CHUNK):
                    run.append(texts[done + len(run)] or "")
                    held += len(run[-1])
                yield _cut_up(batch.column(0).slice(done, len(run)), *coder.encode(run), size, end_id, ids)
                done += len(run)

    slim = df.select(col_of(key).alias("key"), col_of(text).alias("text"))
    with small_batches(df.sparkSession):
        return freeze(slim.mapInArrow(encode, schema))


def _cut_up(keys: pa.Array, coded: np.ndarray, counts: np.ndarray, size: int, end_id: int, ids: bool) -> pa.RecordBatch:
    coded = np.insert(coded, np.cumsum(counts), end_id).astype("<u4", copy=False)
    raw, at, row, piece, starts, lengths = memoryview(coded).cast("B"), 0, [], [], [], []
    for i, total in enumerate((counts + 1).tolist()):
        for number, (start, length) in enumerate(cut(total, size)):
            row.append(i)
            piece.append(number)
            starts.append(start)
            lengths.append(length)
    # pieces lie in a row, as texts do
    ends = np.cumsum(lengths).tolist()
    sums = [zlib.crc32(raw[4 * at : 4 * end]) for at, end in zip([0, *ends], ends)]
    columns = {
        "key": keys.take(pa.array(row, pa.int64())),
        "piece": pa.array(piece, pa.int32()),
        "start": pa.array(starts, pa.int64()),
        "length": pa.array(lengths, pa.int64()),
        "ids_crc32": pa.array(sums, pa.int64()),
    }
    if ids:
        columns["ids"] = pa.ListArray.from_arrays(pa.array([0, *ends], pa.int32()), pa.array(coded.astype(np.int32)))
    return pa.RecordBatch.from_pydict(columns)


def pack(cut_up: DataFrame, size: int = SIZE, most: int = OPEN_BINS) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to pieces with a ``length`` of at most ``size``.

    Pieces are dealt out evenly and each task packs its own, so no task grows with the table; what tasks could
    have packed together is under a bin's worth for each task and length. A task gets its pieces longest first.
    Numbers of sequences are unique, but not gapless.
    """
    rows = cut_up.count()
    tasks = max(1, math.ceil(rows / PIECES))
    order = [F.col("length").desc(), *(F.col(c) for c in cut_up.columns if c not in ("length", "ids"))]
    # by value, so that the same pieces are always packed alike
    dealt = cut_up.repartition(tasks).sortWithinPartitions(*order)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in cut_up.schema)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins, first = Bins(size, most), TaskContext.get().partitionId() << 32
        for batch in batches:
            at = [bins.place(length) for length in batch.column("length").to_pylist()]
            placed = {
                "sequence_id": pa.array([first + number for number, _ in at], pa.int64()),
                "offset": pa.array([offset for _, offset in at], pa.int64()),
            }
            yield pa.RecordBatch.from_arrays([*batch.columns, *placed.values()], [*batch.schema.names, *placed])

    return dealt.mapInArrow(place, f"{schema}, sequence_id bigint, offset bigint")


def pack_documents(
    df: DataFrame, tokenizer: str, size: int = SIZE, end_id: int = END_ID, text: str = "text", key: str = "doc_id",
    ids: bool = False,
) -> DataFrame:
    """Cut documents into pieces and pack them: see ``pieces`` and ``pack``. An empty table has no pieces."""
    return pack(pieces(df, tokenizer, size, end_id, text, key, ids), size)


def sequences(packed: DataFrame) -> DataFrame:
    """The ids of each sequence in order, from pieces packed with their ids."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda p: p["ids"])).alias("ids"))
