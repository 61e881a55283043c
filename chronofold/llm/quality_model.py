"""Quality classifier: hashed word and character n-gram vectors, averaged per text, softmax output.

The vectors and the output layer are learned by stochastic gradient descent in numpy on a
bounded sample of labelled texts. As the output is linear in the averaged vector, each
feature's vector is reduced to one number after training; scoring a text is a mean of numbers.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from chronofold.functions import col_of
from chronofold.llm.batches import small_batches, use_small_batches
from chronofold.llm.words import SPACED, U, mix, slices, text_bytes, words_of
from chronofold.sources.scratch import freeze

# Labelled texts that the model learns from at most, and bytes of their bags that come to the driver.
SAMPLE = 2_500
SAMPLE_BYTES = 40 * 1024 * 1024
BITS = 17
GROUPS = 3
DIM = 8
EPOCHS = 6
RATE = 0.4
THRESHOLD = 0.3
CHARS = (2, 3, 4)
# Bytes of text that are scored at once, at some 50 bytes of memory for each; a longer text is scored on its own.
SLICE_BYTES = 1 << 18
_AGAIN = U(0x5851F42D4C957F2D)


def features(data: np.ndarray, at: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Group of features, buckets in order of place, and where each text's buckets begin.

    The groups are words, pairs of words and character n-grams (bytes of UTF-8, spaces
    included), the last in one part for each n. A word that repeats the one before it is replaced by a mark,
    so that repetition of any word is one feature.
    """
    shift = U(64 - BITS)
    words = words_of(data, at, SPACED, fold=False)
    tokens = words.hashes.copy()
    if len(tokens) > 1:
        again = words.hashes[1:] == words.hashes[:-1]
        edge = words.first[(words.first > 0) & (words.first < len(tokens))]
        again[edge - 1] = False
        tokens[1:][again] = _AGAIN
    yield 0, (tokens >> shift).astype(np.int32), words.first
    pairs = mix(tokens[:-1] * U(3) + tokens[1:]) if len(tokens) > 1 else tokens[:0]
    inside = np.ones(len(pairs), bool)
    edge = words.first[(words.first > 0) & (words.first < len(tokens))]
    inside[edge - 1] = False
    before = np.concatenate([[0], np.cumsum(inside)])
    yield 1, (pairs[inside] >> shift).astype(np.int32) + np.int32(1 << BITS), before[np.minimum(words.first, len(pairs))]
    wide, sizes = data.astype(np.uint32), np.diff(at)
    gram = wide
    for n in range(2, max(CHARS) + 1):
        gram = (gram[:-1] << np.uint32(8)) | wide[n - 1 :]
        if n in CHARS:
            hashed = gram * np.uint32(0x9E3779B1) ^ np.uint32((n * 0x85EBCA6B) & 0xFFFFFFFF)
            hashed ^= hashed >> np.uint32(15)
            hashed *= np.uint32(0x2C1B3C6D)
            hashed >>= np.uint32(32 - BITS)
            # the last n - 1 bytes of a text begin none
            whole = np.ones(len(data), bool)
            for back in range(1, n):
                whole[at[1:][sizes >= back] - back] = False
            starts = np.concatenate([[0], np.cumsum(np.maximum(sizes - (n - 1), 0))])
            yield 2, hashed[whole[: len(hashed)]].view(np.int32) + np.int32(2 << BITS), starts


def bag(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The different buckets of a text and how often it has each."""
    found = [b for _, b, _ in features(np.frombuffer(text, np.uint8), np.array([0, len(text)]))]
    ids, counts = np.unique(np.concatenate(found), return_counts=True)
    return ids.astype(np.int32), counts.astype(np.int32)


def shares_of(ids: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """What each bucket counts for in a text's mean; each group of features weighs the same."""
    group = ids >> BITS
    sums = np.bincount(group, counts, GROUPS)
    return counts / (sums[group] * GROUPS)


@dataclass
class Model:
    """A number for each feature and one for all texts; their logistic value is the score."""

    weights: np.ndarray
    bias: float

    def scores(self, data: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Scores of texts; each is summed on its own, so it doesn't depend on its neighbours."""
        sums, counts = np.zeros((2, GROUPS, len(at) - 1))
        for group, buckets, starts in features(data, at):
            met = np.diff(starts)
            some = np.flatnonzero(met)
            if len(some):
                sums[group, some] += np.add.reduceat(self.weights[buckets], starts[some])
                counts[group] += met
        logit = self.bias + (sums / np.maximum(counts, 1)).sum(0) / GROUPS
        return 1 / (1 + np.exp(-logit))


def train(bags: list[tuple[np.ndarray, np.ndarray, int]], seed: int = 7) -> Model:
    """Learn from texts given as buckets, counts and label; the order is drawn from the seed."""
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / DIM, 1 / DIM, (GROUPS << BITS, DIM))
    out, bias = np.zeros((2, DIM)), np.zeros(2)
    steps, step = max(1, EPOCHS * len(bags)), 0
    for _ in range(EPOCHS):
        for k in rng.permutation(len(bags)):
            ids, counts, label = bags[k]
            shares = shares_of(ids, counts)
            rate = RATE * (1 - step / steps)
            step += 1
            rows = vectors[ids]
            mean = shares @ rows
            logits = out @ mean + bias
            p = np.exp(logits - logits.max())
            p /= p.sum()
            p[label] -= 1
            back = p @ out
            out -= rate * np.outer(p, mean)
            bias -= rate * 0.1 * p
            # shares are small; a text's features learn as much as one feature would
            vectors[ids] = rows - rate * np.outer(shares * len(ids) ** 0.5, back)
    direction = out[1] - out[0]
    return Model((vectors @ direction).astype(np.float64), float(bias[1] - bias[0]))


def held_out(key: Column) -> Column:
    """Rows that are never learned from: a fifth, by the checksum of the key; also null keys."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def fit(
    documents: DataFrame,
    labels: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    label: str = "quality",
    sample: int = SAMPLE,
    sample_bytes: int = SAMPLE_BYTES,
) -> Model:
    """Learn from at most ``sample`` labelled keys that are not held out, picked by hash.

    Rows without a label of 0 or 1 don't count; several labels of a key count as the smallest, and of several texts
    that with the smallest digest is learned from. Of the picked keys, in the order of their hashes, those count whose bags
    of features are ``sample_bytes`` together at most. Without any labelled row every score is a half.
    """
    known = (
        labels.where(col_of(label).isin(0, 1) & ~held_out(col_of(key)))
        .groupBy(col_of(key).alias("_key"))
        .agg(F.min(col_of(label)).cast("int").alias("_label"))
    )
    order = F.md5(F.col("_key").cast("string"))
    picked = F.broadcast(known.orderBy(order, "_key").limit(sample))
    rows = documents.select(col_of(key).alias("_key"), col_of(text).alias("_text")).join(picked, "_key")
    # one row for each key, combined where the rows are, before anything is sent
    rows = rows.groupBy("_key", "_label").agg(F.min_by("_text", F.sha2(F.coalesce("_text", F.lit("")), 256)).alias("_text"))

    def bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [bag((t or "").encode()) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).cast(pa.string()),
                    batch.column(2),
                    pa.array([i.tobytes() for i, _ in found], pa.binary()),
                    pa.array([c.astype(np.uint16 if c.max(initial=0) < 1 << 16 else np.int32).tobytes() for _, c in found], pa.binary()),
                ],
                names=["k", "y", "i", "c"],
            )

    with small_batches(documents.sparkSession):
        made = freeze(rows.select("_key", "_text", "_label").mapInArrow(bags, "k string, y int, i binary, c binary"))
    # a number for each of at most ``sample`` rows
    upto = F.sum(F.octet_length("i") + F.octet_length("c")).over(Window.orderBy(F.md5("k"), "k"))
    sizes = made.select("k", upto.alias("upto")).where(F.col("upto") <= sample_bytes)
    got = made.join(F.broadcast(sizes.select("k")), "k").toArrow().sort_by("k")
    learned = []
    for y, i, c in zip(*(got.column(name) for name in ("y", "i", "c"))):
        ids, counts = np.frombuffer(i.as_buffer(), np.int32), c.as_buffer()
        learned.append((ids, np.frombuffer(counts, np.uint16 if counts.size == 2 * len(ids) else np.int32), y.as_py()))
    return train(learned)


def score(df: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``df`` with ``score`` (0 to 1, higher: better) and ``predicted`` (1 from the threshold on).

    Only the text is looked at, all of it. Null and empty texts get the score of a text without features.
    ``keep`` names the columns to return besides (default: all); one that has the name of an
    added column is replaced. Whole texts go to Python workers, so the session's batches of rows for them are
    made small.
    """
    use_small_batches(df.sparkSession)
    names = [c for c in df.columns if c not in ("score", "predicted")]
    kept = [c for c in (names if keep is None else keep) if c in names]
    df = df.select(*[col_of(c) for c in kept], col_of(text).alias("_scored_text"))
    schema = T.StructType([*df.schema.fields[:-1], T.StructField("score", T.DoubleType())])
    shared = df.sparkSession.sparkContext.broadcast(model)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, at = text_bytes(batch.column(len(kept)))
            for i, j in slices(at, SLICE_BYTES):
                found = shared.value.scores(data[at[i] : at[j]], at[i : j + 1] - at[i])
                rows = [column.slice(i, j - i) for column in batch.columns[:-1]]
                yield pa.RecordBatch.from_arrays([*rows, pa.array(found, pa.float64())], names=schema.names)

    return df.mapInArrow(add, schema).withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
