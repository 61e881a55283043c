"""Which ids of two tokenizers stand for the same text, counted over a corpus.

Tokens of A and B that end at one byte are linked. Where one token of A covers the very bytes of one of B,
and B's is the id that A's maps to, the link is a number in a vector as long as A's vocabulary. Only
links of other groups are shuffled as pairs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from chronofold.functions import col_of
from chronofold.llm.batches import small_batches
from chronofold.llm.encoder import CHUNK, byte_letters, encoder
from chronofold.sources.scratch import freeze

# Pairs with at least one in so many of all links are known to every task; there are no more than that.
COMMON = 1 << 17
SPACE = "▁"


@dataclass
class Vocabulary:
    """Bytes and their number by id."""

    tokens: list[bytes]
    lengths: np.ndarray


def _vocabulary(tokens: list[bytes]) -> Vocabulary:
    if not all(tokens):
        raise ValueError("a token without bytes can't be aligned")
    return Vocabulary(tokens, np.fromiter(map(len, tokens), np.int64, len(tokens)))


class Pair:
    """Both tokenizers of a worker."""

    def __init__(self, a: str, b: str) -> None:
        from sentencepiece import SentencePieceProcessor

        self.encoder, self.b = encoder(a), SentencePieceProcessor(model_file=b)
        byte = {ord(letter): value for value, letter in enumerate(byte_letters())}
        known = {i: t for t, i in self.encoder.tokenizer.get_vocab().items()}
        # a special token is no byte-level text; it is never met
        written = [known.get(i) or "?" for i in range(max(known, default=-1) + 1)]
        self.a_words = _vocabulary([bytes([byte[ord(c)] for c in t]) if all(ord(c) in byte for c in t) else t.encode() for t in written])
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_words = _vocabulary(
            [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(SPACE, " ").encode() for i, p in enumerate(pieces)]
        )
        # pieces before single bytes, as one byte can have both
        of = {self.b_words.tokens[i]: i for i in sorted(range(len(pieces)), key=self.b.is_byte, reverse=True)}
        self.same = np.array([of.get(t, -1) for t in self.a_words.tokens], np.int64)
        most = max(len(self.a_words.tokens), len(pieces))
        self.numbers = [np.array([f"{i}{end}" for i in range(most)], object) for end in ",|;"]

    def encode(self, texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray] | None]:
        """Ids of both for each text; none if the text is empty or either doesn't give it back."""
        ids, counts = self.encoder.encode([f" {t}" for t in texts])
        for text, own, other in zip(texts, np.split(ids, np.cumsum(counts)[:-1]), self.b.encode(texts, num_threads=1)):
            whole = f" {text}".encode()
            back = (b"".join(map(w.tokens.__getitem__, i)) for w, i in ((self.a_words, own.tolist()), (self.b_words, other)))
            yield (own.astype(np.int64), np.array(other, np.int64)) if text and all(x == whole for x in back) else None

    def groups(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Indices of the last token of A and of B in each group."""
        ends, others = np.cumsum(self.a_words.lengths[a]), np.cumsum(self.b_words.lengths[b])
        place = np.searchsorted(others, ends)
        last = np.flatnonzero(others[place] == ends)
        return last, place[last]

    def written(self, a: np.ndarray, b: np.ndarray, last: np.ndarray, other: np.ndarray) -> str:
        """The groups as ``a1,a2|b1;a3|b2,b3``."""
        comma, bar, semicolon = self.numbers
        parts = np.empty(len(a) + len(b), object)
        a_texts, b_texts = comma[a], comma[b]
        a_texts[last], b_texts[other] = bar[a[last]], semicolon[b[other]]
        # a group's tokens of A come before its tokens of B
        a_sizes, b_sizes = np.diff(last, prepend=-1), np.diff(other, prepend=-1)
        parts[np.arange(len(a)) + np.repeat(other + 1 - b_sizes, a_sizes)] = a_texts
        parts[np.arange(len(b)) + np.repeat(last + 1, b_sizes)] = b_texts
        return "".join(parts.tolist())[:-1]


@lru_cache(maxsize=2)
def tokenizers(a: str, b: str) -> Pair:
    return Pair(a, b)


_ALIGNED = (
    "row bigint, key {}, n_a bigint, n_b bigint, n_groups bigint, {}"
    "ids array<int>, id_counts array<int>, pairs array<bigint>, pair_counts array<int>"
)


def _lists(parts: list[np.ndarray], kind: type) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, parts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.zeros(0, kind), *parts]).astype(kind)))


def align(df: DataFrame, a: str, b: str, text: str = "text", key: str = "doc_id", groups: bool = False) -> DataFrame:
    """Tokens, groups and links of each text, written to the shared folder.

    ``a`` is a byte-level tokenizers file, ``b`` a sentencepiece model that puts a space first. Returns a row for
    each row: ``row`` (a number of its own), key, n_a, n_b, n_groups, groups_sha256, the mapped ids of plain
    one-to-one groups with their counts, the pairs (A's id times 2**32 plus B's) of other links with theirs, and
    the groups as text if asked for. Null and empty texts, and those that a tokenizer changes, have no tokens.
    """
    fields = "groups_sha256 string, " + ("groups string, " if groups else "")
    schema = _ALIGNED.format(df.schema[key].dataType.simpleString(), fields)

    def rows(texts: list[str]) -> dict:
        both, none = tokenizers(a, b), np.zeros(0, np.int64)
        out: dict[str, list] = {c: [] for c in ("n_a", "n_b", "n_groups", "said", "ids", "id_counts", "pairs", "pair_counts")}
        for found in both.encode(texts):
            if found is None:
                values = (0, 0, 0, "", none, none, none, none)
            else:
                own, other = found
                last, last_b = both.groups(own, other)
                x, y = own[last], other[last_b]
                plain = (np.diff(last, prepend=-1) == 1) & (np.diff(last_b, prepend=-1) == 1) & (both.same[x] == y)
                ids = np.unique(x[plain], return_counts=True)
                pairs = np.unique((x[~plain] << 32) | y[~plain], return_counts=True)
                values = (len(own), len(other), len(last), both.written(own, other, last, last_b), *ids, *pairs)
            for column, value in zip(out.values(), values):
                column.append(value)
        return out

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 33
        for batch in batches:
            texts, done = batch.column(1).to_pylist(), 0
            while done < len(texts):
                run, held = [], 0
                while done + len(run) < len(texts) and (not run or held < CHUNK):
                    run.append(texts[done + len(run)] or "")
                    held += len(run[-1])
                got = rows(run)
                said = got.pop("said")
                columns = {
                    "row": pa.array(np.arange(row, row + len(run))),
                    "key": batch.column(0).slice(done, len(run)),
                    **{c: pa.array(got[c], pa.int64()) for c in ("n_a", "n_b", "n_groups")},
                    "groups_sha256": pa.array([hashlib.sha256(s.encode()).hexdigest() if s else "" for s in said]),
                    **({"groups": pa.array(said)} if groups else {}),
                    "ids": _lists(got["ids"], np.int32),
                    "id_counts": _lists(got["id_counts"], np.int32),
                    "pairs": _lists(got["pairs"], np.int64),
                    "pair_counts": _lists(got["pair_counts"], np.int32),
                }
                yield pa.RecordBatch.from_pydict(columns)
                row, done = row + len(run), done + len(run)

    slim = df.select(col_of(key).alias("key"), col_of(text).alias("text"))
    with small_batches(df.sparkSession):
        return freeze(slim.mapInArrow(work, schema))


def link_counts(aligned: DataFrame, a: str, b: str) -> DataFrame:
    """How many links of the corpus hold each pair of ids: pair, n, plain (met in a plain group), and best.

    ``best`` says that no other id of A is linked to the pair's B id more often. A task adds up plain links in
    a vector of A's vocabulary, and sends each pair of other links at most once for each batch.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        same = tokenizers(a, b).same
        vector = np.zeros(len(same), np.int64)

        def out(pairs: np.ndarray, n: np.ndarray, plain: bool) -> pa.RecordBatch:
            columns = {"pair": pa.array(pairs), "n": pa.array(n), "plain": pa.array([plain] * len(n), pa.bool_())}
            return pa.RecordBatch.from_pydict(columns)

        for batch in batches:
            ids, id_counts, pairs, pair_counts = (c.flatten().to_numpy(zero_copy_only=False) for c in batch.columns)
            np.add.at(vector, ids, id_counts)
            known, place = np.unique(pairs, return_inverse=True)
            yield out(known.astype(np.int64), np.bincount(place, pair_counts, len(known)).astype(np.int64), False)
        met = np.flatnonzero(vector)
        yield out((met << 32) | same[met], vector[met], True)

    lists = aligned.select("ids", "id_counts", "pairs", "pair_counts")
    sums = (
        lists.mapInArrow(count, "pair bigint, n bigint, plain boolean")
        .groupBy("pair").agg(F.sum("n").alias("n"), F.max("plain").alias("plain"))
    )
    counts = freeze(sums.withColumn("b", F.col("pair").bitwiseAND(F.lit((1 << 32) - 1))))
    # a row for each id of B's vocabulary
    most = counts.groupBy("b").agg(F.max("n").alias("most"))
    return freeze(
        counts.join(F.broadcast(most), "b").select("pair", "n", "plain", (F.col("n") == F.col("most")).alias("best"))
    )


def _known(counts: DataFrame, vocabulary: int) -> tuple[np.ndarray, ...]:
    """Counts and marks by id of A for plain pairs, and the common pairs in order with theirs."""
    total = counts.agg(F.sum("n")).first()[0] or 0
    # at most COMMON pairs and one plain pair for each id of A
    rows = counts.where(F.col("plain") | (F.col("n") * COMMON >= total)).toArrow()
    pair, n, plain, best = (rows.column(c).to_numpy() for c in ("pair", "n", "plain", "best"))
    of_id, best_id = np.zeros(vocabulary, np.int64), np.zeros(vocabulary, bool)
    of_id[pair[plain] >> 32], best_id[pair[plain] >> 32] = n[plain], best[plain]
    order = np.argsort(pair)
    return of_id, best_id, pair[order], n[order], best[order]


def score_links(aligned: DataFrame, counts: DataFrame, a: str, b: str) -> DataFrame:
    """Adds n_links, n_best and count_sum to the rows of ``align``.

    ``n_best``: links whose count is the highest of their B id, ties included; ``count_sum``: the sum of the counts
    of a row's links. Tasks know plain and common pairs; only links of rare pairs, none of which has more than one in
    ``COMMON`` of all links, are joined with the counts.
    """
    spark = aligned.sparkSession
    known = spark.sparkContext.broadcast(_known(counts, len(tokenizers(a, b).same)))
    fields = [f for f in aligned.schema if f.name not in ("ids", "id_counts", "pairs", "pair_counts")]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of_id, best_id, common, of_common, best_common = known.value
        for batch in batches:
            ids, id_counts, pairs, pair_counts = (
                batch.column(c).flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                for c in ("ids", "id_counts", "pairs", "pair_counts")
            )
            id_row, pair_row = (
                np.repeat(np.arange(len(batch)), np.asarray(batch.column(c).value_lengths(), np.int64))
                for c in ("ids", "pairs")
            )
            place = np.minimum(np.searchsorted(common, pairs), max(0, len(common) - 1))
            found = common[place] == pairs if len(common) else np.zeros(len(pairs), bool)
            sums = np.zeros((3, len(batch)), np.int64)
            here, at = pair_row[found], place[found]
            for row, n, times, best in (
                (id_row, of_id[ids], id_counts, best_id[ids]),
                (here, of_common[at], pair_counts[found], best_common[at]),
            ):
                np.add.at(sums[0], row, times)
                np.add.at(sums[1], row, times * best)
                np.add.at(sums[2], row, times * n)
            np.add.at(sums[0], pair_row[~found], pair_counts[~found])
            ends = np.concatenate([[0], np.cumsum(np.bincount(pair_row[~found], minlength=len(batch)))]).astype(np.int32)
            columns = {f.name: batch.column(f.name) for f in fields}
            columns |= {c: pa.array(s) for c, s in zip(("n_links", "n_best", "count_sum"), sums)}
            columns["rest"] = pa.ListArray.from_arrays(pa.array(ends), pa.array(pairs[~found]))
            columns["times"] = pa.ListArray.from_arrays(pa.array(ends), pa.array(pair_counts[~found]))
            yield pa.RecordBatch.from_pydict(columns)

    added = "n_links bigint, n_best bigint, count_sum bigint, rest array<bigint>, times array<bigint>"
    scored = freeze(aligned.mapInArrow(score, f"{schema}, {added}"))
    rare = scored.select("row", F.explode(F.arrays_zip("rest", "times")).alias("link"))
    rare = rare.select("row", F.col("link.rest").alias("pair"), F.col("link.times").alias("times"))
    sums = (
        rare.join(counts.select("pair", "n", "best"), "pair")
        .groupBy("row")
        .agg(
            F.sum(F.col("times") * F.col("n")).alias("_sum"),
            F.sum(F.col("times") * F.col("best").cast("long")).alias("_best"),
        )
    )
    return (
        scored.drop("rest", "times")
        .join(sums, "row", "left")
        .withColumn("n_best", F.col("n_best") + F.coalesce("_best", F.lit(0)))
        .withColumn("count_sum", F.col("count_sum") + F.coalesce("_sum", F.lit(0)))
        .drop("_best", "_sum")
    )


def align_corpus(df: DataFrame, a: str, b: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Align each text, count links over all of them, and score each row's links by those counts."""
    aligned = align(df, a, b, text, key)
    return score_links(aligned, link_counts(aligned, a, b), a, b)
