"""Similarity self-join of texts on word n-grams by chosen paths.

Every text becomes a set of hashed shingles, and a signature of ``T`` min-hashes of it. A run splits
the sets recursively: at each node of the tree some of the ``T`` places are chosen at random (1 /
similarity of them on average), and a set goes down each branch named by its value there. Sets as similar as
asked for stay together on some path with a known probability; runs are repeated until the chance
to lose a pair is below ``1 - recall``. Buckets of at most ``SMALL`` sets are compared pair by pair. A bucket that
stays large is dense. If its sets resemble one another it is cut into blocks, and every two of its blocks are compared
in a task of their own. If they only share a part, as pages of one template do, its sets go through deeper trees,
as many as these need for the same recall. Similar pairs are always verified on the shingles themselves.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from chronofold.functions import col_of
from chronofold.llm.batches import small_batches
from chronofold.llm.components import components
from chronofold.llm.words import SPACED, U, Words, mix, slices, text_bytes, words_of
from chronofold.operators.sizing import broadcast_if, measure
from chronofold.sources.scratch import freeze

WIDTH = 5
SIMILARITY = 0.8
RECALL = 0.999
# Places of a signature, sets of a bucket that are compared pair by pair, levels of the first trees and of the last ones.
T = 64
SMALL = 24
LEVELS = 3
DEEPEST = 12
# A dense bucket of more sets than WIDE goes through deeper trees, if its sets agree in less than this share of the
# similarity asked for. Below that size comparing all is cheaper.
WIDE = 16384
ALIKE = 0.6
# Sets and bytes of shingles in a block of a dense bucket, sets that are gathered at once, columns of a matrix.
ROWS = 3072
BLOCK_BYTES = 8 * 1024 * 1024
PIECE = 256
COLUMNS = 2048
# Standard errors by which an estimate may fall short of the similarity asked for.
SLACK = 5
# Ids and keys up to this size are broadcast.
SEND_BYTES = 16 * 1024 * 1024
SEED = U(0x1F83D9ABFB41BD6B)

_FACTOR = mix(np.arange(1, T + 1, dtype=U) * SEED) | U(1)
_ADDED = mix(np.arange(T + 1, 2 * T + 1, dtype=U) * SEED)


def runs_for(recall: float, similarity: float = SIMILARITY, levels: int = LEVELS) -> int:
    """Runs that find a pair of the given similarity with the wanted probability.

    A pair survives a level when a chosen place has the same value for both; on average one
    such place is chosen, so the chance follows that of a branching process. All runs share one
    signature, so the chance is averaged over the number of its places that agree.
    """
    agree = np.arange(T + 1)
    weight = np.array([math.comb(T, m) * similarity**m * (1 - similarity) ** (T - m) for m in agree])
    survives = np.ones(T + 1)
    for _ in range(levels):
        survives = 1 - (1 - chance(similarity) * survives) ** agree
    if weight @ (survives == 0) >= 1 - recall:
        raise ValueError(f"signatures of {T} places are too short to find {recall} of pairs of similarity {similarity}")
    runs = 1
    while weight @ (1 - survives) ** runs > 1 - recall:
        runs += 1
    return runs


def chance(similarity: float) -> float:
    """Of a place to be chosen: 1 / similarity of them are on average."""
    return min(1.0, 1 / (similarity * T))


def shingles(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different shingles of each text in order, and where each text's begin.

    A text of one to four words has one shingle, of all its words.
    """
    words = words_of(data, at, SPACED)
    first, hashed = words.windows(WIDTH)
    some, short = words.short(WIDTH)
    if len(some):
        first, hashed = np.concatenate([first, some]), np.concatenate([hashed, short])
    text = np.searchsorted(words.first, first, side="right") - 1
    order = np.argsort(hashed)
    order = order[np.argsort(text[order], kind="stable")]
    hashed, text = hashed[order], text[order]
    new = np.ones(len(hashed), bool)
    new[1:] = (hashed[1:] != hashed[:-1]) | (text[1:] != text[:-1])
    hashed, text = hashed[new], text[new]
    return hashed, np.searchsorted(text, np.arange(len(at)))


def digests(hashed: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits that name each set, the same for equal sets; 0 for the empty one."""
    out = []
    some = np.flatnonzero(np.diff(starts))
    for k in (U(0x6A09E667F3BCC909), U(0xBB67AE8584CAA73B)):
        sums = np.zeros(len(starts) - 1, U)
        if len(some):
            sums[some] = np.add.reduceat(mix(hashed * k + k), starts[some])
        out.append(sums.view(np.int64))
    return out[0], out[1]


def signatures(hashed: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Min-hash signatures; those of empty sets are zero."""
    out = np.zeros((len(starts) - 1, T), np.uint32)
    some = np.flatnonzero(np.diff(starts))
    if len(some):
        at = starts[some]
        for i in range(T):
            values = ((hashed * _FACTOR[i] + _ADDED[i]) >> U(32)).astype(np.uint32)
            out[some, i] = np.minimum.reduceat(values, at)
    return out


def sketched(df: DataFrame, text: str, key: str) -> DataFrame:
    """key, digest, size and signature of each row."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, at = text_bytes(batch.column(1))
            for i, j in slices(at):
                hashed, starts = shingles(data[at[i] : at[j]], at[i : j + 1] - at[i])
                h1, h2 = digests(hashed, starts)
                rows = signatures(hashed, starts)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(i, j - i),
                        pa.array(h1),
                        pa.array(h2),
                        pa.array(np.diff(starts)),
                        pa.array([r.tobytes() for r in rows], pa.binary()),
                    ],
                    names=["key", "h1", "h2", "n", "sig"],
                )

    kind = df.schema[key].dataType.simpleString()
    slim = df.select(col_of(key).alias("key"), col_of(text).alias("t"))
    return slim.mapInArrow(sketch, f"key {kind}, h1 bigint, h2 bigint, n bigint, sig binary")


def matrix(column: pa.Array, n: int) -> np.ndarray:
    """Signatures of an Arrow column as rows of a matrix."""
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(n, T)


def branch(paths: np.ndarray, place: int, values: np.ndarray) -> np.ndarray:
    return mix((paths ^ _FACTOR[place]) * U(0x9E3779B97F4A7C15) + values.astype(U) + (U(place) << U(40)))


def chosen(paths: np.ndarray, place: int, similarity: float = SIMILARITY) -> np.ndarray:
    """Whether the place is chosen at the node that a path leads to: 1 / similarity of T are."""
    return mix(paths * _FACTOR[place] + _ADDED[place]) <= U(min(2**64 - 1, int(2**64 * chance(similarity))))


def first_level(nodes: DataFrame, runs: int, similarity: float, done: int = 0) -> DataFrame:
    """Bucket and node for every branch that leaves the root, in every run; ``done`` runs were made before."""
    roots = mix(np.arange(done + 1, done + runs + 1, dtype=U) * SEED)
    steps = [(root, i) for root in roots for i in range(T) if chosen(np.array([root]), i, similarity)[0]]

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sigs = matrix(batch.column(1), len(batch))
            ids = batch.column(0).to_numpy()
            for root, i in steps:
                path = branch(np.full(len(ids), root, U), i, sigs[:, i])
                yield pa.RecordBatch.from_arrays([pa.array(path.view(np.int64)), pa.array(ids)], names=["path", "node"])

    return nodes.select("node", "sig").mapInArrow(split, "path bigint, node bigint")


def next_level(records: DataFrame, similarity: float) -> DataFrame:
    """The branches below the buckets of ``records`` (path, node, sig)."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths = batch.column(0).to_numpy().view(U)
            ids = batch.column(1).to_numpy()
            sigs = matrix(batch.column(2), len(batch))
            for i in range(T):
                go = np.flatnonzero(chosen(paths, i, similarity))
                if len(go):
                    path = branch(paths[go], i, sigs[go, i])
                    yield pa.RecordBatch.from_arrays([pa.array(path.view(np.int64)), pa.array(ids[go])], names=["path", "node"])

    return records.select("path", "node", "sig").mapInArrow(split, "path bigint, node bigint")


def least_estimate(similarity: float) -> float:
    return similarity - SLACK * math.sqrt(similarity * (1 - similarity) / T)


def pairs_in_buckets(records: DataFrame, similarity: float) -> DataFrame:
    """Pairs of nodes that share a small bucket and look similar by signature."""
    least = math.ceil(least_estimate(similarity) * T)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

        def emit(paths, ids, sigs):
            starts = np.flatnonzero(np.concatenate([[True], paths[1:] != paths[:-1], [True]]))
            found_a, found_b = [], []
            size = np.diff(starts)
            # pairs at distance 1, 2, ... in a bucket, all buckets at once
            for step in range(1, int(size.max())):
                left = np.flatnonzero(paths[:-step] == paths[step:])
                same = (sigs[left] == sigs[left + step]).sum(axis=1) >= least
                left = left[same]
                found_a.append(ids[left])
                found_b.append(ids[left + step])
            if found_a:
                a, b = np.concatenate(found_a), np.concatenate(found_b)
                both = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)]), axis=1)
                both = both[:, both[0] != both[1]]
                yield pa.RecordBatch.from_arrays([pa.array(both[0]), pa.array(both[1])], names=["a", "b"])

        for batch in batches:
            held.append((batch.column(0).to_numpy(), batch.column(1).to_numpy(), matrix(batch.column(2), len(batch))))
            paths, ids, sigs = (np.concatenate(x) for x in zip(*held))
            # the last bucket may go on in the next batch
            end = int(np.searchsorted(paths, paths[-1])) if len(paths) else 0
            held = [(paths[end:], ids[end:], sigs[end:])]
            if end:
                yield from emit(paths[:end], ids[:end], sigs[:end])
        if held and len(held[0][0]):
            yield from emit(*held[0])

    ordered = records.select("path", "node", "sig").repartition("path").sortWithinPartitions("path")
    return ordered.mapInArrow(compare, "a bigint, b bigint")


def shared_shingles(left: list[np.ndarray], right: list[np.ndarray]) -> tuple:
    """Shingles that sets of both sides have: how many, and (column, row) of each place where one is, by column."""
    flat = [np.concatenate(x) if x else np.zeros(0, U) for x in (left, right)]
    common = np.intersect1d(np.unique(flat[0]), np.unique(flat[1]), assume_unique=True)
    places = []
    for sets, values in zip((left, right), flat):
        rows = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
        at = np.searchsorted(common, values)
        at[at == len(common)] = 0
        is_common = common[at] == values if len(common) else np.zeros(len(values), bool)
        at, rows = at[is_common], rows[is_common]
        order = np.argsort(at, kind="stable")
        places.append((at[order], rows[order]))
    return len(common), places[0], places[1]


def products(n: int, left: tuple, right: tuple, shape: tuple[int, int]) -> np.ndarray:
    """For each row of the left and each of the right, in how many of ``n`` columns both have an entry."""
    out = np.zeros(shape, np.float32)
    for low in range(0, n, COLUMNS):
        width = min(COLUMNS, n - low)
        parts = []
        for (columns, rows), height in zip((left, right), shape):
            i, j = np.searchsorted(columns, [low, low + width])
            part = np.zeros((height, width), np.float32)
            part[rows[i:j], columns[i:j] - low] = 1
            parts.append(part)
        for i in range(0, shape[0], 512):
            out[i : i + 512] += parts[0][i : i + 512] @ parts[1].T
    return out


def jaccard(x: np.ndarray, y: np.ndarray) -> float:
    """Similarity of two sorted sets."""
    if len(x) > len(y):
        x, y = y, x
    at = np.searchsorted(y, x)
    at[at == len(y)] = 0
    both = int((y[at] == x).sum())
    return both / (len(x) + len(y) - both)


def similar_in_blocks(path: int, left: tuple, right: tuple | None, similarity: float) -> np.ndarray:
    """Which sets of the left are similar to which of the right, verified on their shingles, as a matrix.

    A side has signatures, sets of shingles and the dense buckets of each set. ``right`` is None to compare the left
    with itself, each pair once. A pair that meets in several dense buckets counts in the first one only.
    """
    sigs, sets, paths = left
    sigs2, sets2, paths2 = right or left
    shape = len(sets), len(sets2)
    before = [[x[: np.searchsorted(x, path)].view(U) for x in p] for p in (paths, paths2)]
    todo = products(*shared_shingles(*before), shape) == 0
    if right is None:
        todo = np.triu(todo, 1)
    n_todo = np.count_nonzero(todo)
    if not n_todo:
        return todo
    n, *places = shared_shingles(sets, sets2)
    work = n * shape[0] * shape[1]
    if work > 2000 * n_todo:
        # signatures are cheaper than the shingles of all
        least = math.ceil(least_estimate(similarity) * T)
        a, b = np.nonzero(todo)
        for i in range(0, n_todo, 65536):
            x, y = a[i : i + 65536], b[i : i + 65536]
            todo[x, y] = (sigs[x] == sigs2[y]).sum(axis=1) >= least
        n_todo = np.count_nonzero(todo)
        if work > 300_000 * n_todo:
            for x, y in zip(*np.nonzero(todo)):
                todo[x, y] = jaccard(sets[x], sets2[y]) >= similarity
            return todo
    both = products(n, *places, shape)
    sizes, sizes2 = np.array([len(x) for x in sets]), np.array([len(x) for x in sets2])
    for i in range(0, shape[0], 512):
        some = both[i : i + 512].astype(float)
        todo[i : i + 512] &= some / (sizes[i : i + 512, None] + sizes2 - some) >= similarity
    return todo


def spanning(like: np.ndarray, ids: np.ndarray, ids2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that keep together what the matrix of similar pairs joins, fewer than there are nodes."""
    nodes, at = np.unique(np.concatenate([ids, ids2]), return_inverse=True)
    mine, theirs = at[: len(ids)], at[len(ids) :]
    part, a, b = np.arange(len(nodes)), [], []
    for i in np.flatnonzero(like.any(axis=1)):
        near = theirs[np.flatnonzero(like[i])]
        parts, first = np.unique(part[near], return_index=True)
        for k, j in zip(parts, near[first]):
            if k != part[mine[i]]:
                part[part == k] = part[mine[i]]
                a.append(min(mine[i], j))
                b.append(max(mine[i], j))
    return nodes[np.array(a, int)], nodes[np.array(b, int)]


def blocks_of(dense: DataFrame, nodes: DataFrame, sets: DataFrame) -> DataFrame:
    """Blocks of dense buckets, a row for every two blocks of a bucket that are to be compared (path, lo, hi, sides).

    A block has at most about ``ROWS`` sets and ``BLOCK_BYTES`` of shingles. It is gathered in pieces of about ``PIECE``
    sets, so no task meets a whole bucket.
    """
    dense = dense.select("path", "node")
    sizes = dense.join(nodes.select("node", "n"), "node").groupBy("path").agg(F.count("*").alias("size"), F.sum("n").alias("n"))
    parts = F.greatest(F.ceil(F.col("size") / ROWS), F.ceil(F.col("n") * 8 / BLOCK_BYTES)).cast("int")
    sizes = sizes.select("path", parts.alias("parts"), F.ceil(F.col("size") / (parts * PIECE)).cast("int").alias("pieces"))
    places = dense.groupBy("node").agg(F.array_sort(F.collect_set("path")).alias("paths"))
    row = F.struct("node", "sig", "shingles", "paths")
    pieces = (
        dense.join(broadcast_if(measure(sizes).fits(SEND_BYTES), sizes), "path")
        .join(places.join(sets, "node").join(nodes.select("node", "sig"), "node"), "node")
        .withColumn("block", F.pmod(F.xxhash64("node", "path"), "parts").cast("int"))
        .withColumn("piece", F.pmod(F.hash("path", "node"), "pieces"))
        .groupBy("path", "parts", "block", "piece")
        .agg(F.collect_list(row).alias("rows"))
    )
    met = pieces.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    met = met.select("path", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"), "block", "rows")
    return met.groupBy("path", "lo", "hi").agg(F.collect_list(F.struct("block", "rows")).alias("sides"))


def links_in_dense(dense: DataFrame, nodes: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """All sets of each dense bucket compared with one another, block by block.

    Gives links ``a``, ``b`` that span what is similar, and for each node ``a`` of a block the ``count`` of similar sets
    it met there (``b`` null). Neither grows with the number of similar pairs.
    """

    def side(pieces: pa.ListArray, wanted: np.ndarray) -> tuple[np.ndarray, tuple]:
        rows = pa.concat_arrays([pieces[int(k)].values for k in np.flatnonzero(wanted)])
        sets = [np.frombuffer(x.as_buffer(), U) for x in rows.field("shingles")]
        paths = [x.values.to_numpy() for x in rows.field("paths")]
        return rows.field("node").to_numpy(), (matrix(rows.field("sig"), len(rows)), sets, paths)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, lo, hi, sides in zip(*(batch.column(k) for k in range(4))):
                path, lo, hi, pieces = path.as_py(), lo.as_py(), hi.as_py(), sides.values
                block = pieces.field("block").to_numpy()
                if not ((block == lo).any() and (block == hi).any()):
                    continue
                ids, left = side(pieces.field("rows"), block == lo)
                ids2, right = (ids, None) if lo == hi else side(pieces.field("rows"), block == hi)
                like = similar_in_blocks(path, left, right, similarity)
                a, b = spanning(like, ids, ids2)
                if lo == hi:
                    n = like.sum(axis=1) + like.sum(axis=0)
                else:
                    ids, n = np.concatenate([ids, ids2]), np.concatenate([like.sum(axis=1), like.sum(axis=0)])
                some = np.flatnonzero(n)
                links = [pa.array(a), pa.array(b), pa.nulls(len(a), pa.int64())]
                counts = [pa.array(ids[some]), pa.nulls(len(some), pa.int64()), pa.array(n[some])]
                yield pa.RecordBatch.from_arrays([pa.concat_arrays(x) for x in zip(links, counts)], names=["a", "b", "count"])

    with small_batches(dense.sparkSession):
        return freeze(blocks_of(dense, nodes, sets).mapInArrow(compare, "a bigint, b bigint, count bigint"))


def apart(pairs: DataFrame, dense: DataFrame) -> DataFrame:
    """The pairs that don't meet in a dense bucket."""
    places = dense.groupBy("node").agg(F.collect_set("path").alias("paths"))
    for end in ("a", "b"):
        pairs = pairs.join(places.select(F.col("node").alias(end), F.col("paths").alias(f"paths_{end}")), end, "left")
    return pairs.where(~F.coalesce(F.arrays_overlap("paths_a", "paths_b"), F.lit(False))).select("a", "b")


def agreement(records: DataFrame) -> DataFrame:
    """The share of places in which two sets of a bucket agree on average (path, agree), from ``records`` (path, node, sig).

    Each set is held against one other of its bucket. Rows are ordered by bucket and hash, so a bucket may be in many tasks.
    """

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths, sigs = batch.column(0).to_numpy(), matrix(batch.column(1), len(batch))
            left = np.flatnonzero(paths[1:] == paths[:-1])
            known, at = np.unique(paths[left], return_inverse=True)
            same = np.bincount(at, (sigs[left] == sigs[left + 1]).mean(axis=1), len(known))
            columns = [pa.array(known), pa.array(same), pa.array(np.bincount(at, minlength=len(known)))]
            yield pa.RecordBatch.from_arrays(columns, names=["path", "same", "n"])

    order = ["path", F.xxhash64("node", "path")]
    dealt = records.repartitionByRange(*order).sortWithinPartitions(*order).select("path", "sig")
    sums = dealt.mapInArrow(compare, "path bigint, same double, n bigint").groupBy("path")
    return sums.agg((F.sum("same") / F.sum("n")).alias("agree"))


def unlike(dense: DataFrame, sigs: DataFrame, similarity: float) -> DataFrame | None:
    """The dense buckets (``path``) of more than ``WIDE`` sets that are not one group of sets like one another, if any."""
    wide = freeze(dense.groupBy("path").agg(F.count("*").alias("size")).where(F.col("size") > WIDE).select("path"))
    if wide.isEmpty():
        return None
    # at most one for each WIDE records
    seen = agreement(dense.join(broadcast_if(measure(wide).fits(SEND_BYTES), wide), "path", "left_semi").join(sigs, "node").select("path", "node", "sig"))
    paths = freeze(seen.where(F.col("agree") < ALIKE * similarity).select("path"))
    return None if paths.isEmpty() else paths


def trees(nodes: DataFrame, similarity: float, runs: int, levels: int, done: int = 0) -> tuple[DataFrame, DataFrame | None]:
    """Pairs of small buckets that may be similar, from all runs; and the records of buckets dense at the last level."""
    sigs = nodes.select("node", "sig")
    found, level = None, 1
    records = freeze(first_level(nodes, runs, similarity, done))
    while True:
        sizes = records.groupBy("path").agg(F.count("*").alias("size")).where("size > 1")
        full = freeze(records.join(sizes, "path").join(sigs, "node"))
        part = pairs_in_buckets(full.where(F.col("size") <= SMALL), similarity)
        found = part if found is None else found.union(part)
        dense = full.where(F.col("size") > SMALL)
        if dense.isEmpty():
            return found, None
        if level == levels:
            return found, freeze(dense.select("path", "node"))
        records = freeze(next_level(dense, similarity))
        level += 1


def candidates(nodes: DataFrame, similarity: float, recall: float) -> tuple[DataFrame, DataFrame | None]:
    """Pairs that may be similar, each once, apart from those of dense buckets; and the records of these.

    Pairs that met in a wide bucket of unlike sets are looked for anew, in trees twice as deep over the sets of such
    buckets, whose runs reach the same recall by themselves. What is dense in the deepest ones is compared as it is.
    """
    found, kept, levels, done = None, None, LEVELS, 0
    while True:
        runs = runs_for(recall, similarity, levels)
        pairs, dense = trees(nodes, similarity, runs, levels, done)
        found = pairs if found is None else found.union(pairs)
        again = None if dense is None or levels >= DEEPEST else unlike(dense, nodes.select("node", "sig"), similarity)
        if again is not None:
            few = measure(again).fits(SEND_BYTES)
            ends = dense.join(broadcast_if(few, again), "path", "left_semi").select("node").distinct()
            nodes = freeze(nodes.join(ends, "node", "left_semi"))
            dense = dense.join(broadcast_if(few, again), "path", "left_anti")
        if dense is not None:
            kept = dense if kept is None else kept.union(dense)
        if again is None:
            break
        levels, done = 2 * levels, done + runs
    if kept is None:
        return found.distinct(), None
    return apart(found.distinct(), kept), kept


def sets_of(df: DataFrame, text: str, key: str, wanted: DataFrame) -> DataFrame:
    """The shingles of the wanted nodes (node, h1, h2, key), as sorted 64-bit hashes."""
    keys = wanted.select(F.col("key").alias("k")).distinct()
    slim = df.select(col_of(key).alias("key"), col_of(text).alias("t"))
    picked = slim.join(broadcast_if(measure(keys).fits(SEND_BYTES), keys), slim["key"].eqNullSafe(keys["k"]), "left_semi")

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, at = text_bytes(batch.column(0))
            for i, j in slices(at):
                hashed, starts = shingles(data[at[i] : at[j]], at[i : j + 1] - at[i])
                h1, h2 = digests(hashed, starts)
                sets = [hashed[a:b].tobytes() for a, b in zip(starts[:-1], starts[1:])]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h1), pa.array(h2), pa.array(sets, pa.binary())], names=["h1", "h2", "shingles"]
                )

    sets = picked.select("t").mapInArrow(gather, "h1 bigint, h2 bigint, shingles binary")
    ids = wanted.select("node", "h1", "h2")
    sets = sets.join(broadcast_if(measure(ids).fits(SEND_BYTES), ids), ["h1", "h2"]).select("node", "shingles")
    return sets.groupBy("node").agg(F.any_value("shingles").alias("shingles"))


def verified(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The pairs whose sets are as similar as asked for, with their similarity."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.empty(len(batch))
            for k, (x, y) in enumerate(zip(batch.column(2), batch.column(3))):
                found[k] = jaccard(np.frombuffer(x.as_buffer(), U), np.frombuffer(y.as_buffer(), U))
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(found)], names=["a", "b", "similarity"])

    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("x"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("y"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y")
    return both.mapInArrow(check, "a bigint, b bigint, similarity double").where(F.col("similarity") >= similarity)


def verified_links(
    df: DataFrame, nodes: DataFrame, pairs: DataFrame, dense: DataFrame | None, text: str, key: str, similarity: float
) -> tuple[DataFrame, DataFrame]:
    """The pairs of nodes that are similar, by the shingles of their texts, with links that span those of dense buckets;
    and how many similar nodes each node has (``node``, ``n_links``)."""
    ends = pairs.select(F.col("a").alias("node")).union(pairs.select("b"))
    ends = (ends if dense is None else ends.union(dense.select("node"))).distinct()
    named = nodes.select("node", "h1", "h2", "key")
    wanted = named.join(broadcast_if(measure(ends).fits(SEND_BYTES), ends), "node")
    with small_batches(df.sparkSession):
        sets = freeze(sets_of(df, text, key, wanted))
        links = freeze(verified(pairs, sets, similarity).select("a", "b"))
    counts = links.select(F.col("a").alias("node"), F.lit(1).alias("count")).union(links.select("b", F.lit(1)))
    if dense is not None:
        met = links_in_dense(dense, nodes, sets, similarity)
        counts = counts.union(met.where("b is null").select("a", "count"))
        links = freeze(links.union(met.where("b is not null").select("a", "b")).distinct())
    return links, counts.groupBy("node").agg(F.sum("count").alias("n_links"))


def similarity_join(
    df: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    similarity: float = SIMILARITY,
    recall: float = RECALL,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Nodes, links between nodes, and members.

    A node is a set of shingles that rows have: ``node``, ``h1``, ``h2``, ``key`` (the smallest
    of its rows' keys), ``n`` (shingles) and ``n_links``, the similar nodes found. Links are pairs ``a`` < ``b`` of similar nodes; of those that meet
    in a dense bucket, enough to span what they join. Members give each row's ``key`` and ``node``. Texts are compared as words
    between white space with A-Z in lower case. Texts without words are equal to each other and to nothing else.
    """
    with small_batches(df.sparkSession):
        rows = freeze(sketched(df, text, key))
    nodes = rows.groupBy("h1", "h2").agg(
        F.min("key").alias("key"), F.any_value("n").alias("n"), F.any_value("sig").alias("sig")
    )
    nodes = freeze(nodes.withColumn("node", F.monotonically_increasing_id()))
    pairs, dense = candidates(nodes.where("n > 0"), similarity, recall)
    links, degree = verified_links(df, nodes, freeze(pairs), dense, text, key, similarity)
    nodes = nodes.join(degree, "node", "left").withColumn("n_links", F.coalesce("n_links", F.lit(0)))
    members = rows.select("key", "h1", "h2").join(nodes.select("h1", "h2", "node"), ["h1", "h2"])
    return nodes.drop("sig"), links, members.select("key", "node")


def near_duplicates(
    df: DataFrame, text: str = "text", key: str = "doc_id", similarity: float = SIMILARITY, recall: float = RECALL
) -> DataFrame:
    """One row for each row of ``df``: key, ``class_id``, ``n_links`` and ``n_shingles``.

    Rows are in one class when a chain of links joins their texts; equal sets of shingles always are.
    The class id is the smallest key in the class (null if it has none but null). ``n_links``
    counts the other sets that are found similar to this row's, in a large group too, where only links that span the
    group are kept. An empty table gives no rows; other columns of ``df`` are not looked at.
    """
    nodes, links, members = similarity_join(df, text, key, similarity, recall)
    roots = components(links)
    placed = nodes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = placed.groupBy("root").agg(F.min("key").alias("class_id"))
    placed = placed.join(least, "root").select("node", "class_id", "n_links", F.col("n").alias("n_shingles"))
    return members.join(placed, "node").select(F.col("key").alias(key), "class_id", "n_links", "n_shingles")
