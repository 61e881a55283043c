"""Benchmark decontamination: windows of benchmark words looked up in every document."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from chronofold.functions import col_of
from chronofold.llm.words import ALNUM, Words, slices, text_bytes, words_of
from chronofold.sources.scratch import freeze

# Bytes of the arrays of benchmark items that one pass over the documents gets at most, or one item.
PASS_BYTES = 96 * 1024 * 1024
# For each word two ends, and for its window a hash, the word it begins with, the item and an offset.
BYTES_PER_WORD = 36
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
SPANS = T.ArrayType(T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())]))


def phrase(data: bytes, starts: np.ndarray, ends: np.ndarray, i: int, width: int) -> bytes:
    """The words from number ``i`` on in lower case, with one space between."""
    return b" ".join(data[starts[k] : ends[k]] for k in range(i, i + width)).lower()


@dataclass
class Windows:
    """Different windows of one width in order of their hashes: a word that each begins with, and its items.

    The items of window ``k`` are ``members[begins[k] : begins[k + 1]]``.
    """

    width: int
    hashes: np.ndarray
    first: np.ndarray
    begins: np.ndarray
    members: np.ndarray


@dataclass
class Benchmark:
    """Texts of items, once, with their words' places, and the windows to look for."""

    text: bytes
    starts: np.ndarray
    ends: np.ndarray
    names: list[str]
    windows: list[Windows]

    def nbytes(self) -> int:
        own = [self.starts, self.ends, *(a for w in self.windows for a in (w.hashes, w.first, w.begins, w.members))]
        return len(self.text) + sum(a.nbytes for a in own) + sum(map(len, self.names))


def benchmark_windows(items: list[str | None], texts: pa.Array, width: int) -> Benchmark:
    """The windows of the items: runs of ``width`` words, or all words of an item that has fewer.

    An item without words has none. Items with one id are one item; a null id reads "".
    """
    data, at = text_bytes(texts)
    names = sorted({name or "" for name in items})
    number = {name: k for k, name in enumerate(names)}
    owner = np.array([number[name or ""] for name in items], np.int32)
    found: dict[int, list[tuple]] = {}
    starts, ends, words_before = [], [], 0
    for i, j in slices(at):
        words = words_of(data[at[i] : at[j]], at[i : j + 1] - at[i], ALNUM)
        starts.append((words.starts + at[i]).astype(np.int32))
        ends.append((words.ends + at[i]).astype(np.int32))
        # items that are shorter than a window, by their number of words
        for size in np.unique(np.minimum(words.counts, width)):
            if size:
                whole = words if size == width else _only(words, size)
                first, hashed = whole.windows(int(size))
                row = np.searchsorted(words.first, first, side="right") - 1
                found.setdefault(int(size), []).append((hashed, (first + words_before).astype(np.int32), owner[i + row]))
        words_before += len(words.starts)
    text = data.tobytes()
    made = Benchmark(text, np.concatenate([*starts, np.zeros(0, np.int32)]), np.concatenate([*ends, np.zeros(0, np.int32)]), names, [])
    for size, parts in sorted(found.items()):
        made.windows.append(_windows(made, size, *(np.concatenate(p) for p in zip(*parts))))
    return made


def _only(words: Words, size: int) -> Words:
    """The words, as if texts of another number of them had none in a row."""
    first = words.first
    short = np.flatnonzero(words.counts == size)
    # bounds of these texts alone; the runs between them are texts of other sizes
    bounds = np.unique(np.concatenate([[0], first[short], first[short + 1], [len(words.hashes)]]))
    inside = np.isin(bounds[:-1], first[short])
    picked = Words(words.starts, words.ends, words.hashes, bounds)
    return _Picked(picked.starts, picked.ends, picked.hashes, picked.first, inside)


@dataclass
class _Picked(Words):
    inside: np.ndarray

    def windows(self, width: int) -> tuple[np.ndarray, np.ndarray]:
        first, hashed = super().windows(width)
        kept = self.inside[np.searchsorted(self.first, first, side="right") - 1]
        return first[kept], hashed[kept]


def _windows(made: Benchmark, size: int, hashed: np.ndarray, first: np.ndarray, owner: np.ndarray) -> Windows:
    order = np.lexsort((owner, hashed))
    hashed, first, owner = hashed[order], first[order], owner[order]
    equal = hashed[1:] == hashed[:-1]
    # windows with one hash are compared word by word; where they differ they are sorted by what they say
    for k in np.flatnonzero(equal):
        if equal[k] and (k == 0 or not equal[k - 1]):
            end = k + 1
            while end < len(equal) and equal[end]:
                end += 1
            said = [phrase(made.text, made.starts, made.ends, f, size) for f in first[k : end + 1].tolist()]
            if any(x != said[0] for x in said):
                again = sorted(range(len(said)), key=lambda n: (said[n], owner[k + n]))
                first[k : end + 1], owner[k : end + 1] = first[k : end + 1][again], owner[k : end + 1][again]
                said = [said[n] for n in again]
                equal[k:end] = [x == y for x, y in zip(said, said[1:])]
    new = np.concatenate([[True], ~equal]) if len(hashed) else np.zeros(0, bool)
    group = np.cumsum(new)
    # an item counts once for each window
    once = np.concatenate([[True], (group[1:] != group[:-1]) | (owner[1:] != owner[:-1])]) if len(hashed) else new
    begins = np.searchsorted(group[once], np.arange(1, (int(group[-1]) if len(group) else 0) + 2))
    return Windows(size, hashed[new], first[new], begins.astype(np.int32), owner[once])


def hits(data: np.ndarray, at: np.ndarray, looked_for: Benchmark) -> tuple[Words, dict[int, tuple[list, set]]]:
    """The words of some texts; for each text with a verified hit its word spans and the items."""
    words = words_of(data, at, ALNUM)
    found: dict[int, tuple[list, set]] = {}
    raw, b = None, looked_for
    for w in b.windows:
        first, hashed = words.windows(w.width)
        low = np.searchsorted(w.hashes, hashed)
        low[low == len(w.hashes)] = 0
        same = np.flatnonzero(w.hashes[low] == hashed)
        if not len(same):
            continue
        raw = data.tobytes() if raw is None else raw
        texts = np.searchsorted(words.first, first[same], side="right") - 1
        for i, k, t in zip(first[same].tolist(), low[same].tolist(), texts.tolist()):
            said, value = phrase(raw, words.starts, words.ends, i, w.width), w.hashes[k]
            while k < len(w.hashes) and w.hashes[k] == value:
                if phrase(b.text, b.starts, b.ends, int(w.first[k]), w.width) == said:
                    spans, items = found.setdefault(t, ([], set()))
                    spans.append((i - int(words.first[t]), i - int(words.first[t]) + w.width))
                    items.update(b.names[m] for m in w.members[w.begins[k] : w.begins[k + 1]])
                    break
                k += 1
    return words, found


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def cut_out(text: str | None, spans: list[tuple[int, int]]) -> str | None:
    """The text without the words of the spans and what stands between them."""
    if not spans:
        return text
    raw = text.encode()
    words = words_of(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]), ALNUM)
    kept, end = [], 0
    for a, b in spans:
        kept.append(raw[end : words.starts[a]])
        end = words.ends[b - 1]
    return b"".join([*kept, raw[end:]]).decode()


def scan(df: DataFrame, text: str, looked_for: Benchmark, cut: bool) -> DataFrame:
    """One pass: adds the hits of these items to ``_hit_spans`` and ``_hit_items``; ``cut`` takes all spans out of the text."""
    shared = df.sparkSession.sparkContext.broadcast(looked_for)
    names, schema = df.columns, df.schema
    again = "_hit_spans" in names
    if not again:
        schema = T.StructType(
            [*schema, T.StructField("n_words", T.LongType()), T.StructField("_hit_spans", SPANS), T.StructField("_hit_items", T.ArrayType(T.StringType()))]
        )
    place = names.index(text)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        looked_for = shared.value
        for batch in batches:
            data, at = text_bytes(batch.column(place))
            counts, spans, items = [], [[] for _ in range(len(batch))], [[] for _ in range(len(batch))]
            for i, j in slices(at):
                words, found = hits(data[at[i] : at[j]], at[i : j + 1] - at[i], looked_for)
                counts.extend(words.counts.tolist())
                for t, (s, names_) in found.items():
                    spans[i + t], items[i + t] = merged(s), sorted(names_)
            columns = list(batch.columns)
            if again:
                for k, old in enumerate(zip(batch.column("_hit_spans").to_pylist(), batch.column("_hit_items").to_pylist())):
                    spans[k] = merged([*spans[k], *((x["a"], x["b"]) for x in old[0])])
                    items[k] = sorted({*items[k], *old[1]})
                columns = columns[:-3]
            if cut and any(spans):
                whole = columns[place].to_pylist()
                columns[place] = pa.array([cut_out(t, s) for t, s in zip(whole, spans)], columns[place].type)
            span_type = pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))
            new = [
                pa.array(counts, pa.int64()),
                pa.array([[{"a": a, "b": b} for a, b in s] for s in spans], span_type),
                pa.array(items, pa.list_(pa.string())),
            ]
            yield pa.RecordBatch.from_arrays([*columns, *new], names=schema.names)

    return df.mapInArrow(add, schema)


def find_contamination(
    df: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    width: int = 13,
    percent: int = 5,
    remove: str | None = None,
    keep: list[str] | None = None,
) -> DataFrame:
    """``df`` with n_words, n_hit, items and contaminated added.

    A word is hit where it lies in a run of ``width`` words that an item has too (an item of
    fewer words counts as one run), A-Z in lower case; hashes find the runs, their words are then compared. A
    text is contaminated when at least ``percent`` in a hundred of its words are hit. ``items``
    has the different ids in string order. Null and empty texts have no words and are clean, and
    so is every text when the benchmark is empty. Rows are judged one by one, repeated rows too.

    ``remove="documents"`` drops contaminated rows, ``remove="spans"`` cuts hit words out of the
    text. ``keep`` names the columns to return besides the added ones (default: all); one that
    has the name of an added column is replaced.

    The benchmark is looked for in passes over the documents: one for any benchmark whose texts and sorted windows are
    up to ``PASS_BYTES``, which is what the driver and each task then hold of it.
    """
    if remove not in (None, "documents", "spans"):
        raise ValueError(f"remove must be 'documents', 'spans' or None, got {remove!r}")
    added = ["n_words", "n_hit", "items", "contaminated", "_hit_spans", "_hit_items"]
    names = [c for c in df.columns if c not in added]
    out = df.select(*[col_of(c) for c in names])
    items = benchmark.select(col_of(item).cast("string").alias("i"), col_of(item_text).alias("t")).where("t <> ''").distinct()
    sizes = F.octet_length("t") + F.octet_length(F.coalesce("i", F.lit(""))) + BYTES_PER_WORD * F.regexp_count("t", F.lit(WORD))
    passes = max(1, -(-(items.agg(F.sum(sizes)).first()[0] or 0) // PASS_BYTES))
    part = F.pmod(F.xxhash64("i", "t"), F.lit(passes))
    for k in range(passes):
        rows = items.where(part == k).toArrow().combine_chunks()
        made = benchmark_windows(rows.column("i").to_pylist(), rows.column("t"), width)
        out = scan(out if k == 0 else freeze(out), text, made, remove == "spans" and k == passes - 1)
    hit = F.aggregate("_hit_spans", F.lit(0).cast("long"), lambda n, s: n + s["b"] - s["a"])
    out = out.withColumns({"n_hit": hit, "items": F.col("_hit_items")})
    out = out.withColumn(
        "contaminated", (F.col("n_hit") > 0) & (F.col("n_hit") * 100 >= F.col("n_words") * percent)
    )
    if remove == "documents":
        out = out.where(~F.col("contaminated"))
    kept = [c for c in (names if keep is None else keep)]
    return out.select(*[col_of(c) for c in kept], *added[:4])
