"""Sharding: the contiguous partition whose largest shard is as small as possible.

Rows of equal text form one atomic group; groups are ordered by the digest of their text. The
smallest capacity for which greedy filling needs no more than the wanted shards is found by
binary search. The driver never holds the groups: it searches on a grid of running totals of
bounded size, which Spark refines only where the answer is still open. Any shard then ends at
a digest, so a row's shard is a comparison with fifteen constants and needs no join.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from chronofold.functions import col_of
from chronofold.llm.prefix import ROWS_PER_RANGE, range_bits, range_of_hex, with_running_sum
from chronofold.sources.scratch import freeze

GRID = 32_768
# Small tables are numbered in at most so many tasks, each of which writes a file.
FEW_TASKS = 64


@dataclass
class Ends:
    """What is known of the running totals at which groups end.

    ``known`` are real ends in order, 0 and the total among them. ``open`` are the stretches, first and last
    total, in order and apart, that may hold ends not known; no known end lies in one.
    """

    known: list[int]
    open: list[tuple[int, int]]

    def sure(self, at: int) -> int:
        """The last known end that is not beyond ``at``."""
        return self.known[bisect_right(self.known, at) - 1]

    def hoped(self, at: int) -> int:
        """No real end that is not beyond ``at`` lies beyond this."""
        stretch = self.stretch(at)
        return max(self.sure(at), min(at, stretch[1])) if stretch else self.sure(at)

    def stretch(self, at: int) -> tuple[int, int] | None:
        """The last open stretch that begins not beyond ``at``."""
        i = bisect_left(self.open, (at + 1,)) - 1
        return self.open[i] if i >= 0 else None

    def walk(self, capacity: int, shards: int, step) -> list[int]:
        at, stops = 0, []
        for _ in range(shards):
            at = step(at + capacity)
            stops.append(at)
        return stops


def smallest(least: int, most: int, holds) -> int:
    """The smallest capacity from ``least`` to ``most`` that holds; ``most`` is known to."""
    while least < most:
        middle = (least + most) // 2
        if holds(middle):
            most = middle
        else:
            least = middle + 1
    return least


def grid(groups: DataFrame, upto: str, spans: list[tuple[int, int]]) -> list[tuple]:
    """First and last end, and how many, in each cell of the spans; at most about GRID cells."""
    width = cell_width(spans)
    span = F.lit(None).cast("int")
    for i, (a, b) in enumerate(spans):
        span = F.when(F.col(upto).between(a, b), i).otherwise(span)
    cells = (
        groups.withColumn("span", span)
        .where("span IS NOT NULL")
        .groupBy("span", F.floor((F.col(upto) - 1) / width).alias("cell"))
        .agg(F.min(upto).alias("a"), F.max(upto).alias("b"), F.count_distinct(upto).alias("n"))
    )
    return sorted((r["a"], r["b"], r["n"]) for r in cells.collect())


def outside(stretches: list[tuple[int, int]], spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """What the spans, in order and apart, leave of the stretches."""
    out = []
    for first, last in stretches:
        for a, b in spans:
            if b < first or a > last:
                continue
            if first < a:
                out.append((first, a - 1))
            first = b + 1
        if first <= last:
            out.append((first, last))
    return out


def refined(ends: Ends, spans: list[tuple[int, int]], cells: list[tuple]) -> Ends:
    """The same knowledge with the cells in place of what was known inside the spans.

    Beyond their cells the spans hold no end, also where a span stops short of the next known one.
    """
    known = sorted({*ends.known, *(end for cell in cells for end in cell[:2])})
    open_ = outside(ends.open, spans)
    for a, b, n in cells:
        inside = known[bisect_left(known, a) : bisect_right(known, b)]
        if n > len(inside):
            open_ += [(x + 1, y - 1) for x, y in zip(inside, inside[1:]) if y - x > 1]
    return Ends(known, sorted(open_))


def cell_width(spans: list[tuple[int, int]]) -> int:
    return max(1, -(-sum(b - a for a, b in spans) // GRID))


def doubtful(ends: Ends, hoped: int, sure: int, shards: int) -> list[tuple[int, int]]:
    """Where to look closer, given capacities that might hold and that does.

    All totals at which a shard may end, if cells of their grid are finer than what is open there. Else, as
    with groups about as large as a shard, the open stretches where shards of a few capacities would end: at
    least one for the least capacity, and each shrinks by its first and last end, so the search comes to an end.
    """
    total = ends.known[-1]
    low, high = ends.walk(hoped, shards, ends.sure), ends.walk(sure, shards, ends.hoped)
    wide = merged([(max(1, a), min(total, b)) for a, b in zip(low, high) if a < total])
    starts = [a for a, _ in wide]
    within = [(x, y) for x, y in ends.open if (i := bisect_right(starts, y)) and wide[i - 1][1] >= x]
    if 4 * cell_width(wide) <= max(y - x + 1 for x, y in within):
        return wide
    met: dict[tuple[int, int], None] = {}
    for capacity in (hoped, (hoped + sure) // 2, sure - 1):
        for at in ends.walk(capacity, shards, ends.hoped):
            stretch = ends.stretch(at)
            if stretch and at <= stretch[1]:
                met[stretch] = None
    return sorted(list(met)[: max(1, GRID // 2)])


def minimax_cuts(groups: DataFrame, size: str, upto: str, shards: int) -> tuple[int, list[int]]:
    """The smallest feasible capacity, and running totals at which to cut for it.

    Cuts keep every shard within the capacity; among those they are set near equal shares of
    what is left, so that shards after a huge group aren't left empty.
    """
    row = groups.agg(F.coalesce(F.sum(size), F.lit(0)).alias("t"), F.max(size).alias("m")).first()
    total, largest = int(row["t"]), int(row["m"] or 0)
    if not total:
        return 0, [0] * (shards - 1)
    floor_ = max(largest, -(-total // shards))
    spans, ends = [(1, total)], Ends([0, total], [(1, total - 1)])
    while True:
        ends = refined(ends, spans, grid(groups, upto, spans))
        reaches = lambda c, step: ends.walk(c, shards, step)[-1] >= total
        sure = smallest(floor_, total, lambda c: reaches(c, ends.sure))
        hoped = smallest(floor_, sure, lambda c: reaches(c, ends.hoped))
        if sure == hoped:
            break
        spans = doubtful(ends, hoped, sure, shards)
    return sure, balanced(ends.known, sure, total, shards)


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


def balanced(known: list[int], capacity: int, total: int, shards: int) -> list[int]:
    """Cuts at known ends, each shard within the capacity and near an equal share of the rest."""
    least = [total]
    for _ in range(shards - 1):
        least.append(known[bisect_left(known, max(0, least[-1] - capacity))])
    least.reverse()
    at, cuts = 0, []
    for k in range(shards - 1):
        ideal = at + (total - at) / (shards - k)
        low, high = least[k], known[bisect_right(known, at + capacity) - 1]
        i = bisect_left(known, ideal)
        near = [known[j] for j in (i - 1, i) if 0 <= j < len(known)]
        at = min(max(min(near, key=lambda e: abs(e - ideal)), low, at), high)
        cuts.append(at)
    return cuts


def utf8_size(text: Column) -> Column:
    """Bytes of the text and one more for its end; a null text has none."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long")


def shard_by_bytes(
    df: DataFrame, text: str = "text", key: str = "doc_id", shards: int = 16
) -> DataFrame:
    """One row for each row of ``df``: key, size, text_crc32, shard and slot.

    Equal texts share a shard; all null texts count as one text of their own, with checksum 0.
    Slots number the rows of a shard without a gap, in hash order of key and text. Repeated
    rows each get a slot. A table without rows gives no rows. Columns of ``df`` other than
    ``key`` and ``text`` are not read, so their names can't clash.
    """
    content = col_of(text)
    rows = freeze(
        df.select(
            col_of(key).alias("key"),
            utf8_size(content).alias("size"),
            F.coalesce(F.crc32(content.cast("binary")), F.lit(0)).alias("text_crc32"),
            F.coalesce(F.sha2(content, 256), F.lit("")).alias("digest"),
        )
    )
    n = rows.count()
    bits, tasks = range_bits(n), max(FEW_TASKS, n // ROWS_PER_RANGE)
    groups = rows.groupBy("digest").agg(F.sum("size").alias("bytes"))
    groups = groups.withColumn("span", range_of_hex(F.col("digest"), bits)).withColumn("all", F.lit(0))
    groups = freeze(
        with_running_sum(groups, ["all"], "span", ["digest"], "bytes", "upto", 1 << bits)
        .drop("all", "span")
        .coalesce(tasks)
    )
    capacity, cuts = minimax_cuts(groups, "bytes", "upto", shards)
    at = {r["upto"]: r["digest"] for r in groups.where(F.col("upto").isin(cuts)).collect()}
    shard = F.lit(0)
    for cut in cuts:
        # a cut at 0 leaves its shard empty: every row lies beyond it
        shard = shard + (F.col("digest") > at[cut]).cast("int") if cut else shard + 1
    dealt = rows.withColumn("shard", shard.cast("int"))
    mixed = F.sha2(F.concat_ws("|", F.col("key").cast("string"), "digest"), 256)
    dealt = (
        dealt.withColumn("mixed", mixed)
        .withColumn("span", range_of_hex(F.col("mixed"), bits))
        .withColumn("one", F.lit(1).cast("long"))
    )
    order = ["mixed", "key", "digest"]
    slotted = with_running_sum(dealt, ["shard"], "span", order, "one", "upto", shards << bits)
    return slotted.coalesce(tasks).select(
        F.col("key").alias(key),
        "size",
        "text_crc32",
        "shard",
        (F.col("upto") - 1).alias("slot"),
    )
