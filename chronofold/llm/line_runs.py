"""Line deduplication over levelled sorted runs of line hashes.

Each batch of documents is anti-joined with the runs before it, and becomes a run of its own: hashes that no run
has are new in it, the others are increments of what is there. A run is a table in buckets of the hash, sorted within
them, so runs are joined and merged bucket by bucket, by sorted order, without a shuffle. Runs of one level are merged into
one of the next when ``FAN_OUT`` of them have gathered, so a line is rewritten a logarithmic number of times however
many batches come. How many documents have a line is known when all batches are in; then those with a common
line lose it.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from chronofold.functions import col_of
from chronofold.operators.sizing import broadcast_if, measure
from chronofold.sources.scratch import freeze, new_schema

FAN_OUT = 3
# Fixed value: the white space that is stripped from both ends of a line.
SPACE = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
HASH = ["h1", "h2"]


def lines_of(text: Column) -> Column:
    """The lines of a text; a null or empty text has one, which is empty."""
    return F.split(F.coalesce(text, F.lit("")), "\n")


def line_keys(lines: Column) -> Column:
    """The lines stripped at both ends, with A-Z in lower case and no other letter changed."""
    bare = F.transform(lines, lambda line: F.btrim(line, F.lit(SPACE)))
    return F.transform(
        bare,
        lambda line: F.when(F.octet_length(line) == F.char_length(line), F.lower(line)).otherwise(
            F.translate(line, UPPER, LOWER)
        ),
    )


def line_hashes(lines: Column) -> Column:
    """128 bits of each line's key, null where the key is empty."""
    # the second half hashes the key under another seed; the other way round it would follow from the first
    hashed = lambda key: F.struct(F.xxhash64(key).alias("h1"), F.xxhash64(F.lit(7), key).alias("h2"))
    return F.transform(line_keys(lines), lambda key: F.when(key != "", hashed(key)))


# Types that the hash function takes.
PLAIN = {"string", "bigint", "int", "smallint", "tinyint", "double", "float", "boolean", "date", "timestamp", "timestamp_ntz"}


def row_mark(df: DataFrame, text: str) -> Column:
    """128 bits of a row: of its text, which decides its lines, and of its other plain columns,
    which spread rows of equal text."""
    content = col_of(text)
    others = [col_of(c) for c, kind in df.dtypes if c != text and kind in PLAIN]
    return F.struct(F.xxhash64(content, *others).alias("a"), F.xxhash64(*others, F.lit(3), content).alias("b"))


@dataclass
class LineRuns:
    """The runs of all batches so far. Levels hold names of tables, from the oldest to the newest."""

    spark: SparkSession
    text: str = "text"
    levels: list[list[str]] = field(default_factory=list)
    buckets: int = 0
    schema: str = ""

    def __post_init__(self) -> None:
        self.buckets = self.buckets or int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        self.schema = self.schema or new_schema(self.spark, "lines")

    def add(self, batch: DataFrame) -> DataFrame:
        """Count the documents of each line of the batch and keep them as a sorted run.

        A row of the batch is a document, repeated rows included. Returns a row for each different
        key of each row: the row's mark and the hash.
        """
        hashes = F.array_compact(F.array_distinct(line_hashes(lines_of(col_of(self.text)))))
        marked = batch.select(row_mark(batch, self.text).alias("mark"), F.explode(hashes).alias("h"))
        entries = freeze(marked.select("mark", "h.h1", "h.h2"))
        counts = self._stored(entries.groupBy(*HASH).agg(F.count("*").alias("docs")), "batch")
        fresh = counts
        for run in self.runs():
            # a run's new hashes are all that it has beyond the runs before it
            fresh = fresh.join(self._hint(run.where("fresh")), HASH, "left_anti")
        known = counts.join(self._hint(fresh), HASH, "left_anti")
        both = fresh.withColumn("fresh", F.lit(True)).unionByName(known.withColumn("fresh", F.lit(False)))
        self._keep(self._named(both, "run"), 0)
        return entries

    def runs(self) -> list[DataFrame]:
        """All runs: h1, h2, docs, and whether the hash was new then. Each hash is new in one run."""
        return [self.spark.table(t) for level in self.levels for t in level]

    @staticmethod
    def _hint(df: DataFrame) -> DataFrame:
        return df.select(*HASH).hint("merge")

    def _stored(self, df: DataFrame, label: str) -> DataFrame:
        return self.spark.table(self._named(df, label))

    def _named(self, df: DataFrame, label: str) -> str:
        """A table sorted by hash in each bucket."""
        name = f"{self.schema}.{label}_{uuid.uuid4().hex}"
        dealt = df.repartition(self.buckets, *HASH)
        dealt.write.format("parquet").bucketBy(self.buckets, *HASH).sortBy(*HASH).saveAsTable(name)
        return name

    def _keep(self, run: str, level: int) -> None:
        if len(self.levels) == level:
            self.levels.append([])
        self.levels[level].append(run)
        if len(self.levels[level]) == FAN_OUT:
            merged = self._named(self._merged([self.spark.table(t) for t in self.levels[level]]), "run")
            self.levels[level] = []
            self._keep(merged, level + 1)

    @staticmethod
    def _merged(runs: list[DataFrame]) -> DataFrame:
        """One run in place of several, two at a time by their order."""

        def two(left: DataFrame, right: DataFrame) -> DataFrame:
            left, right = left.alias("l"), right.hint("merge").alias("r")
            same = (F.col("l.h1") == F.col("r.h1")) & (F.col("l.h2") == F.col("r.h2"))
            docs = F.coalesce("l.docs", F.lit(0)) + F.coalesce("r.docs", F.lit(0))
            fresh = F.coalesce("l.fresh", F.lit(False)) | F.coalesce("r.fresh", F.lit(False))
            keys = [F.coalesce(f"l.{h}", f"r.{h}").alias(h) for h in HASH]
            return left.join(right, same, "full_outer").select(*keys, docs.alias("docs"), fresh.alias("fresh"))

        return reduce(two, runs)

    def found_in(self, least: int) -> DataFrame:
        """Hashes of the lines found in at least so many documents of all batches."""
        runs = self.runs()
        if not runs:
            return self.spark.createDataFrame([], "h1 bigint, h2 bigint")
        return self._merged(runs).where(F.col("docs") >= least).select(*HASH)

    def clean(self, batch: DataFrame, entries: DataFrame, least: int) -> DataFrame:
        """The batch without the lines that are found in at least ``least`` documents of the runs.

        ``entries`` is what ``add`` returned for the batch. Adds ``n_lines`` (before dropping), ``n_dropped`` and the
        kept text as ``kept``, where every line is dropped the empty text. Columns of those
        names are replaced; internal names start with ``_lines_``.
        """
        common = freeze(self.found_in(least))
        hit = (
            entries.join(broadcast_if(measure(common).fits(), common), HASH, "left_semi")
            .groupBy(F.col("mark").alias("_lines_at"))
            .agg(F.collect_set(F.struct(*HASH)).alias("_lines_bad"))
        )
        bad = F.col("_lines_bad")
        lines = lines_of(col_of(self.text))
        stays = F.zip_with(
            lines, line_hashes(lines), lambda line, h: F.when(~F.coalesce(F.array_contains(bad, h), F.lit(False)), line)
        )
        return (
            batch.withColumn("_lines_row", row_mark(batch, self.text))
            .join(hit, F.col("_lines_row") == F.col("_lines_at"), "left")
            .withColumn("_lines_kept", F.when(bad.isNull(), lines).otherwise(F.array_compact(stays)))
            .withColumns({
                "n_lines": F.size(lines).cast("long"),
                "n_dropped": (F.size(lines) - F.size("_lines_kept")).cast("long"),
                "kept": F.array_join("_lines_kept", "\n"),
            })
            .drop("_lines_row", "_lines_at", "_lines_bad", "_lines_kept")
        )


def drop_common_lines(
    df: DataFrame, least: int = 10, batches: int = 3, text: str = "text"
) -> DataFrame:
    """All rows of ``df``, without the lines whose key is found in at least ``least`` rows.

    The rows are taken in as ``batches`` batches, as they would arrive over time; a batch
    is chosen by the hash of the text, so the result doesn't depend on their number. Empty lines have
    no key and always stay. See ``LineRuns.clean`` for the added columns.
    """
    runs = LineRuns(df.sparkSession, text)
    batch = F.pmod(F.xxhash64(F.coalesce(col_of(text), F.lit("")), F.lit(11)), F.lit(batches))
    entries = [runs.add(df.where(batch == i)) for i in range(batches)]
    return runs.clean(df, reduce(DataFrame.union, entries), least)
