"""URL rules looked up in a sorted array of digests.

A rule is a host and a path; it fits urls of that host and its subdomains whose path starts with
the rule's. For each url the host's suffixes and the path's prefixes, at lengths that rules have, are hashed and
searched for in the sorted 64-bit digests of all rules; a digest that is found counts only
when the stored rule has the same string. The arrays are files, mapped into the memory of each
Python worker, so that workers of a machine share one copy.
"""

from __future__ import annotations

import io
import uuid
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from chronofold.functions import col_of
from chronofold.operators.sizing import measure
from chronofold.operators.skew import ROWS_PER_SALT, salted_join
from chronofold.sources.scratch import freeze, shared_folder

# Rules up to this size pass through the driver and are sent to the executors as files; beyond it they are joined.
FILE_BYTES = 64 * 1024 * 1024
# Bytes that are written to a file at a time.
WRITE_BYTES = 4 * 1024 * 1024
BEST = "_url_rules_best"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_of(url: Column) -> Column:
    """What stands between the first ``://`` and a slash, question mark, hash or the end."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), PARTS, 1)
    return F.translate(host, UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), PARTS, 2)


def rule_arrays(rules: Sequence[tuple[str, str, str]]) -> dict[str, np.ndarray]:
    """The rules as arrays: digests in order, strings with their ends, hosts' lengths, verdicts."""
    digests = np.array([xxhash.xxh64_intdigest(h + p) for h, p, _ in rules], np.uint64)
    order = np.argsort(digests, kind="stable")
    strings = [(rules[i][0] + rules[i][1]).encode() for i in order]
    return {
        "digests": digests[order],
        "ends": np.cumsum([0, *map(len, strings)]),
        "strings": np.frombuffer(b"".join(strings), np.uint8),
        "hosts": np.array([len(rules[i][0].encode()) for i in order], np.int32),
        "blocks": np.array([rules[i][2] == "block" for i in order], bool),
        "lengths": np.unique([len(p.encode()) for _, p, _ in rules]).astype(np.int32),
    }


def send_arrays(spark: SparkSession, rules: Sequence[tuple[str, str, str]]) -> str:
    """Put the arrays as files into the shared folder, for every executor to fetch; returns their label.

    An executor that is added or replaced later fetches them from there too, for as long as
    the application lasts: so they don't lie in the run's folder, which may go before.
    """
    label = uuid.uuid4().hex
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    target = jvm.org.apache.hadoop.fs.Path(f"{shared_folder(spark).rstrip('/')}/url-rules-{label}")
    system = target.getFileSystem(conf)
    system.mkdirs(target)
    for name, values in rule_arrays(rules).items():
        held = io.BytesIO()
        np.save(held, values)
        there = jvm.org.apache.hadoop.fs.Path(target, f"{label}-{name}.npy")
        out = system.create(there)
        view = held.getbuffer()
        for at in range(0, len(view), WRITE_BYTES):
            out.write(bytearray(view[at : at + WRITE_BYTES]))
        out.close()
        spark.sparkContext.addFile(system.makeQualified(there).toString())
    return label


class RuleArrays:
    """The files, mapped; only the pages that searches touch are read."""

    def __init__(self, open_) -> None:
        self.digests, self.ends, self.strings, self.hosts, self.blocks, self.lengths = map(
            open_, ("digests", "ends", "strings", "hosts", "blocks", "lengths")
        )

    def judge(self, hosts: list[str], paths: list[str]) -> tuple[list, list]:
        """The longest fitting rule and its verdict for each url; without one, none and allow.

        Of two rules of equal length the one with the longer host counts. Urls that repeat are looked up once.
        """
        pairs = list(zip(hosts, paths))
        once = {pair: k for k, pair in enumerate(dict.fromkeys(pairs))}
        rules, verdicts = self._judged([h for h, _ in once], [p for _, p in once])
        at = [once[pair] for pair in pairs]
        return [rules[k] for k in at], [verdicts[k] for k in at]

    def _judged(self, hosts: list[str], paths: list[str]) -> tuple[list, list]:
        owners, keys, host_sizes = [], [], []
        for k, (host, path) in enumerate(zip(hosts, paths)):
            raw, start = path.encode(), 0
            fitting = [raw[:n] for n in self.lengths.tolist() if n <= len(raw)]
            suffix = host.encode()
            while suffix:
                for prefix in fitting:
                    owners.append(k)
                    keys.append(suffix + prefix)
                    host_sizes.append(len(suffix))
                start = suffix.find(b".") + 1
                suffix = suffix[start:] if start else b""
        best: dict[int, tuple[int, int, int]] = {}
        wanted = np.array([xxhash.xxh64_intdigest(x) for x in keys], np.uint64)
        low = np.searchsorted(self.digests, wanted, side="left")
        high = np.searchsorted(self.digests, wanted, side="right")
        for n in np.flatnonzero(high > low).tolist():
            for at in range(low[n], high[n]):
                stored = self.strings[self.ends[at] : self.ends[at + 1]].tobytes()
                if stored == keys[n] and self.hosts[at] == host_sizes[n]:
                    found = (len(stored), host_sizes[n], at)
                    best[owners[n]] = max(best.get(owners[n], found), found)
        rules: list = [None] * len(hosts)
        verdicts = ["allow"] * len(hosts)
        for k, (_, _, at) in best.items():
            rules[k] = self.strings[self.ends[at] : self.ends[at + 1]].tobytes().decode()
            verdicts[k] = "block" if self.blocks[at] else "allow"
        return rules, verdicts


def judge_urls(df: DataFrame, rules: DataFrame, url: str = "url", file_bytes: int = FILE_BYTES) -> DataFrame:
    """``df`` with host, path, rule and verdict added.

    ``rules`` has host, path and verdict (block or allow), all strings. A null url, and one without
    ``://``, has an empty host and path; no rule fits it. A url that no rule fits is allowed and has a null
    rule. A rule given twice with both verdicts blocks. Columns with the name of an added one
    are replaced, all others stay; internal names start with ``_url_rules_``. Without rules everything is allowed.
    """
    spark = df.sparkSession
    rules = (
        rules.select(F.translate("host", UPPER, LOWER).alias("host"), "path", "verdict")
        .where("host IS NOT NULL AND path IS NOT NULL")
        .groupBy("host", "path")
        .agg(F.max("verdict").alias("verdict"))
    )
    kept = [col_of(c) for c in df.columns if c not in ("host", "path", "rule", "verdict")]
    df = df.select(*kept, host_of(col_of(url)).alias("host"), path_of(col_of(url)).alias("path"))
    if not measure(rules).fits(file_bytes):
        return judge_by_join(df, rules)
    listed = rules.toArrow().to_pydict()
    label = send_arrays(spark, list(zip(listed["host"], listed["path"], listed["verdict"])))
    names = df.columns
    schema = T.StructType([*df.schema, T.StructField("rule", T.StringType()), T.StructField("verdict", T.StringType())])

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrays = RuleArrays(lambda name: np.load(SparkFiles.get(f"{label}-{name}.npy"), mmap_mode="r"))
        for batch in batches:
            hosts, paths = (batch.column(names.index(c)).to_pylist() for c in ("host", "path"))
            found, verdicts = arrays.judge(hosts, paths)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(found, pa.string()), pa.array(verdicts, pa.string())], names=schema.names
            )

    return df.mapInArrow(judge, schema)


def judge_by_join(df: DataFrame, rules: DataFrame, rows_per_salt: int = ROWS_PER_SALT) -> DataFrame:
    """The same result with the rules joined by their digest, for lists too large to send.

    A rule that fits very many urls, and a url that is found very often, are dealt over several tasks.
    """
    sizes = F.octet_length("path")
    lengths = [r[0] for r in rules.select(sizes).distinct().orderBy(sizes).collect()]
    urls = df.select("host", "path").where("host <> ''").distinct()
    labels = F.split("host", r"\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), ".")
    )
    raw = F.col("path").cast("binary")
    prefixes = F.array(*[F.when(F.octet_length("path") >= n, F.substring(raw, 1, n)) for n in lengths])
    keys = urls.withColumn("h", F.explode(suffixes)).withColumn("p", F.explode(F.array_compact(prefixes)))
    listed = rules.select(
        F.xxhash64("host", F.col("path").cast("binary")).alias("digest"),
        F.col("host").alias("rule_host"),
        F.col("path").alias("rule_path"),
        F.col("verdict").alias("said"),
    )
    keys = salted_join(keys.withColumn("digest", F.xxhash64("h", "p")), listed, ["digest"], "inner", rows_per_salt)
    keys = keys.where((F.col("h") == F.col("rule_host")) & (F.col("p") == F.col("rule_path").cast("binary")))
    rule = F.concat("rule_host", "rule_path")
    best = keys.groupBy("host", "path").agg(
        F.max(F.struct(F.octet_length(rule).alias("n"), F.octet_length("rule_host").alias("m"), rule.alias("rule"), "said")).alias(BEST)
    )
    joined = salted_join(df, freeze(best), ["host", "path"], "left", rows_per_salt)
    found = {"rule": F.col(f"{BEST}.rule"), "verdict": F.coalesce(f"{BEST}.said", F.lit("allow"))}
    return joined.select(*map(col_of, df.columns), *[value.alias(name) for name, value in found.items()])
