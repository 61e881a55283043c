"""From raw documents to shards: score, thin out near copies, decontaminate, mix, shard.

Every stage works on all that the one before kept, and its decisions take effect: rows go, are
repeated or cut. What a stage returns is written to the shared folder and read again, so a
stage that fails is repeated alone.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from chronofold.functions import col_of
from chronofold.llm import decontaminate, mixing, ngram_join, quality_model, shards
from chronofold.operators.sizing import broadcast_if, measure
from chronofold.sources.scratch import freeze

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on the labels, doesn't reject."""
    model = quality_model.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality_model.score(docs, model).where("predicted = 1").select(*map(col_of, docs.columns))


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of every class of near copies; of equal rows one."""
    row = [col_of(c) for c in docs.columns]
    marked = docs.withColumns({"_a": F.xxhash64(*row), "_b": F.xxhash64(*row[::-1], F.lit(5))})
    marked = marked.withColumn("_key", F.struct(F.col("doc_id").alias("id"), F.col("_a").alias("a"), F.col("_b").alias("b")))
    classes = freeze(ngram_join.near_duplicates(marked, key="_key").select("_key", "class_id"))
    first = classes.where(F.col("_key") == F.col("class_id")).groupBy("_key").agg(F.count("*").alias("n"))
    first = freeze(first.select(F.col("_key.a").alias("_a"), F.col("_key.b").alias("_b"), "n"))
    small = measure(first).fits(ngram_join.SEND_BYTES)
    kept = marked.join(broadcast_if(small, first), ["_a", "_b"])
    again = kept.where("n > 1").dropDuplicates(["_a", "_b"])
    return kept.where("n = 1").union(again).select(*row)


def remove_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that don't repeat the benchmark."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    clean = decontaminate.find_contamination(docs, benchmark, remove="documents", keep=docs.columns)
    return clean.select(*map(col_of, docs.columns))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each time that the mix takes a document; the last may be cut to fewer words.

    A cut text has its words joined by single spaces; its n_chars are counted anew.
    """
    mixed = mixing.mix(docs.withColumns({"_text": col_of("text"), "_source": col_of("source"), "_id": col_of("doc_id")}), text="_text", key="_id", source="_source")
    left = F.col("taken") - F.col("_time") * F.col("size")
    taken = mixed.where("taken > 0").withColumn(
        "_time", F.explode(F.sequence(F.lit(0), F.floor((F.col("taken") - 1) / F.col("size"))))
    )
    words = F.filter(F.split("_text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    cut = F.array_join(F.slice(words, 1, left.cast("int")), " ")
    taken = taken.withColumn("_cut", F.when(left < F.col("size"), cut))
    changed = {
        "text": F.coalesce("_cut", col_of("text")),
        "n_chars": F.when(F.col("_cut").isNotNull(), F.char_length("_cut").cast("long")).otherwise(col_of("n_chars")),
    }
    return taken.select(*[changed[c].alias(c) if c in changed else col_of(c) for c in docs.columns])


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return shards.shard_by_bytes(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", keep_quality),
    ("n-gram Jaccard join", keep_one_of_each),
    ("benchmark decontamination", remove_benchmarks),
    ("mixing sources to target weights", mix_sources),
    ("sharding", shard),
]

# The classifier is trained and the similarity join sampled: neither can be stated in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; what each returns is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = freeze(stage(spark, docs, sf_dir))
    return docs
