"""The registered queries: each operator over its whole table, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from chronofold.llm import (
    alignment,
    conversations,
    decontaminate,
    line_rules,
    line_runs,
    mixing,
    ngram_join,
    packing,
    quality_model,
    shards,
    token_files,
    url_rules,
    warc_zip,
)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join.near_duplicates(table(spark, folder, "documents"))


def op2_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    model = quality_model.fit(docs, table(spark, folder, "labels"))
    scored = quality_model.score(docs, model, keep=["doc_id"])
    return scored.select(
        "doc_id", quality_model.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted"
    )


def op3_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    cleaned = line_runs.drop_common_lines(table(spark, folder, "documents").select("doc_id", "text"))
    return cleaned.select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept"), 256).alias("kept_sha256")
    )


def op4_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "source")
    return mixing.mix(docs).select("doc_id", "size", "source_size", "target", "taken")


def op5_shard(spark: SparkSession, folder: str) -> DataFrame:
    sharded = shards.shard_by_bytes(table(spark, folder, "documents"))
    return sharded.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


URL_RULES = [
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
]


def op6_url_rules(spark: SparkSession, folder: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    pages = table(spark, folder, "pages").select("page_id", "url")
    return url_rules.judge_urls(pages, rules).select("page_id", "host", "path", "rule", "verdict")


def op7_warc_zip(spark: SparkSession, folder: str) -> DataFrame:
    records = warc_zip.archive_round_trip(table(spark, folder, "pages"))
    return records.select(
        F.col("id").alias("page_id"),
        F.col("size").alias("payload_bytes"),
        F.col("digest").alias("payload_digest"),
        F.col("type").alias("record_type"),
        "refers_to",
    )


def op8_line_rules(spark: SparkSession, folder: str) -> DataFrame:
    judged = line_rules.clean_lines(table(spark, folder, "documents").select("doc_id", "text"))
    return judged.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
    )


def op9_token_files(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    tokens = token_files.token_round_trip(table(spark, folder, "documents"), path)
    return tokens.select(F.col("key").alias("doc_id"), "start", "n_tokens", "ids_crc32")


def op10_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.find_contamination(
        table(spark, folder, "documents").select("doc_id", "text"),
        table(spark, folder, "benchmark"),
        keep=["doc_id"],
    )
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


def op11_alignment(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    a, b = (public_tokenizers.path(f) for f in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    scored = alignment.align_corpus(table(spark, folder, "documents"), a, b)
    return scored.select(
        F.col("key").alias("doc_id"), "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"
    )


def op12_packing(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    packed = packing.pack_documents(table(spark, folder, "documents"), path)
    return packed.withColumnRenamed("key", "doc_id")


def op13_conversations(spark: SparkSession, folder: str) -> DataFrame:
    given = table(spark, folder, "conversations")
    report, turns = conversations.repair(conversations.damage(given))
    digests = conversations.digests(turns)
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return (
        given.select("conv_id").distinct()
        .join(report, F.col("conv_id").eqNullSafe(F.col("conv")), "left").drop("conv")
        .join(digests, F.col("conv_id").eqNullSafe(F.col("conv")), "left")
        .select(
            "conv_id",
            *(F.coalesce(c, F.lit(0).cast("bigint")).alias(c) for c in counts),
            F.coalesce("audit", F.lit("")).alias("audit"),
            F.coalesce("sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
        )
    )


QUERIES = {
    f.__name__: f
    for f in (
        op1_ngram_join,
        op2_quality,
        op3_line_dedup,
        op4_mix_sources,
        op5_shard,
        op6_url_rules,
        op7_warc_zip,
        op8_line_rules,
        op9_token_files,
        op10_decontaminate,
        op11_alignment,
        op12_packing,
        op13_conversations,
    )
}
