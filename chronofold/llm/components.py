"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from chronofold.sources.scratch import freeze


def mark(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.xxhash64("b", "a") % 1000003)).first()
    return tuple(row)


def large_star(edges: DataFrame) -> DataFrame:
    """Each node links its larger neighbours to the smallest of its neighbours and itself."""
    both = edges.union(edges.select("b", "a"))
    least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def small_star(edges: DataFrame) -> DataFrame:
    """Each node links its smaller neighbours and itself to the smallest of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """For links ``a``, ``b``: every node that is not the smallest of its component, and that.

    Neighbours are never gathered: only the smallest of a node's is looked for, which is combined
    before the shuffle, so a node may have any number. Each round is written to shared
    storage. Links of a node to itself, repeated and reversed links make no difference.
    """
    edges = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges = freeze(edges.where("a <> b").distinct())
    before = mark(edges)
    while before[0]:
        edges = freeze(small_star(large_star(edges)))
        now = mark(edges)
        if now == before:
            break
        before = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
