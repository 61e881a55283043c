"""Mixing sources to target weights, cut at each source's exact budget of words."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from chronofold.functions import col_of
from chronofold.llm.prefix import range_bits, range_of_hex
from chronofold.operators.sizing import broadcast_if, measure
from chronofold.sources.scratch import freeze

WORD = r"[^\x20\x09-\x0D]+"


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def random_key(key: Column, seed: int) -> Column:
    """A hash-random key, the same in every run."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))))


def targets(
    sources: DataFrame, weights: Sequence[int], share: float, most: int
) -> DataFrame:
    """Adds ``target``: ``share`` of all sizes dealt by weight, no source above ``most`` times its size.

    What a full source can't take goes to the others by weight. With sources in ascending order
    of capacity per weight, the full ones come first, so one pass of running sums finds the
    level that the rest share. ``sources`` has a row for each source: rank, source_size.
    """
    sources = sources.withColumn(
        "weight", F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    ).withColumn("room", F.col("source_size") * most)
    filling = Window.orderBy(F.col("room") / F.col("weight"), "rank")
    before = filling.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    level = (share * F.sum("source_size").over(every) - F.coalesce(F.sum("room").over(before), F.lit(0))) / (
        F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    )
    sources = sources.withColumn("level", level)
    fits = F.col("level") * F.col("weight") <= F.col("room")
    final = F.min(F.when(fits, F.struct((F.col("room") / F.col("weight")).alias("o"), "rank", "level"))).over(every)
    return sources.withColumn(
        "target",
        F.least(F.col("room").cast("double"), F.coalesce(final["level"] * F.col("weight"), F.col("room").cast("double"))),
    ).drop("level", "room")


def mix(
    df: DataFrame,
    weights: Sequence[int] = (3, 1, 2),
    share: float = 1.5,
    most: int = 2,
    seed: int = 17,
    text: str = "text",
    key: str = "doc_id",
    source: str = "source",
) -> DataFrame:
    """``df`` with ``size``, ``source_size``, ``target`` and ``taken`` added; no row is dropped.

    Rows of a source are ordered by a hash of the key. Whole epochs of the source are taken
    first, then rows in that order until the budget (the target, rounded down) is used up: the
    row at the cut is taken in part, so a source's taken words are its budget. Sources weigh
    ``weights`` in turn, by code point with null as a source of its own and last. A row without
    words takes none, and so does a source whose rows have none. Rows with one key lie at one
    place of the order; where the cut falls on several, each takes an equal part, rounded down.
    A column of ``df`` that has the name of an added one is replaced; internal names start
    with ``_mix_``.
    """
    sized = df.withColumns({"size": n_words(col_of(text)), "_mix_key": random_key(col_of(key), seed)})
    slim = freeze(sized.select(col_of(source).alias("source"), "size", F.col("_mix_key").alias("key")))
    sums = slim.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("rows"))
    # one row for each source: a list that grows with the sources, not with the rows
    ranked = sums.withColumn(
        "rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    )
    aims = freeze(targets(ranked, weights, share, most))
    small = measure(aims).fits()
    bits = range_bits(aims.agg(F.max("rows")).first()[0] or 0)
    budget = F.floor("target")
    aims = aims.withColumn(
        "epochs", F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0)
    ).withColumn("rest", budget - F.col("epochs") * F.col("source_size"))
    keyed = slim.withColumn("span", range_of_hex(F.col("key"), bits))
    spans = keyed.groupBy("source", "span").agg(F.sum("size").alias("words"))
    earlier = Window.partitionBy("source").orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.withColumn("start", F.coalesce(F.sum("words").over(earlier), F.lit(0)))
    open_ = aims.select(F.col("source").alias("s"), "rank", "rest").where("rest > 0")
    crossed = (
        spans.join(broadcast_if(small, open_), F.col("source").eqNullSafe(F.col("s")))
        .where("start < rest AND start + words >= rest")
        .select("s", "rank", "span", "start", "rest")
    )
    # the one range of each source in which its budget ends, in order of the keys
    within = (
        keyed.alias("k")
        .join(
            broadcast_if(small, crossed).alias("c"),
            F.col("k.source").eqNullSafe(F.col("c.s")) & (F.col("k.span") == F.col("c.span")),
        )
        .groupBy("rank", "key", "start", "rest")
        .agg(F.sum("size").alias("words"), F.count("*").alias("copies"))
    )
    running = Window.partitionBy("rank").orderBy("key").rowsBetween(Window.unboundedPreceding, -1)
    within = within.withColumn("start", F.col("start") + F.coalesce(F.sum("words").over(running), F.lit(0)))
    cuts = within.where("start < rest AND start + words >= rest").select(
        F.col("rank").alias("r"), F.col("key").alias("_mix_cut"), F.floor((F.col("rest") - F.col("start")) / F.col("copies")).alias("_mix_part")
    )
    plan = aims.join(cuts, aims["rank"] == cuts["r"], "left").select(
        F.col("source").alias("_mix_source"),
        F.col("source_size").alias("_mix_size"),
        F.col("target").alias("_mix_target"),
        F.col("epochs").alias("_mix_epochs"),
        "_mix_cut",
        "_mix_part",
    )
    plan = freeze(plan)
    sized = sized.drop("source_size", "target", "taken")
    whole = F.col("_mix_epochs") * F.col("size")
    part = (
        F.when(F.col("_mix_key") < F.col("_mix_cut"), F.col("size"))
        .when(F.col("_mix_key") == F.col("_mix_cut"), F.least("size", "_mix_part"))
        .otherwise(0)
    )
    return (
        sized.join(broadcast_if(small, plan), col_of(source).eqNullSafe(F.col("_mix_source")))
        .withColumns({
            "source_size": F.col("_mix_size"),
            "target": F.col("_mix_target"),
            "taken": (whole + part).cast("long"),
        })
        .drop(*[c for c in plan.columns], "_mix_key")
    )
