"""Equi-joins where one key may hold a large part of all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from chronofold.functions import any_null, col_of, hashable, ref, stable_salt
from chronofold.operators.sizing import BROADCAST_BYTES, broadcast_if, measure
from chronofold.sources.scratch import freeze

DIGEST = "__digest"
# Parts that the rows of a hot key are dealt into, on either side, and the part of a row.
BIG_PARTS, OTHER_PARTS = "__big_parts", "__other_parts"
BIG_PART, OTHER_PART = "__big_part", "__other_part"
CELL = [BIG_PART, OTHER_PART]

# Rows of one key that a task should join; a key with more of them is salted.
ROWS_PER_SALT = 1_000_000
# A hot key's digest and its two numbers of parts.
HOT_BYTES = 24
# Numbers that one row is repeated by at a time.
STRIDE = 1024


def hot_keys(
    big: DataFrame, other: DataFrame, on: Sequence[str], rows_per_salt: int = ROWS_PER_SALT
) -> DataFrame:
    """Digests of the keys with more than ``rows_per_salt`` rows on either side, with the parts
    that each side's rows are dealt into.

    A digest and two counts for each, and at most one such key for ``rows_per_salt`` rows: a
    key's own width does not matter. Both sides go through one aggregate, combined in the map tasks.
    """
    both = [
        df.select(_digest(df, big.schema, on), F.lit(left).alias(BIG_PARTS), F.lit(1 - left).alias(OTHER_PARTS))
        for df, left in ((big, 1), (other, 0))
    ]
    counted = both[0].union(both[1]).groupBy(DIGEST).agg(*[F.sum(c).alias(c) for c in (BIG_PARTS, OTHER_PARTS)])
    parts = [f"greatest(1L, ({c} + {rows_per_salt} - 1) div {rows_per_salt}) as {c}" for c in (BIG_PARTS, OTHER_PARTS)]
    return counted.where(f"greatest({BIG_PARTS}, {OTHER_PARTS}) > {rows_per_salt}").selectExpr(DIGEST, *parts)


def compared_types(left: DataFrame, right: DataFrame, on: Sequence[str]) -> list[str | None]:
    """For each key the type in which Spark compares the two sides' values, None where both have it."""
    pairs = [(left.schema[k].dataType, right.schema[k].dataType) for k in on]
    found: list[str | None] = [None] * len(on)
    mixed = [i for i, (a, b) in enumerate(pairs) if a != b]
    if not mixed:
        return found
    empty = left.sparkSession.range(0).select(
        *[F.lit(None).cast(kind).alias(f"{side}{i}") for i in mixed for side, kind in zip("ab", pairs[i])]
    )
    compared = empty.selectExpr(*[f"a{i} = b{i}" for i in mixed])
    outputs = compared._jdf.queryExecution().analyzed().expressions()
    for n, i in enumerate(mixed):
        value = outputs.apply(n).children().apply(0).children().apply(0)
        found[i] = value.dataType().sql()
    return found


def as_compared(on: Sequence[str], kinds: Sequence[str | None]) -> list[Column]:
    """The keys in the types of ``compared_types``."""
    return [col_of(k) if kind is None else col_of(k).cast(kind) for k, kind in zip(on, kinds)]


def _digest(df: DataFrame, schema: T.StructType, on: Sequence[str]) -> Column:
    """One hash of the key columns, in the types that ``schema`` has for them."""
    differing = [k for k in on if df.schema[k].dataType != schema[k].dataType]
    if differing:
        raise ValueError(f"keys of different types: {differing}")
    return F.expr(f"xxhash64({', '.join(hashable(df.schema[k]) for k in on)}) as {DIGEST}")


def salted_join(
    big: DataFrame,
    other: DataFrame,
    on: Sequence[str],
    how: str = "inner",
    rows_per_salt: int = ROWS_PER_SALT,
) -> DataFrame:
    """Join that spreads the hot keys of either side over many tasks.

    The rows of a hot key are dealt into parts, as many as their count needs, and the other
    side's rows with that key are repeated for each; where a key is hot on both sides the
    parts make a grid, so no task gets more than about ``rows_per_salt`` rows of it from
    either. All other keys join as usual. ``how`` is ``inner`` or ``left`` (all of ``big``).

    Keys of different types match as in a plain join, in the type that Spark compares them in: ``'01'``
    is the number 1. The result has the keys of ``big``.
    """
    if how not in ("inner", "left"):
        raise ValueError("a salted join is 'inner' or 'left'")
    kinds = compared_types(big, other, on)
    if any(kinds):
        # Both sides get the keys as they are compared; whatever is equal then has one digest.
        names = [f"__compared{i}" for i in range(len(on))]
        columns = [*on, *[c for c in big.columns if c not in on], *[c for c in other.columns if c not in on]]
        left = big.withColumns(dict(zip(names, as_compared(on, kinds))))
        right = other.withColumns(dict(zip(names, as_compared(on, kinds)))).drop(*on)
        return salted_join(left, right, names, how, rows_per_salt).select(*map(col_of, columns))
    # A null key matches nothing; only rows of ``big`` are kept without a match.
    other = other.where(f"not {any_null(on)}")
    hot = freeze(hot_keys(big, other, on, rows_per_salt))
    most = hot.agg(F.count("*").alias("n"), F.max(BIG_PARTS).alias(BIG_PARTS), F.max(OTHER_PARTS).alias(OTHER_PARTS)).first()
    if not most["n"]:
        return big.join(other, list(on), how)
    small = most["n"] * HOT_BYTES <= BROADCAST_BYTES
    left = _with_parts(big, big.schema, hot, on, small)
    right = _with_parts(other, big.schema, hot, on, small)
    columns = [*[c for c in big.columns if c in on], *[c for c in big.columns if c not in on]]
    left = _dealt(left, big.schema, BIG_PARTS, BIG_PART)
    if most[OTHER_PARTS] == 1:
        # no row of ``big`` is repeated, and the grid is a line
        right = _repeated(right, BIG_PARTS, BIG_PART).drop(BIG_PARTS, OTHER_PARTS)
        return left.drop(BIG_PARTS, OTHER_PARTS).join(right, [*on, BIG_PART], how).drop(BIG_PART)
    right = _dealt(right, other.schema, OTHER_PARTS, OTHER_PART)
    both = f"{OTHER_PARTS} > 1"
    if how == "inner":
        return _cells(left, right, on, how)
    # Repeated rows of ``big`` must not be kept once for each part: matches and misses apart.
    single, grid = left.where(f"not {both}"), left.where(both)
    joined = _cells(single, right.where(f"not {both}"), on, how)
    matched = _cells(grid, right.where(both), on, "inner")
    known = right.where(both).select(*[col_of(k) for k in on]).distinct()
    missed = grid.join(broadcast_if(measure(known).fits(), known), list(on), "left_anti")
    missed = missed.select(*[col_of(c) for c in columns])
    return joined.unionByName(matched).unionByName(missed, allowMissingColumns=True)


def _with_parts(
    df: DataFrame, schema: T.StructType, hot: DataFrame, on: Sequence[str], small: bool
) -> DataFrame:
    """The rows with the numbers of parts of their key; 1 for keys that are not hot."""
    found = df.withColumn(DIGEST, _digest(df, schema, on)).join(
        broadcast_if(small, hot), DIGEST, "left"
    )
    parts = [f"coalesce({p}, 1L) as {p}" for p in (BIG_PARTS, OTHER_PARTS)]
    return found.selectExpr(*[ref(c) for c in df.columns], *parts)


def _dealt(df: DataFrame, schema: T.StructType, parts: str, part: str) -> DataFrame:
    return df.withColumn(part, F.expr(f"if({parts} = 1, 0L, {stable_salt(schema, parts)})"))


def _repeated(df: DataFrame, parts: str, part: str) -> DataFrame:
    """Each row once for every part, by two numbers, so that no array is longer than the root
    of a large number of parts.

    The filters are always true. They keep the two generators apart: where one stands directly on the other, Spark 4.1
    loses struct fields that are read behind them.
    """
    high = f"explode(sequence(0L, ({parts} - 1) div {STRIDE})) as __high"
    low = f"explode(sequence(0L, least({STRIDE}L, {parts} - __high * {STRIDE}) - 1)) as __low"
    return (
        df.selectExpr("*", high)
        .where("__high >= 0")
        .selectExpr("*", low)
        .where("__low >= 0")
        .withColumn(part, F.expr(f"__high * {STRIDE} + __low"))
        .drop("__high", "__low")
    )


def _cells(left: DataFrame, right: DataFrame, on: Sequence[str], how: str) -> DataFrame:
    left = _repeated(left, OTHER_PARTS, OTHER_PART).drop(BIG_PARTS, OTHER_PARTS)
    right = _repeated(right, BIG_PARTS, BIG_PART).drop(BIG_PARTS, OTHER_PARTS)
    return left.join(right, [*on, *CELL], how).drop(*CELL)


def broadcast_join(
    big: DataFrame,
    other: DataFrame,
    on: Sequence[str],
    how: str = "inner",
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Join without shuffling ``big`` when ``other`` is measured as small, else a salted join."""
    if how not in ("inner", "left"):
        raise ValueError("a broadcast join is 'inner' or 'left'")
    if measure(other).fits(broadcast_bytes):
        return big.join(F.broadcast(other), list(on), how)
    return salted_join(big, other, on, how)


def use_adaptive_skew_join(
    spark: SparkSession,
    partition_bytes: str | None = None,
    factor: float | None = None,
) -> None:
    """Switch on Spark's own splitting of skewed shuffle partitions, optionally with limits.

    The settings are the session's: they hold for all that runs in it afterwards.
    """
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    if partition_bytes:
        name = "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes"
        spark.conf.set(name, partition_bytes)
    if factor:
        spark.conf.set("spark.sql.adaptive.skewJoin.skewedPartitionFactor", str(factor))


def adaptive_join(
    big: DataFrame, other: DataFrame, on: Sequence[str], how: str = "inner"
) -> DataFrame:
    """Sort-merge join whose skewed partitions AQE splits at run time.

    Splitting works on the written map outputs, needs no pass over the keys and leaves the
    plan lazy. Aggregate before the join rather than after it on the same key: a plan that
    relies on the join's partitioning is not split. The setting stays on in the session.
    """
    use_adaptive_skew_join(big.sparkSession)
    return big.join(other.hint("merge"), list(on), how)
