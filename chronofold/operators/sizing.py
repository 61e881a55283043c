"""Measured sizes, so that a side of a join is broadcast only when it is known to be small."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from chronofold.functions import any_null, col_of, row_bytes

# Largest relation that operators broadcast; anything wider goes through a shuffle join.
BROADCAST_BYTES = 64 * 1024 * 1024
# Stands for the size of a relation with a type whose width is not known: never small.
UNKNOWN_BYTES = 1 << 62


@dataclass(frozen=True)
class Size:
    rows: int
    bytes: int
    most_per_key: int = 0

    def fits(self, limit: int = BROADCAST_BYTES) -> bool:
        return self.bytes <= limit


def measure(df: DataFrame) -> Size:
    """Rows and bytes of a relation: one aggregate job, one row to the driver."""
    row = df.agg(
        F.count("*").alias("n"), F.coalesce(F.sum(_width_of(df)), F.lit(0)).alias("b")
    ).first()
    return Size(row["n"], _known(df, row["b"]))


def measure_by_key(df: DataFrame, keys: Sequence[str]) -> Size:
    """As ``measure``, plus the number of rows on the most frequent key without a null.

    Counts are combined before the shuffle, so one key with most of the rows costs no more
    than any other.
    """
    per_key = df.groupBy(*[col_of(k) for k in keys]).agg(
        F.count("*").alias("n"), F.sum(_width_of(df)).alias("b")
    )
    row = per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n"),
        F.coalesce(F.sum("b"), F.lit(0)).alias("b"),
        F.expr(f"coalesce(max(if({any_null(keys)}, 1, n)), 0) as most"),
    ).first()
    return Size(row["n"], _known(df, row["b"]), row["most"])


def _width_of(df: DataFrame) -> Column:
    width = row_bytes(df.schema)
    return F.lit(0).cast("bigint") if width is None else width


def _known(df: DataFrame, summed: int) -> int:
    return UNKNOWN_BYTES if row_bytes(df.schema) is None else summed


def broadcast_if(small: bool, df: DataFrame) -> DataFrame:
    return F.broadcast(df) if small else df
