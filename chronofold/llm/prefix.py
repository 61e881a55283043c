"""Running totals over hash-ordered rows, without any one task seeing a whole group."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from chronofold.operators.sizing import broadcast_if

ROWS_PER_RANGE = 20_000
LEAST_BITS, MOST_BITS = 10, 20
# Starts of ranges, at most some 30 bytes each, that are sent to all tasks.
BROADCAST_RANGES = 1 << 16


def range_bits(rows: int) -> int:
    """Bits of a hash that cut ``rows`` rows into ranges of about ``ROWS_PER_RANGE``."""
    wanted = math.ceil(math.log2(max(1, rows) / ROWS_PER_RANGE)) if rows else 0
    return min(MOST_BITS, max(LEAST_BITS, wanted))


def range_of_hex(column: Column, bits: int) -> Column:
    """The range of a lower-case hex digest: its leading bits. Ordered as the digests are."""
    lead = F.conv(F.substring(column, 1, 5), 16, 10).cast("int")
    return F.coalesce(F.shiftright(lead, 20 - bits), F.lit(0))


def with_running_sum(
    df: DataFrame, by: Sequence[str], span: str, order: Sequence[str], value: str, upto: str, ranges: int
) -> DataFrame:
    """Adds ``upto``: the sum of ``value`` over the group's rows up to and with this one.

    ``span`` is a range number that grows with ``order``; no column of ``by`` may be null.
    Totals of the ranges are summed first and added to sums within each range, so a group is
    split over as many tasks as it has ranges. ``ranges`` is the most there can be in all groups
    together: where they are few, tasks look their starts up, so that rows are sorted only once.
    """
    keys = [*by, span]
    totals = df.groupBy(*keys).agg(F.sum(value).alias("_total"))
    earlier = Window.partitionBy(*by).orderBy(span).rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(*keys, F.coalesce(F.sum("_total").over(earlier), F.lit(0)).alias("_start"))
    within = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return (
        df.join(broadcast_if(ranges <= BROADCAST_RANGES, starts), keys)
        .withColumn(upto, F.sum(value).over(within) + F.col("_start"))
        .drop("_start")
    )
