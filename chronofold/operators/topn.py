"""Top N rows per group."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window, functions as F

from chronofold.functions import ascending_or_descending, col_of, stable_salt
from chronofold.operators.sizing import BROADCAST_BYTES, measure
from chronofold.operators.skew import salted_join
from chronofold.sources.scratch import freeze

POSITION = "__position"
PART = "__part"
KEY = "__key"


def top_rows(
    df: DataFrame,
    n: int,
    by: Sequence[str],
    order: Mapping[str, str],
    column: str | None = None,
) -> DataFrame:
    """Exactly ``n`` rows per group by ``row_number``; ``column`` keeps the number.

    Spark limits every map task to ``n`` rows per group before the shuffle, so the size of a
    group does not matter.
    """
    name = column or POSITION
    spark = df.sparkSession
    if n > int(spark.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000")):
        # Spark sets no limit before the shuffle here, so each group is first cut down in
        # parts, as many as there are shuffle partitions.
        parts = spark.conf.get("spark.sql.shuffle.partitions")
        salted = df.selectExpr("*", f"{stable_salt(df.schema, parts)} as {PART}")
        df = _first(salted, n, [*by, PART], order, POSITION).drop(PART, POSITION)
    rows = _first(df, n, by, order, name)
    return rows if column else rows.drop(name)


def top_rows_of(
    df: DataFrame,
    wanted: DataFrame,
    n: int,
    by: Sequence[str],
    order: Mapping[str, str],
    column: str | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """``top_rows`` of the groups that another table names, in its columns ``by``.

    Where ``df`` is stored in partitions of these columns and ``wanted`` is measured as small, Spark reads the partitions of the
    wanted groups only, although they are known no sooner than the query runs.
    """
    keys = wanted.select(*[col_of(c) for c in by]).distinct()
    small = measure(keys).fits(broadcast_bytes)
    mine = df.join(F.broadcast(keys) if small else keys, list(by), "left_semi")
    return top_rows(mine.select(*[col_of(c) for c in df.columns]), n, by, order, column)


def _first(df, n, by, order, name) -> DataFrame:
    window = Window.partitionBy(*[col_of(c) for c in by]).orderBy(*ascending_or_descending(order))
    return df.withColumn(name, F.row_number().over(window)).where(col_of(name) <= n)


def top_ranked(
    df: DataFrame,
    n: int,
    by: Sequence[str],
    order: Mapping[str, str],
    dense: bool = False,
    column: str = "rank",
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """All rows whose ``rank`` (or ``dense_rank``) in their group is at most ``n``.

    Ties at the cut stay, so a group can return any number of rows, and a plain window would
    send them all to one task. Here the window runs on the order columns only, to find the at
    most ``n`` best values per group, and the rows are then picked by a join on those values:
    broadcast where the table of values is measured as small, else a salted join, which
    spreads the ties of one value as well.
    """
    columns = [*by, *order]
    values = df.select(*[col_of(c) for c in columns])
    if dense:
        best = top_rows(values.distinct(), n, by, order, column)
    else:
        best = (
            top_rows(values, n, by, order, POSITION)
            .groupBy(*[col_of(c) for c in columns])
            .agg(F.min(POSITION).alias(column))
        )
    best = freeze(best)
    # A struct of the columns is an ordinary join key in which nulls are equal.
    key = F.struct(*[col_of(c) for c in columns]).alias(KEY)
    rows, cut = df.select("*", key), best.select(key, col_of(column))
    if measure(best).fits(broadcast_bytes):
        joined = rows.join(F.broadcast(cut), KEY)
    else:
        joined = salted_join(rows, cut, [KEY])
    return joined.select(*[col_of(c) for c in [*df.columns, column]])
