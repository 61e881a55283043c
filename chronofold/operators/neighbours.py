"""Earlier and later rows of a key in an order, whatever the number of its rows.

Rows are dealt out by ranges of key and order, so a long key is spread over tasks. A window looks at the
rows of one task; what lies beyond comes from a table with one row for each task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from chronofold.functions import col_of, ref
from chronofold.sources.scratch import freeze

TASK, POSITION = "__task", "__position"


def in_order(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """The rows with their place in the order of keys and ``order``, written to the shared folder.

    Equal rows of this order may be dealt to different tasks, in any order.
    """
    dealt = df.withColumn("__dealt", F.monotonically_increasing_id())
    by = [*[col_of(k) for k in keys], *[F.col(o) if isinstance(o, str) else o for o in order], F.col("__dealt")]
    placed = dealt.repartitionByRange(*by).sortWithinPartitions(*by).drop("__dealt")
    return freeze(placed.withColumns({TASK: F.spark_partition_id(), POSITION: F.monotonically_increasing_id()}))


def nearest(
    placed: DataFrame, keys: Sequence[str], found: dict[str, tuple[str, str]], later: bool = False
) -> DataFrame:
    """Adds columns with values of the nearest earlier (or later) row of the same key that fits.

    ``found`` has for each new column SQL for its value, which must not be null, and for the condition that a row
    has to meet; null where there is none. ``placed`` comes from ``in_order``, with rows in any arrangement.
    """
    edge, near = (F.min, F.first) if later else (F.max, F.last)
    side = (1, Window.unboundedFollowing) if later else (Window.unboundedPreceding, -1)
    own = Window.partitionBy(TASK, *[col_of(k) for k in keys]).orderBy(POSITION).rowsBetween(*side)
    within = {
        name: near(F.expr(f"if({fits}, {value}, null)"), ignorenulls=True).over(own) for name, (value, fits) in found.items()
    }
    key = F.struct(*[col_of(k).alias(f"k{i}") for i, k in enumerate(keys)])
    tasks = placed.groupBy(TASK).agg(
        *[
            edge(F.when(F.expr(fits), F.struct(F.col(POSITION), key.alias("key"), F.expr(value).alias("value")))).alias(name)
            for name, (value, fits) in found.items()
        ]
    )
    # one row for each task
    beyond = Window.orderBy(TASK).rowsBetween(*side)
    edges = tasks.select(TASK, *[near(col_of(name), ignorenulls=True).over(beyond).alias(f"__{name}") for name in found])
    joined = placed.withColumns(within).join(F.broadcast(edges), TASK)
    same = {
        name: F.coalesce(
            col_of(name),
            F.when(
                F.expr(" AND ".join(f"`__{name}`.key.k{i} <=> {ref(k)}" for i, k in enumerate(keys))),
                F.col(f"`__{name}`.value"),
            ),
        )
        for name in found
    }
    return joined.withColumns(same).drop(*[f"__{name}" for name in found])


def without_place(df: DataFrame) -> DataFrame:
    return df.drop(TASK, POSITION)
