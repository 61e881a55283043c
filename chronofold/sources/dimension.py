"""A stored type 2 dimension whose closed history is never rewritten.

``<table>__rows`` is partitioned by the current flag and by commit number. A commit adds two
partitions: the versions it closed, and the full set of current versions. Readers use the
view ``<table>``: the closed partitions of all commits up to the live one and the current
partition of that one. The view is replaced last, in one catalog change, so a commit that
fails before has no visible effect and its partitions are dropped by the next attempt.

Partition filters of the view mean that a query on current versions reads none of the
closed ones, and a commit reads only their key columns.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from chronofold.functions import quoted
from chronofold.operators.scd2 import INNER, Dimension, pinned_date, scd2_actions
from chronofold.operators.sizing import BROADCAST_BYTES
from chronofold.sources.scratch import freeze
from chronofold.sources.tables import (
    DIMENSION,
    OWNER_PROPERTY,
    add_audit,
    claim,
    live_version,
    owner_name,
    point_view,
    table_name,
)

COMMIT = "__commit"

# Metric names by the action of scd2_actions that they count.
METRICS = {
    "expired": "expired",
    "changed": "inserted_changed",
    "new": "inserted_new",
    "reopened": "reopened",
    "amended": "amended",
    "unchanged": "unchanged",
}


def create_dimension(df: DataFrame, table: str, dim: Dimension) -> None:
    """Store a first snapshot, current and closed versions, as commit 0.

    A version without a flag is stored as closed, which is how all operators take it.
    """
    spark = df.sparkSession
    if live_version(spark, table) is not None or spark.catalog.tableExists(table):
        raise ValueError(f"{table} exists")
    rows = f"{table}__rows"
    claim(spark, rows, table)
    attributes = [c for c in df.columns if c != dim.current]
    flag = F.coalesce(quoted(dim.current), F.lit(False)).alias(dim.current)
    first = df.select(*[quoted(c) for c in attributes], flag, F.lit(0).alias(COMMIT))
    write = first.writeTo(table_name(rows)).using("parquet")
    write = write.tableProperty(OWNER_PROPERTY, owner_name(table))
    write.partitionedBy(F.col(quoted(dim.current)), F.col(COMMIT)).create()
    add_audit(spark, table, 0, "CREATE", {})
    _show(spark, table, df.columns, dim, 0)


def commit_dimension(
    spark: SparkSession,
    table: str,
    batch: DataFrame,
    dim: Dimension,
    as_of: dt.date | None = None,
    order: Mapping[str, str] | None = None,
    reopen_closed: bool = False,
    same_day: str = "replace",
    broadcast_bytes: int = BROADCAST_BYTES,
    rebalance: bool = False,
) -> dict[str, int]:
    """Apply a batch to a stored dimension in one write job; returns its counts.

    The batch is written to the shared folder first, so every part of the plan sees the same
    rows, and it is computed once. ``rebalance`` shuffles the new rows into files of Spark's
    advisory size; without it every task writes its own, which is cheaper but can leave
    many small files of closed versions.

    All current versions are written anew, whatever the size of the batch. Those of the commit
    before stay for queries that already run, older ones are dropped at the end.
    """
    live = live_version(spark, table, DIMENSION)
    if live is None:
        raise ValueError(f"{table} is not a stored dimension")
    commit = live + 1
    target = spark.table(table)
    actions = scd2_actions(
        target,
        freeze(batch),
        dim,
        pinned_date(spark, as_of),
        order,
        reopen_closed,
        same_day,
        broadcast_bytes,
        INNER,
    )
    _drop_leftovers(spark, table, dim, commit)
    if rebalance:
        actions = actions.hint("rebalance", dim.current)
    rows = f"{table}__rows"
    # Observed in the writing stage, so rows that a lost task repeats are counted once.
    seen = Observation()
    counted = actions.observe(
        seen, *[F.count_if(F.col(INNER) == a).alias(m) for a, m in METRICS.items()]
    )
    stored = [c for c in spark.table(rows).columns if c != COMMIT]
    counted.select(*[quoted(c) for c in stored], F.lit(commit).alias(COMMIT)).write.mode(
        "append"
    ).insertInto(rows)
    metrics = seen.get
    add_audit(spark, table, commit, "SCD2", metrics)
    _show(spark, table, target.columns, dim, commit)
    forget_old_snapshots(spark, table, dim)
    return metrics


def forget_old_snapshots(spark: SparkSession, table: str, dim: Dimension) -> None:
    """Drop current-version partitions that only commits before the previous one used."""
    live = live_version(spark, table)
    for row in spark.sql(f"SHOW PARTITIONS {table_name(f'{table}__rows')}").collect():
        flag, commit = (part.split("=")[1] for part in row["partition"].split("/"))
        if flag == "true" and int(commit) < live - 1:
            _drop_partition(spark, table, dim, flag, commit)


def _drop_leftovers(spark: SparkSession, table: str, dim: Dimension, commit: int) -> None:
    for flag in ("true", "false"):
        _drop_partition(spark, table, dim, flag, commit)


def _drop_partition(spark, table, dim, flag, commit) -> None:
    spark.sql(
        f"ALTER TABLE {table_name(f'{table}__rows')} DROP IF EXISTS "
        f"PARTITION ({quoted(dim.current)} = {flag}, {quoted(COMMIT)} = {commit})"
    )


def _show(spark, table, columns, dim, commit) -> None:
    current, number = quoted(dim.current), quoted(COMMIT)
    point_view(
        spark,
        table,
        commit,
        f"SELECT {', '.join(quoted(c) for c in columns)} FROM {table_name(f'{table}__rows')} "
        f"WHERE (NOT {current} AND {number} <= {commit}) OR ({current} AND {number} = {commit})",
        DIMENSION,
    )
