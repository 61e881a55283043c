"""Keyed updates and upserts as pure functions: old rows and a batch give the new rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from chronofold.functions import any_null, col_of, keys_equal, quoted, ref
from chronofold.operators.dedup import keep_latest
from chronofold.operators.sizing import BROADCAST_BYTES, measure_by_key
from chronofold.operators.skew import ROWS_PER_SALT, as_compared, compared_types, salted_join

MATCHED = "__matched"


class DuplicateKeys(ValueError):
    """A batch holds several rows for one key and no order says which one counts."""


def prepare_batch(
    batch: DataFrame,
    keys: Sequence[str],
    order: Mapping[str, str] | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
    target: DataFrame | None = None,
) -> tuple[DataFrame, bool]:
    """One row per key, and whether the batch is small enough to broadcast.

    With ``order`` the first row per key wins; without it a repeated key raises
    ``DuplicateKeys``. Rows with a null in the key equal no other row and all stay. Both
    answers come from one aggregate job over the batch. Where ``target`` has keys of another type, keys are the
    same if they are compared with it as the same: ``'01'`` and ``'1'`` are one key of a table with numbers.
    """
    kinds = compared_types(target, batch, keys) if target is not None else []
    if any(kinds):
        names = [f"__key{i}" for i in range(len(keys))]
        typed = batch.withColumns(dict(zip(names, as_compared(keys, kinds))))
        typed, small = prepare_batch(typed, names, order, broadcast_bytes)
        return typed.drop(*names), small
    if order:
        keyless = any_null(keys)
        latest = keep_latest(batch.where(f"not {keyless}"), keys, order)
        batch = latest.unionByName(batch.where(keyless))
    size = measure_by_key(batch, keys)
    if size.most_per_key > 1:
        raise DuplicateKeys(
            f"batch holds up to {size.most_per_key} rows for one value of ({', '.join(keys)})"
        )
    return batch, size.fits(broadcast_bytes)


def _in_type(value: Column | str, field: T.StructField) -> Column:
    """An expression over ``t`` and ``s`` cast to a target column."""
    if isinstance(value, str):
        return F.expr(f"cast(({value}) as {field.dataType.simpleString()}) as {quoted(field.name)}")
    return value.cast(field.dataType).alias(field.name)


def merge_update(
    target: DataFrame,
    batch: DataFrame,
    on: Sequence[str],
    set: Mapping[str, Column | str],
    when: Column | str | None = None,
    order: Mapping[str, str] | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
    rows_per_salt: int = ROWS_PER_SALT,
) -> DataFrame:
    """All target rows, with ``set`` applied to those that match a batch row.

    Expressions may refer to the target as ``t`` and the batch as ``s``. Batch rows without
    a target row are ignored. A small batch is broadcast and the target is not shuffled;
    with a larger one target keys of more than ``rows_per_salt`` rows are spread.
    """
    batch, small = prepare_batch(batch, on, order, broadcast_bytes, target)
    return updated(target, batch, on, set, when, small, rows_per_salt)


def merge_upsert(
    target: DataFrame,
    batch: DataFrame,
    on: Sequence[str],
    set: Mapping[str, Column | str],
    values: Mapping[str, Column | str],
    order: Mapping[str, str] | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
    rows_per_salt: int = ROWS_PER_SALT,
) -> DataFrame:
    """``merge_update`` plus one new row, built by ``values``, per batch row without a match.

    Each batch row takes one of the two branches, never both. A batch row with a null key
    matches nothing and is added.
    """
    batch, small = prepare_batch(batch, on, order, broadcast_bytes, target)
    missing = [c for c in values if c not in target.columns]
    if missing:
        raise ValueError(f"values name columns the target does not have: {missing}")
    present = keys_present(target, batch, on, small)
    added = (
        batch.alias("s")
        .join(present.alias("p"), keys_equal(on, "s", "p"), "left_anti")
        .select(*[_in_type(values.get(f.name, "null"), f) for f in target.schema.fields])
    )
    return updated(target, batch, on, set, None, small, rows_per_salt).unionByName(added)


def scd1_apply(
    target: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str] | None = None,
    order: Mapping[str, str] | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
    rows_per_salt: int = ROWS_PER_SALT,
) -> DataFrame:
    """Overwrite ``columns`` (all but the keys by default) without history; add new keys."""
    columns = list(columns or [c for c in target.columns if c not in keys])
    given = {c: ref(c, "s") for c in columns}
    return merge_upsert(
        target,
        batch,
        keys,
        set=given,
        values={**{k: ref(k, "s") for k in keys}, **given},
        order=order,
        broadcast_bytes=broadcast_bytes,
        rows_per_salt=rows_per_salt,
    )


def keys_present(
    target: DataFrame, batch: DataFrame, keys: Sequence[str], small: bool
) -> DataFrame:
    """The distinct target keys that occur in the batch; reads the key columns only.

    Keys are made distinct in the map tasks first, so a key with a long history costs one row
    per task.
    """
    columns = [col_of(k) for k in keys]
    if not small:
        return target.select(*columns).distinct()
    wanted = F.broadcast(batch.select(*columns))
    return target.select(*columns).join(wanted, list(keys), "left_semi").distinct()


def updated(
    target: DataFrame,
    batch: DataFrame,
    on: Sequence[str],
    set: Mapping[str, Column | str],
    when: Column | str | None,
    small: bool,
    rows_per_salt: int = ROWS_PER_SALT,
) -> DataFrame:
    """``merge_update`` for a batch that ``prepare_batch`` has been through.

    In the shuffle plan target rows with a null key, which match nothing, stay out of the
    join, and keys with very many target rows are dealt over several tasks.
    """
    unknown = [c for c in set if c not in target.columns]
    if unknown:
        raise ValueError(f"set names columns the target does not have: {unknown}")
    applies = F.expr(f"coalesce({MATCHED}, false)")
    if when is not None:
        applies = applies & (F.expr(when) if isinstance(when, str) else when)
    columns = [
        F.when(applies, _in_type(set[f.name], f)).otherwise(col_of(f.name, "t")).alias(f.name)
        if f.name in set
        else col_of(f.name, "t")
        for f in target.schema.fields
    ]
    if small:
        source = F.broadcast(batch.withColumn(MATCHED, F.lit(True))).alias("s")
        return target.alias("t").join(source, keys_equal(on, "t", "s"), "left").select(*columns)
    # The sides' columns get names of their own for the join; after it they are ``t.`` and ``s.``
    # again, as structs that Catalyst takes apart at once.
    keys = [f"__on{i}" for i in range(len(on))]
    left, right = (
        df.select(
            *[col_of(k).alias(name) for k, name in zip(on, keys)],
            *[col_of(c).alias(f"__{side}{i}") for i, c in enumerate(df.columns)],
        )
        for df, side in ((target.where(f"not {any_null(on)}"), "t"), (batch, "s"))
    )
    right = right.withColumn(MATCHED, F.lit(True))
    sides = [
        F.struct(*[F.col(f"__{side}{i}").alias(c) for i, c in enumerate(df.columns)]).alias(side)
        for df, side in ((target, "t"), (batch, "s"))
    ]
    joined = salted_join(left, right, keys, "left", rows_per_salt)
    joined = joined.select(*sides, MATCHED).select(*columns)
    return joined.unionByName(target.where(any_null(on)))
