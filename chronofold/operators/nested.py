"""Nested records to flat rows."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from chronofold.functions import at_path, col_of

ITEM = "__item"


def flatten_records(
    df: DataFrame,
    array: str,
    parents: Mapping[str, str],
    items: Mapping[str, str],
    outer: bool = True,
    position: str | None = None,
) -> DataFrame:
    """One row per element of ``array``.

    ``parents`` maps output names to paths in the record (``"customer.name"``), ``items``
    maps output names to paths in the element; the empty path is the element itself, which is
    how arrays of plain values are flattened. Names that hold a dot go in back-ticks. With ``outer`` a record whose array is null
    or empty stays as one row of null item columns; without it the record is left out.
    ``position`` names an extra column with the element's index: it is null only for such
    kept records, which tells them from an element that is itself null.

    Nothing is shuffled and a filter on parent columns still reaches the scan. A caller who
    filters on item columns anyway should pass ``outer=False``, so that Spark can skip empty
    arrays before the explode.
    """
    values = at_path(array)
    if position:
        generator = F.posexplode_outer(values) if outer else F.posexplode(values)
        exploded = generator.alias(position, ITEM)
    else:
        generator = F.explode_outer(values) if outer else F.explode(values)
        exploded = generator.alias(ITEM)
    rows = df.select(*[at_path(path).alias(name) for name, path in parents.items()], exploded)
    return rows.select(
        *[col_of(name) for name in parents],
        *([col_of(position)] if position else []),
        *[at_path(path, ITEM).alias(name) for name, path in items.items()],
    )


def flatten_structs(df: DataFrame, sep: str = "_", on_collision: str = "error") -> DataFrame:
    """Every struct field at any depth as a top-level ``parent<sep>child`` column.

    Arrays and maps are left as they are, and an empty struct has no column to leave. The
    schema is walked once and gives a single projection. Two paths that end in one name
    raise ``ValueError``, or get ``<sep>2``, ``<sep>3`` … with ``on_collision="number"``.
    """
    if on_collision not in ("error", "number"):
        raise ValueError("on_collision must be 'error' or 'number'")
    leaves = [leaf for f in df.schema.fields for leaf in _leaves(f, col_of(f.name), f.name, sep)]
    counts = Counter(name.lower() for name, _ in leaves)
    clashes = sorted(name for name, n in counts.items() if n > 1)
    if clashes and on_collision == "error":
        raise ValueError(f"flattened column names collide: {', '.join(clashes)}")
    taken: set[str] = set()
    columns = []
    for name, column in leaves:
        unique, n = name, 1
        while unique.lower() in taken or (n > 1 and unique.lower() in counts):
            n += 1
            unique = f"{name}{sep}{n}"
        taken.add(unique.lower())
        columns.append(column.alias(unique))
    return df.select(*columns)


def _leaves(field: T.StructField, column: Column, name: str, sep: str) -> Iterator[tuple]:
    if isinstance(field.dataType, T.StructType):
        for child in field.dataType.fields:
            yield from _leaves(child, column.getField(child.name), f"{name}{sep}{child.name}", sep)
    else:
        yield name, column


def explode_map(
    df: DataFrame,
    map_column: str,
    keep: Sequence[str],
    key: str = "key",
    value: str = "value",
    outer: bool = True,
) -> DataFrame:
    """One row per entry of a map column; with ``outer`` null and empty maps keep their row."""
    generator = F.explode_outer(map_column) if outer else F.explode(map_column)
    return df.select(*[col_of(c) for c in keep], generator.alias(key, value))
