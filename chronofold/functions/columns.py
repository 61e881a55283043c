"""Column expressions used by several operators.

Longer conditions are written as one SQL expression: the same tree for Catalyst, and one call
to the JVM in place of one per function.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, functions as F, types as T

# Fixed value: the end date of a version that is still open.
OPEN_END = "9999-12-31"
OPEN_END_SQL = f"DATE'{OPEN_END}'"


def quoted(name: str) -> str:
    """Back-tick a column name so that dots in it are taken literally."""
    return "`" + name.replace("`", "``") + "`"


def ref(name: str, relation: str | None = None) -> str:
    """A column as SQL text, of the relation with that alias if one is named."""
    return f"{relation}.{quoted(name)}" if relation else quoted(name)


_STEP = re.compile(r"`((?:[^`]|``)+)`|([^.`]+)")


def path_steps(path: str) -> list[str]:
    """The names along a dotted path; a name in back-ticks is taken literally, dots included.

    The empty path has no steps: it names the value itself.
    """
    steps = [(m[1] or "").replace("``", "`") or m[2] for m in _STEP.finditer(path)]
    if ".".join(m[0] for m in _STEP.finditer(path)) != path:
        raise ValueError(f"{path!r} is not a path of names with dots between")
    return steps


def at_path(path: str, relation: str | None = None) -> Column:
    """The value that a dotted path leads to, from a relation or from a struct column."""
    return F.col(".".join(quoted(step) for step in [*([relation] if relation else []), *path_steps(path)]))


def col_of(name: str, relation: str | None = None) -> Column:
    return F.col(ref(name, relation))


def text(value: str) -> str:
    """A string as a SQL literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def keys_equal(keys: Sequence[str], left: str, right: str) -> Column:
    return F.expr(" AND ".join(f"{ref(k, left)} = {ref(k, right)}" for k in keys))


def keys_same(keys: Sequence[str], left: str, right: str) -> Column:
    """As ``keys_equal``, with nulls equal to each other."""
    return F.expr(" AND ".join(f"{ref(k, left)} <=> {ref(k, right)}" for k in keys))


def any_differs(columns: Sequence[str], left: str, right: str) -> str:
    """SQL that is true when any column differs, two nulls taken as equal; never null."""
    same = " AND ".join(f"{ref(c, left)} <=> {ref(c, right)}" for c in columns)
    return f"(NOT ({same}))"


def any_null(columns: Sequence[str]) -> str:
    return "(" + " OR ".join(f"{ref(c)} IS NULL" for c in columns) + ")"


def ascending_or_descending(order: Mapping[str, str]) -> list[Column]:
    """``{"price": "desc", "id": "asc"}`` as sort expressions, in that order."""
    unknown = {d for d in order.values()} - {"asc", "desc"}
    if unknown:
        raise ValueError(f"sort directions must be 'asc' or 'desc', got {sorted(unknown)}")
    return [col_of(c).desc() if d == "desc" else col_of(c).asc() for c, d in order.items()]


def _unhashable(data_type: T.DataType) -> bool:
    if isinstance(data_type, T.StructType):
        return any(_unhashable(f.dataType) for f in data_type.fields)
    if isinstance(data_type, T.ArrayType):
        return _unhashable(data_type.elementType)
    return isinstance(data_type, (T.MapType, T.VariantType))


def hashable(field: T.StructField, relation: str | None = None) -> str:
    """SQL for a value that ``xxhash64`` takes: columns that hold maps or variants as JSON text."""
    name = ref(field.name, relation)
    return f"to_json(named_struct('v', {name}))" if _unhashable(field.dataType) else name


def stable_salt(schema: T.StructType, salts: str, relation: str | None = None) -> str:
    """SQL for a number below ``salts`` that a retried task computes again for the same row.

    The input partition is hashed in too, so that many identical rows still spread. A row's
    partition, unlike its position there, is the same when a lost task runs again.
    """
    hashed = ", ".join(["spark_partition_id()", *[hashable(f, relation) for f in schema.fields]])
    return f"pmod(xxhash64({hashed}), {salts})"


# Widths of values that always take the same room.
_FIXED = (
    T.BooleanType, T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType,
    T.DateType, T.TimestampType, T.TimestampNTZType, T.NullType, T.DayTimeIntervalType,
    T.YearMonthIntervalType,
)


def _width(value: str, data_type: T.DataType, depth: int = 0) -> str | None:
    """SQL for the bytes that a value takes, nulls included; None for a type without a rule."""
    if isinstance(data_type, _FIXED):
        return "8L"
    if isinstance(data_type, T.DecimalType):
        return "24L"
    if isinstance(data_type, (T.StringType, T.BinaryType)):
        return f"(16L + coalesce(octet_length({value}), 0))"
    if isinstance(data_type, T.VariantType):
        return f"(32L + coalesce(octet_length(to_json({value})), 0))"
    if isinstance(data_type, T.StructType):
        parts = [_width(f"{value}.{quoted(f.name)}", f.dataType, depth) for f in data_type.fields]
        return None if None in parts else f"({' + '.join(['16L', *parts])})"
    if isinstance(data_type, T.MapType):
        keys = _width(f"map_keys({value})", T.ArrayType(data_type.keyType), depth)
        values = _width(f"map_values({value})", T.ArrayType(data_type.valueType), depth)
        return None if None in (keys, values) else f"({keys} + {values})"
    if isinstance(data_type, T.ArrayType):
        item, total = f"x{depth}", f"n{depth}"
        width = _width(item, data_type.elementType, depth + 1)
        if width is None:
            return None
        if "(" not in width:
            return f"(24L + {width} * greatest(coalesce(size({value}), 0), 0))"
        added = f"aggregate({value}, 0L, ({total}, {item}) -> {total} + {width})"
        return f"(24L + coalesce({added}, 0L))"
    return None


def row_bytes(schema: T.StructType) -> Column | None:
    """In-memory width of a row from its types and contents; None if a type has no rule."""
    parts = [_width(ref(f.name), f.dataType) for f in schema.fields]
    return None if None in parts else F.expr(" + ".join(["16L", *parts]))
