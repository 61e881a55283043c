"""JSON text columns to typed columns."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator, Mapping, Sequence

from pyspark.sql import DataFrame, functions as F, types as T

from chronofold.functions import col_of, path_steps, text
from chronofold.operators.nested import flatten_records
from chronofold.sources.tables import append_rows, live_version, publish

PARSED = "__parsed"
ELEMENTS = "__elements"
CORRUPT = "_corrupt_record"


def parse_json(
    df: DataFrame,
    column: str,
    schema: T.StructType | str,
    mode: str = "PERMISSIVE",
    keep: Sequence[str] = (),
    corrupt: str | None = None,
) -> DataFrame:
    """The fields of a JSON text column as columns, after the ``keep`` columns.

    In permissive mode missing fields and fields of the wrong type are null, unknown fields
    are ignored, names are case-sensitive, and text that is no JSON object gives a row of
    nulls. ``corrupt`` names an extra column that holds the whole text of such a record
    and of one with a field of the wrong type, null for a clean record. ``FAILFAST`` fails
    the job instead. Give only the fields that are used: the parser skips the others.
    """
    fields = _struct(schema)
    options = {"mode": mode}
    if corrupt:
        fields = T.StructType([*fields.fields, T.StructField(corrupt, T.StringType())])
        options["columnNameOfCorruptRecord"] = corrupt
    parsed = df.select(
        *[col_of(c) for c in keep], F.from_json(col_of(column), fields, options).alias(PARSED)
    )
    return parsed.select(*[col_of(c) for c in keep], f"{PARSED}.*")


def split_rejects(parsed: DataFrame, corrupt: str = CORRUPT) -> tuple[DataFrame, DataFrame]:
    """Clean rows and rejected rows of ``parse_json(..., corrupt=...)``."""
    return parsed.where(col_of(corrupt).isNull()).drop(corrupt), parsed.where(
        col_of(corrupt).isNotNull()
    )


def flatten_json(
    df: DataFrame,
    column: str,
    schema: T.StructType | str,
    array: str,
    parents: Mapping[str, str],
    items: Mapping[str, str],
    outer: bool = True,
    mode: str = "PERMISSIVE",
) -> DataFrame:
    """Parse a JSON text column and flatten it to one row per array element.

    Only the fields that ``parents`` and ``items`` name are parsed, whatever else ``schema``
    has; with ``FAILFAST`` all of them are, so that each is checked.
    """
    fields = _struct(schema)
    if mode == "PERMISSIVE":
        within = [f"{array}.{path}" if path else array for path in items.values()]
        fields = narrowed(fields, [*parents.values(), *within])
    return flatten_records(parse_json(df, column, fields, mode), array, parents, items, outer)


def narrowed(schema: T.StructType, paths: Sequence[str]) -> T.StructType:
    """The part of a schema that the dotted paths reach, through structs and arrays of structs."""
    return _narrowed_struct(schema, [path_steps(path) for path in paths])


def _narrowed_struct(schema: T.StructType, paths: Sequence[Sequence[str]]) -> T.StructType:
    wanted: dict[str, list[Sequence[str]]] = {}
    for head, *rest in paths:
        wanted.setdefault(head.lower(), []).append(rest)
    return T.StructType(
        [
            T.StructField(f.name, _narrowed_type(f.dataType, wanted[f.name.lower()]), f.nullable)
            for f in schema.fields
            if f.name.lower() in wanted
        ]
    )


def _narrowed_type(data_type: T.DataType, rests: Sequence[Sequence[str]]) -> T.DataType:
    if not all(rests):
        return data_type
    if isinstance(data_type, T.StructType):
        return _narrowed_struct(data_type, rests)
    if isinstance(data_type, T.ArrayType):
        return T.ArrayType(_narrowed_type(data_type.elementType, rests), data_type.containsNull)
    return data_type


def infer_json_schema(df: DataFrame, column: str, fractions: str = "double") -> T.StructType:
    """The schema that covers every record of a JSON text column; a field that is always null is a string.

    A distributed aggregate over all rows; only the schema itself reaches the driver. Text
    that is not a JSON object is skipped. Whole numbers become ``bigint``, or a decimal that
    holds all their digits; numbers with a fraction ``double``, or with ``fractions="decimal"`` a
    decimal too.
    """
    found = _inferred(df, column, fractions)
    if found is None:
        raise ValueError(f"column {column} holds no JSON object")
    return _settled(found)


def _inferred(df: DataFrame, column: str, fractions: str) -> T.StructType | None:
    """The schema with ``void`` for fields that are always null; none where there is no object."""
    if fractions not in ("double", "decimal"):
        raise ValueError("fractions must be 'double' or 'decimal'")
    # What begins with a brace is an object or no JSON, so each text is parsed once.
    objects = df.where(F.ltrim(col_of(column), F.lit(" \t\n\r")).startswith("{"))
    records = objects.select(F.try_parse_json(col_of(column)).alias("v"))
    found = records.agg(F.expr("schema_of_variant_agg(v)").alias("s")).first()["s"]
    return _struct(_as_ddl(found, fractions)) if found and found.startswith("OBJECT<") else None


def _settled(kind: T.DataType) -> T.DataType:
    """A type with strings where nothing but nulls was seen."""
    if isinstance(kind, T.NullType):
        return T.StringType()
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_settled(kind.elementType))
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _settled(f.dataType)) for f in kind.fields])
    return kind


def merged_schema(one: T.DataType, other: T.DataType) -> T.DataType:
    """The least type that holds the values of both.

    ``void`` is below all types. Whole numbers, decimals and doubles widen; structs have the fields of either, the new ones
    behind; arrays hold what either's elements need. Types that have nothing in common become ``string``, which is above all: it holds
    the JSON text of any value. The order of merging does not matter, but for the order of fields.
    """
    if one == other or isinstance(other, T.NullType):
        return one
    if isinstance(one, T.NullType):
        return other
    if isinstance(one, T.StructType) and isinstance(other, T.StructType):
        theirs = {f.name: f.dataType for f in other.fields}
        fields = [(f.name, merged_schema(f.dataType, theirs.pop(f.name, T.NullType()))) for f in one.fields]
        return T.StructType([T.StructField(name, kind) for name, kind in [*fields, *theirs.items()]])
    if isinstance(one, T.ArrayType) and isinstance(other, T.ArrayType):
        return T.ArrayType(merged_schema(one.elementType, other.elementType))
    numbers = [_number(one), _number(other)]
    if None in numbers:
        return T.StringType()
    if any(n == "double" for n in numbers):
        return T.DoubleType()
    (whole, scale), (whole2, scale2) = numbers
    digits, scale = max(whole, whole2), max(scale, scale2)
    if not scale and T.LongType() in (one, other) and digits <= 19:
        return T.LongType()
    return T.DecimalType(digits + scale, scale) if digits + scale <= 38 else T.DoubleType()


def _number(kind: T.DataType) -> str | tuple[int, int] | None:
    """Digits before and behind the point that a type of numbers has; none for other types."""
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return "double"
    if isinstance(kind, T.DecimalType):
        return kind.precision - kind.scale, kind.scale
    return (19, 0) if isinstance(kind, T.LongType) else None


# A stored schema: the versions that its batches have led to.
SCHEMA_COLUMNS = "batch bigint, schema string, changes array<string>"


def evolve_json_schema(df: DataFrame, column: str, table: str, fractions: str = "double") -> T.StructType:
    """The schema that covers a batch and all batches before, which is kept in ``table``.

    The table is a published one with a row for each batch that changed the schema: its number, the schema with
    ``void`` for what was always null, and the changes, such as ``+ a.b: bigint`` and ``a.c: bigint -> double``. A batch without JSON
    objects changes nothing. Rows parsed by an earlier schema are right by a later one.
    """
    spark = df.sparkSession
    before, number = T.StructType([]), 0
    if live_version(spark, table) is not None:
        row = spark.table(table).orderBy(F.col("batch").desc()).first()
        before, number = T.StructType.fromJson(json.loads(row["schema"])), row["batch"]
    found = _inferred(df, column, fractions)
    after = before if found is None else merged_schema(before, found)
    if after != before:
        changes = [*_changes("", before, after)]
        added = spark.createDataFrame([(number + 1, after.json(), changes)], SCHEMA_COLUMNS)
        append_rows(added, table) if number else publish(added, table, "SCHEMA")
    return _settled(after)


def _changes(path: str, before: T.DataType, after: T.DataType) -> Iterator[str]:
    if isinstance(before, T.StructType) and isinstance(after, T.StructType):
        known = {f.name: f.dataType for f in before.fields}
        for f in after.fields:
            inner = f"{path}.{f.name}" if path else f.name
            if f.name in known:
                yield from _changes(inner, known[f.name], f.dataType)
            else:
                yield f"+ {inner}: {f.dataType.simpleString()}"
    elif isinstance(before, T.ArrayType) and isinstance(after, T.ArrayType):
        yield from _changes(f"{path}[]", before.elementType, after.elementType)
    elif before != after:
        yield f"{path}: {before.simpleString()} -> {after.simpleString()}"


def flatten_variant(
    df: DataFrame,
    column: str,
    array: str,
    parents: Mapping[str, tuple[str, str]],
    items: Mapping[str, tuple[str, str]],
    outer: bool = True,
    position: str | None = None,
) -> DataFrame:
    """Flatten JSON text of unknown shape: no schema of the records is given.

    ``array`` is the path of an array (``$.items``) or of an object, whose values are taken; ``parents`` and ``items`` map names to
    a path, in the record and in the element, and the type that the value is read as. What is missing, or can't be read so, is null.
    With ``outer`` a record without elements stays as one row, also if its text is no JSON. ``position`` names a column for the
    element's index.
    """
    spark = df.sparkSession
    record = df.select(F.try_parse_json(col_of(column)).alias(PARSED))
    elements = F.expr(f"try_variant_get({PARSED}, {text(array)}, 'variant')")
    record = record.withColumn(ELEMENTS, elements)
    # what is neither array nor object has no elements
    shape = F.expr(f"if(schema_of_variant({ELEMENTS}) like 'ARRAY<%' or schema_of_variant({ELEMENTS}) like 'OBJECT<%', {ELEMENTS}, null)")
    record = record.withColumn(ELEMENTS, shape)
    function = spark.tvf.variant_explode_outer if outer else spark.tvf.variant_explode
    each = record.lateralJoin(function(F.col(ELEMENTS).outer()))
    read = lambda value, path, kind: F.expr(f"try_variant_get({value}, {text(path)}, {text(kind)})")
    return each.select(
        *[read(PARSED, path, kind).alias(name) for name, (path, kind) in parents.items()],
        *([F.col("pos").alias(position)] if position else []),
        *[read("value", path, kind).alias(name) for name, (path, kind) in items.items()],
    )


# Parts of a variant schema: quoted names are copied, type words are mapped.
_VARIANT_PART = re.compile(
    r"`(?:[^`]|``)*`|\bOBJECT(?=<)|\bDECIMAL\(\d+,\s*(?P<scale>\d+)\)|\bVOID\b(?!:)"
)


def _as_ddl(variant_schema: str, fractions: str) -> str:
    def replace(match: re.Match) -> str:
        part = match.group(0)
        if part == "OBJECT":
            return "STRUCT"
        if match["scale"] and match["scale"] != "0" and fractions == "double":
            return "DOUBLE"
        return part

    return _VARIANT_PART.sub(replace, variant_schema)


def _struct(schema: T.StructType | str) -> T.StructType:
    if isinstance(schema, T.StructType):
        return schema
    parsed = T.DataType.fromDDL(schema)
    if not isinstance(parsed, T.StructType):
        raise ValueError(f"a JSON record needs a struct schema, got {schema}")
    return parsed
