"""Repeatable deduplication."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from chronofold.functions import col_of, hashable, ref
from chronofold.operators.topn import top_rows


def keep_latest(df: DataFrame, keys: Sequence[str], order: Mapping[str, str]) -> DataFrame:
    """The first row per key in ``order``; ties are broken by the other columns, ascending.

    So the same rows give the same winner in whatever order they are read; rows that
    tie in every column are equal. Each map task passes on one row per key, so a key with most
    of the rows shuffles no more than one row per task.
    """
    rest = [f for f in df.schema.fields if f.name not in order and f.name not in keys]
    plain = {f.name: "asc" for f in rest if hashable(f) == ref(f.name)}
    # Columns without an order of their own (maps, variants) are compared as text.
    texts = {f"__tie{i}": hashable(f) for i, f in enumerate(rest) if f.name not in plain}
    tied = df.selectExpr("*", *[f"{value} as {name}" for name, value in texts.items()])
    first = top_rows(tied, 1, keys, {**order, **plain, **dict.fromkeys(texts, "asc")})
    return first.drop(*texts)


def first_copies(df: DataFrame, content: Sequence[str], row_id: str) -> DataFrame:
    """Per distinct content the lowest ``row_id`` and the number of ``copies``.

    Text of 32 bytes or more is compared by its SHA-256 digest, computed before the shuffle,
    so at most 32 bytes per row travel in place of the text; nulls count as equal. Counts and
    minima are combined in the map tasks, which keeps a text with very many copies cheap. Join
    the ids back with ``left_semi`` when other columns are needed.
    """
    return (
        df.groupBy(*[_content_key(df.schema[c]).alias(f"__k{i}") for i, c in enumerate(content)])
        .agg(F.min(col_of(row_id)).alias(row_id), F.count("*").alias("copies"))
        .select(col_of(row_id), "copies")
    )


def _content_key(field: T.StructField) -> Column:
    name = ref(field.name)
    if isinstance(field.dataType, (T.StringType, T.BinaryType)):
        # Shorter text stands for itself; having another length, it cannot equal a digest.
        return F.expr(
            f"if(octet_length({name}) < 32, cast({name} as binary), unhex(sha2({name}, 256)))"
        )
    return F.expr(name)


def drop_exact_copies(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Whole-row (or column-subset) dedup for cases where any copy will do."""
    return df.dropDuplicates(list(columns)) if columns else df.dropDuplicates()
