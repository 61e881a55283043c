"""Aggregates of groups where one key may hold a large part of all rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from chronofold.functions import col_of, ref, stable_salt

SALT, KEY = "__salt", "__key"


@dataclass(frozen=True)
class Measure:
    """A number of a group: ``kind`` of a column.

    Kinds: ``count`` (of rows, or of values that are not null), ``sum``, ``min``, ``max``, ``avg``; ``distinct``, exact;
    ``approx_distinct``, from a sketch of ``size`` (log2 of its entries, 4 to 21); ``quantile`` ``q``, from a sketch of ``size`` (k,
    8 to 65535; values are doubles).
    """

    kind: str
    column: str | None = None
    q: float = 0.5
    size: int | None = None

    def parts(self, name: str) -> dict[str, str]:
        """Columns of a part of a group, as SQL."""
        value = ref(self.column) if self.column else "1"
        if self.kind == "avg":
            return {f"{name}__sum": f"sum({value})", f"{name}__n": f"count({value})"}
        if self.kind == "approx_distinct":
            return {name: f"hll_sketch_agg({value}, {self.size or 12})"}
        if self.kind == "quantile":
            return {name: f"kll_sketch_agg_double(cast({value} as double), {self.size or 200})"}
        if self.kind in ("count", "sum", "min", "max"):
            return {name: f"{self.kind}({value})"}
        raise ValueError(f"no measure {self.kind!r}")

    def whole(self, name: str) -> str:
        """What the parts of a group make together, as SQL."""
        own = ref(name)
        if self.kind == "avg":
            return f"sum({ref(f'{name}__sum')}) / sum({ref(f'{name}__n')})"
        if self.kind == "approx_distinct":
            return f"hll_sketch_estimate(hll_union_agg({own}, true))"
        if self.kind == "quantile":
            return f"kll_sketch_get_quantile_double(kll_merge_agg_double({own}), {self.q}D)"
        return f"{'sum' if self.kind == 'count' else self.kind}({own})"


def salted_partials(
    df: DataFrame, by: Sequence[str], measures: Mapping[str, Measure], parts: int | None = None
) -> DataFrame:
    """The first stage: a row for each key and part, ``parts`` of each key at most (default: as many as shuffle partitions).

    A row's part follows from its content and input partition, so equal rows spread and a retried task repeats it.
    """
    parts = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    salted = df.selectExpr("*", f"{stable_salt(df.schema, str(parts))} as {SALT}")
    columns = [F.expr(sql).alias(c) for name, m in measures.items() for c, sql in m.parts(name).items()]
    return salted.groupBy(*map(col_of, by), SALT).agg(*columns)


def salted_aggregate(
    df: DataFrame, by: Sequence[str], measures: Mapping[str, Measure], parts: int | None = None
) -> DataFrame:
    """A row for each key, null keys included, with its measures.

    The rows of a key are aggregated in parts by many tasks, and the parts are merged: sums and counts as such, sketches
    by their unions. Exact distinct counts are two stages too: values of a key are made distinct wherever they are dealt to, and
    then counted. So no task gets all rows of a key, whatever is measured.
    """
    taken = sorted({SALT, KEY} & set(df.columns))
    if taken:
        raise ValueError(f"columns have names that are needed here: {taken}")
    exact = {name: m for name, m in measures.items() if m.kind == "distinct"}
    merged = {name: m for name, m in measures.items() if name not in exact}
    keys = [col_of(k) for k in by]
    found = []
    if merged or not exact:
        partials = salted_partials(df, by, merged or {"__n": Measure("count")}, parts)
        whole = [F.expr(m.whole(name)).alias(name) for name, m in merged.items()]
        found.append(partials.groupBy(*keys).agg(*(whole or [F.sum("__n").alias("__n")])))
    for name, m in exact.items():
        values = df.select(*keys, col_of(m.column).alias(name)).distinct()
        found.append(values.groupBy(*keys).agg(F.count(col_of(name)).alias(name)))
    # a struct is an ordinary key in which nulls are equal
    joined = reduce(lambda a, b: a.join(b.drop(*by), KEY), [f.withColumn(KEY, F.struct(*keys)) for f in found])
    return joined.select(*keys, *[col_of(name) for name in measures])
