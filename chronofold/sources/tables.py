"""Tables: test inputs, catalog objects, and publishing in one visible step."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from chronofold.functions import quoted

# Fixed names: properties of the view that readers use, and of the data tables behind it.
VERSION_PROPERTY = "chronofold.version"
BASE_PROPERTY = "chronofold.base"
KIND_PROPERTY = "chronofold.kind"
PARTS_PROPERTY = "chronofold.parts"
OWNER_PROPERTY = "chronofold.owner"
PUBLISHED, DIMENSION = "published", "dimension"
AUDIT_COLUMNS = "version BIGINT, ts TIMESTAMP, operation STRING, metrics MAP<STRING, STRING>"


def load(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def prepare_schema(
    spark: SparkSession, schema: str, catalog: str | None = None, location: str | None = None
) -> None:
    """Choose a catalog if one is named and create the schema if it is missing."""
    if catalog:
        spark.catalog.setCurrentCatalog(catalog)
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {table_name(schema)}{where}")


def publish(
    df: DataFrame,
    table: str,
    operation: str = "PUBLISH",
    metrics: dict[str, object] | None = None,
    file_format: str = "parquet",
) -> int:
    """Create or replace ``table`` by the rows of ``df``; returns the new version.

    The rows go to a data table of their own, ``<table>__v<version>``, and the name that
    readers use is a view which is then pointed at it: readers see the old rows or the new
    ones, and ``df`` may itself read ``table``. A failed run leaves the view as it was; its
    half-written data table is dropped by the next run. The version before stays for queries
    that already run, older ones are dropped.

    A plain table of that name is kept as version 0 the first time. That takes a rename and
    then the view; a run that fails between them leaves no table, which the next use of this
    module's functions on the name repairs (``recover``).

    Data tables carry the name of their owner. A table that stands in the way without it, and a
    view of another kind, is an error. One writer at a time: two that publish together
    overwrite each other's version.
    """
    spark = df.sparkSession
    found = _view_properties(spark, table, PUBLISHED)
    plain = found is None and _is_plain_name(spark, table)
    before = int(found[VERSION_PROPERTY]) if found else 0
    kept_from = int(found.get(BASE_PROPERTY, before)) if found else 0
    version = before + 1
    _store(df, table, f"v{version}", file_format)
    add_audit(spark, table, version, operation, metrics or {})
    if plain:
        mark = f"('{OWNER_PROPERTY}' = '{owner_name(table)}')"
        claim(spark, f"{table}__v0", table)
        spark.sql(f"ALTER TABLE {table_name(table)} SET TBLPROPERTIES {mark}")
        spark.sql(f"ALTER TABLE {table_name(table)} RENAME TO {table_name(f'{table}__v0')}")
    point_view(spark, table, version, f"SELECT * FROM {table_name(f'{table}__v{version}')}", PUBLISHED, version)
    for name in _named_for(spark, table):
        number = _PART.fullmatch(name)
        if number and int(number[2]) < kept_from and owns(spark, table, name):
            spark.sql(f"DROP TABLE IF EXISTS {table_name(name)}")
    return version


def append_rows(df: DataFrame, table: str) -> int | None:
    """Append to a table by column name, whatever the order of the columns in ``df``.

    On a published table that is a new version, which is returned: the rows get a data table of their own and the
    view reads it besides the ones before. It is listed by ``history`` with the number of rows. A plain table is appended to in
    place.

    The last data tables are merged into one when they hold as many appends as the ones before them, like the digits
    of a binary number: after n appends the view reads about log2(n) tables, and a row was written about as many times. What was
    published is never rewritten. Merged tables stay until the next version, so queries that run keep what they read.
    """
    spark = df.sparkSession
    found = _view_properties(spark, table, PUBLISHED)
    if found is None:
        df.select(*[quoted(c) for c in spark.table(table).columns]).write.mode("append").insertInto(table)
        return None
    fields = spark.table(table).schema.fields
    live = int(found[VERSION_PROPERTY])
    base, version, before = int(found.get(BASE_PROPERTY, live)), live + 1, _parts(found)
    rows = df.select(*[F.col(quoted(f.name)).cast(f.dataType).alias(f.name) for f in fields])
    seen = Observation()
    _store(rows.observe(seen, F.count(F.lit(1)).alias("rows")), table, f"v{version}")
    parts, appends, merged = [*before, f"v{version}"], 1, 1
    while len(parts) - merged > 1 and _appends(parts[-merged - 1]) == appends:
        appends *= 2
        merged += 1
    if merged > 1:
        whole = f"v{version}_{appends}"
        sources = [spark.table(f"{table}__{p}") for p in parts[-merged:]]
        _store(reduce(DataFrame.unionByName, sources), table, whole)
        parts[-merged:] = [whole]
    add_audit(spark, table, version, "APPEND", seen.get)
    names = ", ".join(quoted(f.name) for f in fields)
    queries = [f"SELECT {names} FROM {table_name(f'{table}__{p}')}" for p in parts]
    point_view(spark, table, version, " UNION ALL ".join(queries), PUBLISHED, base, parts)
    for name in _named_for(spark, table):
        part = _PART.fullmatch(name)
        if part and base <= int(part[2]) and part[1] not in (*before, *parts) and owns(spark, table, name):
            spark.sql(f"DROP TABLE IF EXISTS {table_name(name)}")
    return version


# A data table's version, and the number of appends that it holds if it was merged.
_PART = re.compile(r".*__(v(\d+)(?:_(\d+))?)")


def _appends(part: str) -> int:
    return int(_PART.fullmatch(f"__{part}")[3] or 1)


def _parts(found: dict[str, str]) -> list[str]:
    """The data tables of a view: its base, and those of the appends."""
    if PARTS_PROPERTY in found:
        return found[PARTS_PROPERTY].split(",")
    live = int(found[VERSION_PROPERTY])
    return [f"v{v}" for v in range(int(found.get(BASE_PROPERTY, live)), live + 1)]


def _store(df: DataFrame, table: str, part: str, file_format: str = "parquet") -> None:
    claim(df.sparkSession, f"{table}__{part}", table)
    write = df.writeTo(table_name(f"{table}__{part}")).using(file_format)
    write.tableProperty(OWNER_PROPERTY, owner_name(table)).create()


def live_version(spark: SparkSession, table: str, kind: str | None = None) -> int | None:
    """The version a view of ours points at; None for a plain or missing table.

    A view of another ``kind`` than the one asked for is an error: the layouts differ.
    """
    found = _view_properties(spark, table, kind)
    return int(found[VERSION_PROPERTY]) if found else None


def _view_properties(spark: SparkSession, table: str, kind: str | None = None) -> dict[str, str] | None:
    """The properties of a view of ours; see ``live_version``."""
    if not spark.catalog.tableExists(table) and not recover(spark, table):
        return None
    found = _properties(spark, table)
    if VERSION_PROPERTY not in found:
        return None
    if kind and found.get(KIND_PROPERTY, kind) != kind:
        raise ValueError(f"{table} is a {found[KIND_PROPERTY]} table, not a {kind} one")
    return found


def recover(spark: SparkSession, table: str) -> bool:
    """Give a plain table its name back if a first publish was cut off after the rename."""
    first = f"{table}__v0"
    if spark.catalog.tableExists(table) or not owns(spark, table, first):
        return False
    spark.sql(f"ALTER TABLE {table_name(first)} RENAME TO {table_name(table)}")
    return True


def _properties(spark: SparkSession, table: str) -> dict[str, str]:
    rows = spark.sql(f"SHOW TBLPROPERTIES {table_name(table)}")
    ours = rows.where(F.col("key").startswith("chronofold.")).collect()
    return {r["key"]: r["value"] for r in ours}


def owner_name(table: str) -> str:
    return table.lower().replace("'", "")


def owns(spark: SparkSession, table: str, data: str) -> bool:
    """Whether ``data`` exists and was written for ``table``."""
    if not spark.catalog.tableExists(data):
        return False
    return _properties(spark, data).get(OWNER_PROPERTY) == owner_name(table)


def claim(spark: SparkSession, data: str, table: str) -> None:
    """Make room for a data table: drop what an earlier run left, never a table of others."""
    if spark.catalog.tableExists(data):
        if not owns(spark, table, data):
            raise ValueError(f"{data} is in the way and does not belong to {table}")
        spark.sql(f"DROP TABLE {table_name(data)}")


def own_tables(spark: SparkSession, table: str) -> list[str]:
    """The data and audit tables that were written for ``table``."""
    return [n for n in _named_for(spark, table) if owns(spark, table, n)]


def _named_for(spark: SparkSession, table: str) -> list[str]:
    """Tables that have the names of ``table``'s data and audit, whoever's they are."""
    schema, _, base = table.rpartition(".")
    prefix = f"{schema}." if schema else ""
    listed = spark.sql(f"SHOW TABLES IN {table_name(schema)}" if schema else "SHOW TABLES")
    pattern = f"^{re.escape(base.lower())}__(v[0-9]+(_[0-9]+)?|rows|keys|claim|audit)$"
    rows = listed.where(F.col("tableName").rlike(pattern) & ~F.col("isTemporary")).collect()
    return [prefix + r["tableName"] for r in rows]


def point_view(
    spark: SparkSession, table: str, version: int, query: str, kind: str, base: int = 0, parts: list[str] | None = None
) -> None:
    listed = f", '{PARTS_PROPERTY}' = '{','.join(parts)}'" if parts else ""
    spark.sql(
        f"CREATE OR REPLACE VIEW {table_name(table)} TBLPROPERTIES ("
        f"'{VERSION_PROPERTY}' = '{version}', '{BASE_PROPERTY}' = '{base}', "
        f"'{KIND_PROPERTY}' = '{kind}'{listed}) AS {query}"
    )


def add_audit(
    spark: SparkSession, table: str, version: int, operation: str, metrics: dict[str, object]
) -> None:
    """Note a change that is about to become visible. One row per change, never updated."""
    audit = f"{table}__audit"
    if not spark.catalog.tableExists(audit):
        spark.sql(
            f"CREATE TABLE {table_name(audit)} ({AUDIT_COLUMNS}) USING parquet "
            f"TBLPROPERTIES ('{OWNER_PROPERTY}' = '{owner_name(table)}')"
        )
    elif _properties(spark, audit).get(OWNER_PROPERTY) != owner_name(table):
        raise ValueError(f"{audit} is in the way and does not belong to {table}")
    entries = [F.lit(part) for k, v in metrics.items() for part in (k, str(v))]
    row = spark.range(0, 1, 1, 1).select(
        F.lit(version).cast("bigint").alias("version"),
        F.current_timestamp().alias("ts"),
        F.lit(operation).alias("operation"),
        F.create_map(*entries).cast("map<string,string>").alias("metrics"),
    )
    row.write.mode("append").insertInto(audit)


def history(spark: SparkSession, table: str) -> DataFrame:
    """The changes that became visible: version, ts, operation and metrics, newest first.

    A run that failed before its view changed may have left a row; the run that then took
    the same version number is the one that counts.
    """
    live = live_version(spark, table)
    audit = spark.table(f"{table}__audit").where(F.col("version") <= F.lit(live or 0))
    latest = audit.groupBy("version").agg(
        F.max(F.struct("ts", "operation", F.to_json("metrics").alias("m"))).alias("r")
    )
    return latest.select(
        "version",
        "r.ts",
        "r.operation",
        F.from_json("r.m", "map<string,string>").alias("metrics"),
    ).orderBy(F.col("version").desc())


def drop_table(spark: SparkSession, table: str) -> None:
    """Drop a table if it is there; of one of ours the view, its data and its audit.

    Tables that only look alike by name are left alone.
    """
    if _is_plain(spark, table):
        spark.sql(f"DROP TABLE {table_name(table)}")
    else:
        spark.sql(f"DROP VIEW IF EXISTS {table_name(table)}")
    for name in own_tables(spark, table):
        spark.sql(f"DROP TABLE IF EXISTS {table_name(name)}")


def _is_plain(spark: SparkSession, table: str) -> bool:
    """Whether the name is taken by an ordinary table; a foreign view of that name is an error."""
    return live_version(spark, table) is None and _is_plain_name(spark, table)


def _is_plain_name(spark: SparkSession, table: str) -> bool:
    """The same for a name that is no view of ours."""
    if not spark.catalog.tableExists(table):
        return False
    if spark.catalog.getTable(table).tableType == "VIEW":
        raise ValueError(f"{table} is a view that was not made by publish")
    return True


def table_name(table: str) -> str:
    return ".".join(quoted(part) for part in table.split("."))
