"""A stored type 2 dimension whose commits cost what they change, not what is stored.

``<table>__rows`` is partitioned by the current flag, a bucket (a hash of the key), the commit, and whether the
partition holds all current versions of its bucket. A commit adds partitions to the buckets that its batch has keys of:
the versions it closed, and the current versions of the keys it changed. A current version is out of date when a later
commit holds its key, so readers leave out the keys of later commits, which are few: a bucket whose changes have
grown to a share of it is written whole once more, by the commit that finds it so.

``<table>__keys`` has bitmaps of the hashed keys of each partition of closed versions. A batch key without a current
version is looked for only in those partitions whose bitmap has its bit.

The view ``<table>`` is replaced last. A commit is worked out and staged without holding anything up. Then the writer
claims the table, which only one can, compares the live version with the one it began from, and writes; if another was
faster, it begins again from that one's version.
"""

from __future__ import annotations

import datetime as dt
import time
from collections.abc import Iterator, Mapping
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from chronofold.functions import any_null, col_of, hashable, quoted, ref
from chronofold.operators.merge import keys_present
from chronofold.operators.scd2 import INNER, Dimension, pinned_date, scd2_actions, scd2_check
from chronofold.operators.sizing import BROADCAST_BYTES, broadcast_if, measure
from chronofold.sources.dimension import COMMIT, METRICS
from chronofold.sources.scratch import freeze
from chronofold.sources.tables import (
    OWNER_PROPERTY,
    add_audit,
    claim,
    history,
    live_version,
    owner_name,
    point_view,
    table_name,
)

BUCKET, WHOLE = "__bucket", "__whole"
# Fixed names: the kind of these tables' views, and the property with the number of buckets.
BUCKETED = "bucketed"
BUCKETS_PROPERTY = "chronofold.buckets"
# A bucket is written whole when its changes are more than this share of it.
SHARE = 0.2
# Bits of a partition's bitmaps for each of its rows, so one key in about sixteen is looked for in vain.
BITS_PER_ROW = 16
BITS_PER_MAP = 32768
# Seconds that a writer waits for another's claim, and commits that it begins again.
PATIENCE, ATTEMPTS = 600, 20


class Conflict(RuntimeError):
    """Another writer holds the table, or was faster again and again."""


@dataclass(frozen=True)
class _Part:
    current: bool
    bucket: int
    commit: int
    whole: bool


@dataclass
class _Store:
    """A version of a table: what of ``<table>__rows`` belongs to it."""

    spark: SparkSession
    table: str
    dim: Dimension
    live: int
    buckets: int
    parts: list[_Part]

    @property
    def rows(self) -> DataFrame:
        return self.spark.table(f"{self.table}__rows")

    @property
    def columns(self) -> list[str]:
        return self.spark.table(self.table).columns

    def bases(self) -> dict[int, int]:
        """By bucket the last commit that wrote it whole."""
        found: dict[int, int] = {}
        for p in self.parts:
            if p.whole:
                found[p.bucket] = max(p.commit, found.get(p.bucket, 0))
        return found

    def changed(self) -> bool:
        """Whether any bucket has commits after its base."""
        bases = self.bases()
        return any(p.commit > bases.get(p.bucket, -1) for p in self.parts if p.current)

    def since_base(self, strictly: bool) -> str:
        """SQL for the partitions of each bucket from its base on; a bucket without one begins at 0."""
        by_base: dict[int, list[int]] = {}
        for bucket in range(self.buckets):
            by_base.setdefault(self.bases().get(bucket, -1 if strictly else 0), []).append(bucket)
        sign = ">" if strictly else ">="
        if len(by_base) == 1:
            return f"{COMMIT} {sign} {next(iter(by_base))}"
        either = (f"{COMMIT} {sign} {k} AND {BUCKET} IN ({', '.join(map(str, b))})" for k, b in sorted(by_base.items()))
        return "(" + " OR ".join(f"({e})" for e in either) + ")"

    def current_sql(self, among: str = "true") -> str:
        """SQL for the live current versions, with bucket and commit."""
        source, flag = table_name(f"{self.table}__rows"), quoted(self.dim.current)
        found = f"SELECT * FROM {source} WHERE {flag} AND {COMMIT} <= {self.live} AND {self.since_base(False)} AND {among}"
        if not self.changed():
            return found
        keys = ", ".join(quoted(k) for k in self.dim.keys)
        same = " AND ".join(f"{ref(k, 'c')} = {ref(k, 'd')}" for k in (*self.dim.keys, BUCKET))
        later = f"SELECT {keys}, {BUCKET}, {COMMIT} FROM {source} WHERE {COMMIT} <= {self.live} AND {self.since_base(True)} AND {among}"
        return f"SELECT c.* FROM ({found}) c LEFT ANTI JOIN ({later}) d ON {same} AND d.{COMMIT} > c.{COMMIT}"

    def show(self) -> None:
        """Point the view at this version."""
        names = ", ".join(quoted(c) for c in self.columns if c not in (BUCKET, COMMIT, WHOLE))
        closed = f"SELECT {names} FROM {table_name(f'{self.table}__rows')} WHERE NOT {quoted(self.dim.current)} AND {COMMIT} <= {self.live}"
        query = f"{closed} UNION ALL SELECT {names} FROM ({self.current_sql()})"
        point_view(self.spark, self.table, self.live, query, BUCKETED)


def _open(spark: SparkSession, table: str, dim: Dimension) -> _Store:
    live = live_version(spark, table, BUCKETED)
    if live is None:
        raise ValueError(f"{table} is not a stored dimension with buckets")
    rows = table_name(f"{table}__rows")
    found = spark.sql(f"SHOW TBLPROPERTIES {rows} ('{BUCKETS_PROPERTY}')").first()["value"]
    return _Store(spark, table, dim, live, int(found), [p for p in _parts(spark, table) if p.commit <= live])


def _parts(spark: SparkSession, table: str) -> list[_Part]:
    listed = spark.sql(f"SHOW PARTITIONS {table_name(f'{table}__rows')}").collect()
    values = ([v.split("=")[-1] for v in r["partition"].split("/")] for r in listed)
    return [_Part(f == "true", int(b), int(c), w == "true") for f, b, c, w in values]


def _bucket_of(schema, dim: Dimension, buckets: int) -> Column:
    return F.expr(f"cast(pmod(xxhash64({', '.join(hashable(schema[k]) for k in dim.keys)}), {buckets}) as int)")


def _key_hash(schema, dim: Dimension) -> str:
    """Another hash of the keys, for the bitmaps."""
    return f"xxhash64(11, {', '.join(hashable(schema[k]) for k in dim.keys)})"


def create_bucketed(df: DataFrame, table: str, dim: Dimension, buckets: int = 16) -> None:
    """Store a first snapshot, current and closed versions, as commit 0.

    A commit adds a partition or two to each bucket that it has keys of: take few buckets where batches are
    scattered over all keys. A version without a flag is stored as closed.
    """
    spark = df.sparkSession
    if live_version(spark, table) is not None or spark.catalog.tableExists(table):
        raise ValueError(f"{table} exists")
    rows, keys = f"{table}__rows", f"{table}__keys"
    taken = sorted({BUCKET, COMMIT, WHOLE, INNER} & set(df.columns))
    if taken:
        raise ValueError(f"the dimension has columns with names that are needed here: {taken}")
    for name in (rows, keys):
        claim(spark, name, table)
    attributes = [quoted(c) for c in df.columns if c != dim.current]
    flag = F.coalesce(quoted(dim.current), F.lit(False)).alias(dim.current)
    bucket = _bucket_of(df.schema, dim, buckets).alias(BUCKET)
    first = df.select(*attributes, flag, bucket, F.lit(0).alias(COMMIT)).withColumn(WHOLE, col_of(dim.current))
    # AQE splits what a hot key makes of its bucket.
    first = first.hint("rebalance", dim.current, BUCKET)
    write = first.writeTo(table_name(rows)).using("parquet")
    write = write.tableProperty(OWNER_PROPERTY, owner_name(table)).tableProperty(BUCKETS_PROPERTY, str(buckets))
    write.partitionedBy(*[F.col(quoted(c)) for c in (dim.current, BUCKET, COMMIT, WHOLE)]).create()
    spark.sql(
        f"CREATE TABLE {table_name(keys)} ({BUCKET} INT, bits BIGINT, number BIGINT, bitmap BINARY, {COMMIT} INT) "
        f"USING parquet PARTITIONED BY ({COMMIT}) TBLPROPERTIES ('{OWNER_PROPERTY}' = '{owner_name(table)}')"
    )
    _add_bitmaps(spark, table, dim, spark.table(rows).where(f"NOT {quoted(dim.current)}"), 0)
    add_audit(spark, table, 0, "CREATE", {})
    # the view's columns are taken from the rows the first time
    spark.sql(f"CREATE OR REPLACE VIEW {table_name(table)} AS SELECT {', '.join(map(quoted, df.columns))} FROM {table_name(rows)}")
    _Store(spark, table, dim, 0, buckets, _parts(spark, table)).show()


def _add_bitmaps(spark: SparkSession, table: str, dim: Dimension, closed: DataFrame, commit: int) -> None:
    hashed = closed.select(BUCKET, F.expr(_key_hash(closed.schema, dim)).alias("h"))
    # a row for each bucket
    power = f"pow(2, ceil(log2(greatest({BITS_PER_ROW}L * count(*), {BITS_PER_MAP}))))"
    sizes = hashed.groupBy(BUCKET).agg(F.expr(f"cast({power} as bigint) as bits"))
    placed = hashed.join(F.broadcast(sizes), BUCKET).selectExpr(BUCKET, "bits", "pmod(h, bits) as place")
    maps = placed.groupBy(BUCKET, "bits", F.expr(f"place div {BITS_PER_MAP}").alias("number")).agg(
        F.expr(f"bitmap_construct_agg(place % {BITS_PER_MAP})").alias("bitmap")
    )
    spark.sql(f"ALTER TABLE {table_name(f'{table}__keys')} DROP IF EXISTS PARTITION ({COMMIT} = {commit})")
    maps.withColumn(COMMIT, F.lit(commit)).write.mode("append").insertInto(f"{table}__keys")


def closed_partitions(store: _Store, unknown: DataFrame) -> list[tuple[int, int]]:
    """Bucket and commit of the closed versions that may have one of these keys, by the bitmaps."""
    maps = store.spark.table(f"{store.table}__keys").where(f"{COMMIT} <= {store.live}")
    # powers of two: a few dozen at most
    sizes = [r["bits"] for r in maps.select("bits").distinct().collect()]
    if not sizes:
        return []
    hashed = unknown.select(
        _bucket_of(unknown.schema, store.dim, store.buckets).alias(BUCKET),
        F.expr(_key_hash(unknown.schema, store.dim)).alias("h"),
        F.explode(F.array(*[F.lit(s).cast("bigint") for s in sizes])).alias("bits"),
    ).selectExpr(BUCKET, "bits", "pmod(h, bits) as place", f"pmod(h, bits) div {BITS_PER_MAP} as number")
    byte = f"cast(conv(hex(substring(bitmap, cast(place % {BITS_PER_MAP} div 8 + 1 as int), 1)), 16, 10) as int)"
    met = F.expr(f"(shiftright({byte}, cast(place % 8 as int)) & 1) = 1")
    found = maps.join(hashed, [BUCKET, "bits", "number"]).where(met).select(BUCKET, COMMIT).distinct()
    return sorted((r[BUCKET], r[COMMIT]) for r in found.collect())


def fingerprint(batch: DataFrame) -> str:
    """The same for the same rows in any order and partitioning: their number and two sums of their hashes."""
    values = ", ".join(hashable(batch.schema[c]) for c in sorted(batch.columns))
    named = ", ".join(f"'{c}'" for c in sorted(c.replace("'", "") for c in batch.columns))
    # a null is no value to the hash, so which values are null is hashed as well
    nulls = ", ".join(f"{ref(c)} is null" for c in sorted(batch.columns))
    hashes = [f"xxhash64({seed}, {nulls}, {values})" for seed in (1, 2)]
    sums = ", ".join(f"coalesce(sum(cast({h} as decimal(38,0))), 0)" for h in hashes)
    return batch.agg(F.expr(f"concat_ws('.', count(*), {sums}, xxhash64({named}))").alias("f")).first()["f"]


@contextmanager
def claimed(spark: SparkSession, table: str, patience: float = PATIENCE) -> Iterator[None]:
    """Hold a table as its only writer: ``<table>__claim`` can be created by one at a time.

    A writer that dies with its claim holds up the others until ``release`` is called.
    """
    name, until = table_name(f"{table}__claim"), time.monotonic() + patience
    while True:
        try:
            spark.sql(f"CREATE TABLE {name} (since TIMESTAMP) USING parquet TBLPROPERTIES ('{OWNER_PROPERTY}' = '{owner_name(table)}')")
            break
        except AnalysisException as error:
            if "ALREADY_EXISTS" not in str(error):
                raise
            if time.monotonic() > until:
                raise Conflict(f"{table} is held by another writer; if that one is dead, call release") from error
            time.sleep(min(1.0, patience / 10))
    try:
        yield
    finally:
        release(spark, table)


def release(spark: SparkSession, table: str) -> None:
    """Take a claim off a table."""
    spark.sql(f"DROP TABLE IF EXISTS {table_name(f'{table}__claim')}")


def commit_bucketed(
    spark: SparkSession,
    table: str,
    batch: DataFrame,
    dim: Dimension,
    as_of: dt.date | None = None,
    order: Mapping[str, str] | None = None,
    reopen_closed: bool = False,
    same_day: str = "replace",
    broadcast_bytes: int = BROADCAST_BYTES,
    share: float = SHARE,
    skip_replays: bool = False,
    check: bool = False,
    patience: float = PATIENCE,
) -> dict[str, int]:
    """Apply a batch; returns its counts. Options are those of ``scd2_apply``, and:

    ``skip_replays``: a batch with the rows of one that was committed before, in any order, changes nothing and is
    listed by ``history`` as ``REPLAY``. Leave it off where the same rows may rightly come again.
    ``check``: the versions of all keys that the batch changes pass ``scd2_check`` before they can be seen; if any rule is
    broken, nothing changes and ``history`` lists ``REJECTED`` with the number of violations.

    Several writers lose nothing: see ``claimed``. A batch is always applied to the version it follows.
    """
    batch, as_of = freeze(batch), pinned_date(spark, as_of)
    mark = fingerprint(batch)
    for _ in range(ATTEMPTS):
        store = _open(spark, table, dim)
        if skip_replays and _seen(store, mark):
            metrics, staged, operation = {}, None, "REPLAY"
        else:
            options = order, reopen_closed, same_day, broadcast_bytes
            staged, metrics = _stage(store, batch, as_of, *options, share)
            operation = "SCD2"
            if check and (broken := _violations(store, staged, batch, broadcast_bytes)):
                metrics, staged, operation = {"violations": broken}, None, "REJECTED"
        with claimed(spark, table, patience):
            if live_version(spark, table, BUCKETED) == store.live:
                _publish(store, staged, operation, metrics | {"batch": mark})
                return metrics
    raise Conflict(f"{table} was changed by others {ATTEMPTS} times in a row")


def _seen(store: _Store, mark: str) -> bool:
    listed = history(store.spark, store.table).where("operation = 'SCD2'")
    return not listed.where(F.col("metrics")["batch"] == mark).isEmpty()


def _batch_keys(store: _Store, batch: DataFrame) -> DataFrame:
    """The distinct keys in the table's types, without nulls."""
    schema = store.rows.schema
    keys = batch.select(*[col_of(k).cast(schema[k].dataType).alias(k) for k in store.dim.keys])
    return keys.where(f"NOT {any_null(store.dim.keys)}").distinct()


def _stage(
    store: _Store, batch: DataFrame, as_of: dt.date, order, reopen_closed, same_day, broadcast_bytes, share: float
) -> tuple[DataFrame, dict[str, int]]:
    """The rows of a commit, written to the shared folder, and its counts."""
    spark, dim = store.spark, store.dim
    keys = freeze(_batch_keys(store, batch))
    bucket = _bucket_of(keys.schema, dim, store.buckets)
    # at most one row for each bucket comes to the driver
    coming = {r["b"]: r["count"] for r in keys.groupBy(bucket.alias("b")).count().collect()}
    among = f"{BUCKET} IN ({', '.join(map(str, sorted(coming)))})" if coming else "false"
    target = _touched(store, keys, among, broadcast_bytes)
    held = store.rows.where(f"{quoted(dim.current)} AND {COMMIT} <= {store.live} AND {store.since_base(False)} AND {among}")
    sizes = {(r[BUCKET], r[WHOLE]): r["count"] for r in held.groupBy(BUCKET, WHOLE).count().collect()}
    whole = {b for b, n in coming.items() if sizes.get((b, False), 0) + 2 * n > share * sizes.get((b, True), 0)}
    actions = scd2_actions(target, batch, dim, as_of, order, reopen_closed, same_day, broadcast_bytes, INNER)
    seen = Observation()
    actions = actions.observe(seen, *[F.count_if(F.col(INNER) == a).alias(m) for a, m in METRICS.items()])
    actions = actions.withColumn(BUCKET, _bucket_of(actions.schema, dim, store.buckets))
    still = ["kept"] if dim.overwritten else ["kept", "unchanged"]
    needed = ~F.col(INNER).isin(still)
    if whole:
        needed |= F.col(BUCKET).isin(sorted(whole))
    rewritten = F.col(BUCKET).isin(sorted(whole)) if whole else F.lit(False)
    names = [quoted(c) for c in store.rows.columns if c not in (BUCKET, COMMIT, WHOLE)]
    staged = actions.where(needed).select(
        *names, BUCKET, F.lit(store.live + 1).alias(COMMIT), (rewritten & col_of(dim.current)).alias(WHOLE)
    )
    staged = freeze(staged.hint("rebalance", dim.current, BUCKET))
    return staged, seen.get


def _touched(store: _Store, keys: DataFrame, among: str, broadcast_bytes: int) -> DataFrame:
    """What a commit needs of the table: current versions of the touched buckets, and the closed ones that may have
    a key without a current version."""
    names = [quoted(c) for c in store.columns]
    current = store.spark.sql(store.current_sql(among)).select(*names)
    small = measure(keys).fits(broadcast_bytes)
    known = keys_present(current, keys, store.dim.keys, small)
    unknown = freeze(keys.join(known, list(store.dim.keys), "left_anti"))
    places = closed_partitions(store, unknown)
    by_commit: dict[int, list[int]] = {}
    for bucket, commit in places:
        by_commit.setdefault(commit, []).append(bucket)
    either = [f"({COMMIT} = {c} AND {BUCKET} IN ({', '.join(map(str, b))}))" for c, b in sorted(by_commit.items())]
    closed = store.rows.where(f"NOT {quoted(store.dim.current)} AND ({' OR '.join(either) or 'false'})").select(*names)
    return current.unionByName(closed)


def _violations(store: _Store, staged: DataFrame, batch: DataFrame, broadcast_bytes: int) -> int:
    """Violations among all versions of the batch's keys, were a staged commit seen. Other keys are not judged."""
    dim, names = store.dim, [quoted(c) for c in store.columns]
    keys = _batch_keys(store, batch)
    buckets = [r[BUCKET] for r in staged.select(BUCKET).distinct().collect()]
    closed = store.rows.where(f"NOT {quoted(dim.current)} AND {COMMIT} <= {store.live}").where(F.col(BUCKET).isin(buckets))
    versions = staged.select(*names).unionByName(closed.select(*names))
    mine = versions.join(broadcast_if(measure(keys).fits(broadcast_bytes), keys), list(dim.keys), "left_semi")
    return scd2_check(mine.select(*names), dim).count()


def _publish(store: _Store, staged: DataFrame | None, operation: str, metrics: dict) -> None:
    """Write a staged commit and point the view at it; called with the table claimed."""
    spark, table, commit = store.spark, store.table, store.live + 1
    # of a writer that was cut off here
    _drop(store, [p for p in _parts(spark, table) if p.commit >= commit])
    if staged is not None:
        staged.select(*map(quoted, store.rows.columns)).write.mode("append").insertInto(f"{table}__rows")
        closed = staged.where(f"NOT {quoted(store.dim.current)}")
        _add_bitmaps(spark, table, store.dim, closed, commit)
    add_audit(spark, table, commit, operation, metrics)
    _Store(spark, table, store.dim, commit, store.buckets, _parts(spark, table)).show()
    if staged is not None:
        # out of use before this commit already, so that queries that run keep what they read
        bases = store.bases()
        _drop(store, [p for p in store.parts if p.current and p.commit < bases.get(p.bucket, 0)])


def _drop(store: _Store, parts: list[_Part]) -> None:
    for p in parts:
        values = {quoted(store.dim.current): p.current, BUCKET: p.bucket, COMMIT: p.commit, WHOLE: p.whole}
        spec = ", ".join(f"{name} = {str(value).lower()}" for name, value in values.items())
        store.spark.sql(f"ALTER TABLE {table_name(f'{store.table}__rows')} DROP IF EXISTS PARTITION ({spec})")
