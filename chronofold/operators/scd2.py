"""Slowly changing dimension, type 2: keep every version of a row with its validity dates.

A version is valid on the closed interval [start, end]. The current version of a key ends on
9999-12-31 and is flagged; an older one ends on the day before the next one starts. A batch
is a partial feed: keys it does not mention stay as they are.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from chronofold.functions import (
    OPEN_END_SQL,
    any_differs,
    any_null,
    col_of,
    keys_equal,
    ref,
    text,
)
from chronofold.operators.merge import prepare_batch, updated
from chronofold.operators.sizing import BROADCAST_BYTES, broadcast_if

# Column of scd2_actions and of scd2_classify.
ACTION = "action"
CHANGE = "change_type"
# Names that plans use inside; a table that has one of them is refused.
INNER = "__action"
RESERVED = {INNER, "__s", "__t", "__past", "__end", "__open", "__current", "__differs", "__start"}
POLICIES = ("replace", "keep", "error")
SEVERAL = "a key has several current versions"


@dataclass(frozen=True)
class Dimension:
    """Column roles of a versioned table.

    ``tracked`` columns open a new version when they change. ``overwritten`` columns are
    copied onto the current version without a new one. Other attributes are set when a
    version opens.
    """

    keys: tuple[str, ...]
    tracked: tuple[str, ...]
    overwritten: tuple[str, ...] = ()
    start: str = "eff_start"
    end: str = "eff_end"
    current: str = "is_current"

    def validity(self) -> tuple[str, str, str]:
        return self.start, self.end, self.current

    def attributes(self, target: DataFrame) -> list[T.StructField]:
        return [f for f in target.schema.fields if f.name not in self.validity()]


def pinned_date(spark: SparkSession, as_of: dt.date | None = None) -> dt.date:
    """``as_of``, or the session's current date read once, so a run keeps it past midnight."""
    return as_of or spark.sql("SELECT current_date()").first()[0]


def scd2_rejects(batch: DataFrame, dim: Dimension) -> DataFrame:
    """Batch rows that cannot be placed because a key column is null."""
    return batch.where(any_null(dim.keys))


def _placeable(batch: DataFrame, dim: Dimension) -> DataFrame:
    return batch.where(f"NOT {any_null(dim.keys)}")


def clean_batch(
    target: DataFrame,
    batch: DataFrame,
    dim: Dimension,
    order: Mapping[str, str] | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> tuple[DataFrame, bool]:
    """The batch with one row per non-null key, by name and in the target's types.

    Also tells whether it is small enough to broadcast. Raises ``DuplicateKeys`` when a key
    repeats and no ``order`` is given.
    """
    attributes = dim.attributes(target)
    missing = [f.name for f in attributes if f.name not in batch.columns]
    if missing:
        raise ValueError(f"the batch lacks columns of the dimension: {missing}")
    rows, small = prepare_batch(_placeable(batch, dim), dim.keys, order, broadcast_bytes)
    typed = [
        f"cast({ref(f.name)} as {f.dataType.simpleString()}) as {ref(f.name)}" for f in attributes
    ]
    return rows.selectExpr(*typed), small


def _check(target: DataFrame, same_day: str, *added: str) -> None:
    if same_day not in POLICIES:
        raise ValueError("same_day must be 'replace', 'keep' or 'error'")
    names = RESERVED | {a.lower() for a in added}
    taken = sorted(c for c in target.columns if c.lower() in names)
    if taken:
        raise ValueError(f"the dimension has columns with names that are needed here: {taken}")


def _current_rules(
    as_of: dt.date, same_day: str, differs: str, start: str
) -> list[tuple[str, str, bool]]:
    """What becomes of a current version whose key is in the batch, as conditions in order.

    Each goes with an action, or with an error message and True. One list for every
    operator, so that what is counted, expired and written is the same.
    """
    day = _day(as_of)
    rules = [(f"not {differs}", "unchanged", False)]
    if same_day != "keep":
        message = "the batch is dated before a current version it changes"
        rules.append((f"{start} > {day}", message, True))
    if same_day == "error":
        rules.append((f"{start} = {day}", "a version changes again on the day it started", True))
    if same_day == "replace":
        rules.append((f"{start} = {day}", "amended", False))
    return [*rules, ("true", "changed", False)]


def _unknown_rules(
    as_of: dt.date, same_day: str, reopen_closed: bool, known: str, end: str
) -> list[tuple[str, str, bool]]:
    """The same for a batch row whose key has no current version."""
    rules = [(f"not {known}", "new", False)]
    if not reopen_closed:
        return [*rules, ("true", "closed_only", False)]
    if same_day != "keep":
        message = "a version that would be reopened ends on the day of the batch or later"
        rules.append((f"{end} >= {_day(as_of)}", message, True))
    return [*rules, ("true", "reopened", False)]


def _case(rules: list[tuple[str, str, bool]], result) -> str:
    """SQL for the first rule that holds; ``result`` gives the value of an action."""
    whens = [
        f"when {condition} then {f'raise_error({text(outcome)})' if fails else result(outcome)}"
        for condition, outcome, fails in rules
    ]
    return f"case {' '.join(whens)} end"


def scd2_classify(
    target: DataFrame,
    batch: DataFrame,
    dim: Dimension,
    order: Mapping[str, str] | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
    as_of: dt.date | None = None,
    reopen_closed: bool = False,
    same_day: str = "replace",
    column: str = CHANGE,
) -> DataFrame:
    """The cleaned batch with ``change_type``: what ``scd2_apply`` does with each row.

    ``changed``: a tracked value of the current version differs, nulls compared as values; a
    new version opens. ``amended``: it differs from a version of the same day, which is
    overwritten. ``unchanged``: none differs. ``closed_only``: the key has past versions only;
    ``reopened`` with ``reopen_closed``. ``new``: the key is not in the dimension at all. Options and
    errors are those of ``scd2_apply``.
    """
    _check(target, same_day, column)
    as_of = pinned_date(target.sparkSession, as_of)
    rows, small = clean_batch(target, batch, dim, order, broadcast_bytes)
    keys = [col_of(k) for k in dim.keys]
    flag = f"coalesce({ref(dim.current, 't')}, false)"
    differs = any_differs(dim.tracked, "t", "s")
    source = broadcast_if(small, rows.select(*keys, *map(col_of, dim.tracked))).alias("s")
    versions = target if small else target.where(col_of(dim.current))
    seen = (
        versions.alias("t")
        .join(source, keys_equal(dim.keys, "t", "s"))
        .selectExpr(
            *[ref(k, "t") for k in dim.keys],
            f"{flag} as __current",
            f"{flag} and {differs} as __differs",
            f"if({flag}, {ref(dim.start, 't')}, null) as __start",
            f"if({flag}, null, {_needed_end(dim, reopen_closed, 't')}) as __end",
        )
    )
    if not small:
        # A long history must not meet the batch in one task: its keys are combined first.
        past = _past(target.where(_not_current(dim)), dim, reopen_closed)
        seen = seen.unionByName(
            past.selectExpr("*", "false as __current", "false as __differs", "cast(null as date) as __start")
        )
    found = seen.groupBy(*keys).agg(
        F.expr(f"if(count_if(__current) > 1, raise_error({text(SEVERAL)}), bool_or(__current)) as __current"),
        F.expr("bool_or(__differs) as __differs"),
        F.max("__start").alias("__start"),
        F.max("__end").alias("__end"),
    )
    current = _current_rules(as_of, same_day, "h.__differs", "h.__start")
    unknown = _unknown_rules(as_of, same_day, reopen_closed, "(h.__current is not null)", "h.__end")
    change = F.expr(f"if(coalesce(h.__current, false), {_case(current, text)}, {_case(unknown, text)})")
    return (
        rows.alias("s")
        .join(found.alias("h"), keys_equal(dim.keys, "s", "h"), "left")
        .select("s.*", change.alias(column))
    )


def _needed_end(dim: Dimension, reopen_closed: bool, relation: str | None = None) -> str:
    """The end of a version where reopening asks for it; else the column need not be read."""
    return ref(dim.end, relation) if reopen_closed else "cast(null as date)"


def _past(closed: DataFrame, dim: Dimension, reopen_closed: bool) -> DataFrame:
    """The keys of closed versions and the last day of each; combined in the map tasks."""
    keys = [col_of(k) for k in dim.keys]
    if not reopen_closed:
        return closed.select(*keys).distinct().withColumn("__end", F.lit(None).cast("date"))
    return closed.groupBy(*keys).agg(F.max(col_of(dim.end)).alias("__end"))


def scd2_changed(target, batch, dim, **options) -> DataFrame:
    """Batch rows that open a new version of a known key."""
    return scd2_classify(target, batch, dim, **options).where(f"{CHANGE} = 'changed'").drop(CHANGE)


def scd2_new(target, batch, dim, **options) -> DataFrame:
    """Batch rows whose key is not in the dimension."""
    return scd2_classify(target, batch, dim, **options).where(f"{CHANGE} = 'new'").drop(CHANGE)


def scd2_metrics(classified: DataFrame, column: str = CHANGE) -> DataFrame:
    """One row of counts from ``scd2_classify``."""

    counted = {
        "expired": "changed",
        "inserted_changed": "changed",
        "inserted_new": "new",
        "reopened": "reopened",
        "amended": "amended",
        "closed_skipped": "closed_only",
        "unchanged": "unchanged",
    }
    return classified.agg(
        *[F.expr(f"count_if({ref(column)} = '{kind}') as {name}") for name, kind in counted.items()]
    )


def scd2_expire(
    target: DataFrame,
    batch: DataFrame,
    dim: Dimension,
    as_of: dt.date,
    order: Mapping[str, str] | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
    same_day: str = "replace",
) -> DataFrame:
    """All target rows; current versions that the batch changes end on ``as_of`` - 1.

    A version that ``scd2_apply`` would amend, as it began that day, is left open; where that fails
    this does too.
    """
    _check(target, same_day)
    rows, small = prepare_batch(_placeable(batch, dim), dim.keys, order, broadcast_bytes, target)
    closing = {dim.end: _day_before(as_of), dim.current: "false"}
    rules = _current_rules(as_of, same_day, any_differs(dim.tracked, "t", "s"), ref(dim.start, "t"))
    when = f"{ref(dim.current, 't')} and {_case(rules, text)} = 'changed'"
    if small:
        return updated(target, rows, dim.keys, closing, when, small)
    current = target.where(col_of(dim.current))
    changed = updated(current, rows, dim.keys, closing, when, small)
    return changed.unionByName(target.where(_not_current(dim)))


def scd2_open_rows(batch: DataFrame, dim: Dimension, as_of: dt.date) -> DataFrame:
    """Batch rows as versions that are current from ``as_of``."""
    opened = {dim.start: _day(as_of), dim.end: OPEN_END_SQL, dim.current: "true"}
    return batch.withColumns({name: F.expr(value) for name, value in opened.items()})


def _not_current(dim: Dimension) -> str:
    """SQL for closed versions; a missing flag counts as closed."""
    return f"({ref(dim.current)} is null or not {ref(dim.current)})"


def _day(date: dt.date) -> str:
    return f"DATE'{date.isoformat()}'"


def _day_before(date: dt.date) -> str:
    return _day(date - dt.timedelta(days=1))


def scd2_apply(
    target: DataFrame,
    batch: DataFrame,
    dim: Dimension,
    as_of: dt.date | None = None,
    order: Mapping[str, str] | None = None,
    reopen_closed: bool = False,
    same_day: str = "replace",
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """The whole next snapshot of a dimension, as one lazy plan over the old one.

    Equal to expiring changed versions, adding their successors and adding new keys, without
    a state in between. Options:

    ``reopen_closed``: a key with past versions only gets a new current one; by default the
    batch row has no effect. If its last version ends on the day of the batch or later the job
    fails, unless ``same_day`` is ``"keep"``.
    ``same_day``: a change on the day the current version started is written into that
    version (``"replace"``), closes it the day before it began (``"keep"``) or fails the
    job (``"error"``). A batch dated before the current version fails the job, unless
    ``"keep"``. A key of the batch with several current versions fails it in any case.
    """
    options = order, reopen_closed, same_day, broadcast_bytes
    return _next_versions(target, batch, dim, as_of, *options, with_history=True).drop(INNER)


def scd2_actions(
    target: DataFrame,
    batch: DataFrame,
    dim: Dimension,
    as_of: dt.date | None = None,
    order: Mapping[str, str] | None = None,
    reopen_closed: bool = False,
    same_day: str = "replace",
    broadcast_bytes: int = BROADCAST_BYTES,
    column: str = ACTION,
) -> DataFrame:
    """The current versions after the batch and the versions it closed, with an ``action``.

    Actions: ``kept`` (not in the batch), ``unchanged``, ``amended``, ``expired``,
    ``changed``, ``reopened``, ``new``. Versions closed earlier are not part of it: they
    never change, so they need neither a join nor a shuffle.

    A batch measured as small is broadcast to the current versions and to the key columns of
    the dimension. A larger one takes a full outer join with the current versions, one
    shuffle of each; a key has one current version (several fail the job), so no task gets
    more of a hot key.
    """
    _check(target, same_day, column)
    options = order, reopen_closed, same_day, broadcast_bytes
    found = _next_versions(target, batch, dim, as_of, *options, with_history=False)
    return found.withColumnRenamed(INNER, column)


def _next_versions(
    target, batch, dim, as_of, order, reopen_closed, same_day, broadcast_bytes, with_history
) -> DataFrame:
    _check(target, same_day)
    as_of = pinned_date(target.sparkSession, as_of)
    rows, small = clean_batch(target, batch, dim, order, broadcast_bytes)
    rows = rows.withColumn("__s", F.lit(True))
    current, closed = target.where(col_of(dim.current)), target.where(_not_current(dim))
    same_key = keys_equal(dim.keys, "t", "s")
    versions = _Versions(target, dim, as_of, same_day, reopen_closed)
    kept = f"inline(array({versions.version('kept', 't')}))"
    from_current = versions.from_current()
    from_unknown = versions.from_unknown()
    if small:
        # Nothing is shuffled here, so history comes along in the same scan, matching nothing.
        touched = (target if with_history else current).alias("t")
        on = same_key & col_of(dim.current, "t") if with_history else same_key
        matched = touched.join(F.broadcast(rows).alias("s"), on, "left")
        known = _known_keys(target, rows, dim, reopen_closed)
        unknown = _with_past(rows, known, dim).where("not __open")
        return matched.selectExpr(f"inline({from_current})").unionByName(
            unknown.alias("s").selectExpr(f"inline({from_unknown})")
        )
    past = _past(closed, dim, reopen_closed).withColumn("__open", F.lit(False))
    flagged = _with_past(rows, past, dim).alias("s")
    # Counted per key in the partitioning that the join needs anyway.
    per_key = Window.partitionBy(*[col_of(k) for k in dim.keys])
    one = F.expr(f"if(__t > 1, raise_error({text(SEVERAL)}), __t = 1)")
    keyed = current.where(f"not {any_null(dim.keys)}").withColumn("__t", F.count("*").over(per_key))
    keyed = keyed.withColumn("__t", one).alias("t")
    either = f"inline(if(t.__t is null, {from_unknown}, {from_current}))"
    result = keyed.join(flagged, same_key, "full_outer").selectExpr(either)
    # A null key matches nothing; left in the outer join, all of them would share one task.
    keyless = current.where(any_null(dim.keys))
    result = result.unionByName(keyless.alias("t").selectExpr(kept))
    return result.unionByName(closed.alias("t").selectExpr(kept)) if with_history else result


def _known_keys(
    target: DataFrame, rows: DataFrame, dim: Dimension, reopen_closed: bool
) -> DataFrame:
    """The keys of a small batch that the dimension has: whether one has a current version, and
    the last day of its closed ones.

    Reads the key columns and the flag, and the end to reopen versions. Keys are combined in the map tasks first, so a
    long history costs one row per task.
    """
    keys = [col_of(k) for k in dim.keys]
    flag = f"coalesce({ref(dim.current)}, false)"
    return (
        target.select(
            *keys, col_of(dim.current), F.expr(f"{_needed_end(dim, reopen_closed)} as __end")
        )
        .join(F.broadcast(rows.select(*keys)), list(dim.keys), "left_semi")
        .groupBy(*keys)
        .agg(
            F.expr(f"if(count_if({flag}) > 1, raise_error({text(SEVERAL)}), bool_or({flag})) as __open"),
            F.expr(f"max(if({flag}, null, __end)) as __end"),
        )
    )


def _with_past(rows: DataFrame, known: DataFrame, dim: Dimension) -> DataFrame:
    """Batch rows with ``__past`` (the key is known), ``__open`` (it has a current version) and
    ``__end`` (of its last closed one)."""
    return rows.join(known, list(dim.keys), "left").selectExpr(
        *[ref(c) for c in rows.columns],
        "__open is not null as __past",
        "coalesce(__open, false) as __open",
        "__end",
    )


class _Versions:
    """SQL for the versions, an array of structs, that a joined row of ``t`` and ``s`` gives."""

    def __init__(self, target, dim: Dimension, as_of: dt.date, same_day: str, reopen_closed: bool):
        self.fields = target.schema.fields
        self.dim = dim
        self.as_of = as_of
        self.same_day = same_day
        self.reopen_closed = reopen_closed

    def version(self, action: str, relation: str, changes: Mapping[str, str] = {}) -> str:
        parts = [f"{text(INNER)}, {text(action)}"]
        for field in self.fields:
            value = changes.get(field.name, ref(field.name, relation))
            parts.append(f"{text(field.name)}, cast({value} as {field.dataType.simpleString()})")
        return f"named_struct({', '.join(parts)})"

    def opened(self, action: str) -> str:
        dim = self.dim
        opening = {dim.start: _day(self.as_of), dim.end: OPEN_END_SQL, dim.current: "true"}
        return self.version(action, "s", opening)

    def from_unknown(self) -> str:
        """A batch row without a current version."""
        none = f"slice(array({self.opened('new')}), 1, 0)"
        rules = _unknown_rules(self.as_of, self.same_day, self.reopen_closed, "s.__past", "s.__end")
        return _case(rules, lambda a: none if a == "closed_only" else f"array({self.opened(a)})")

    def from_current(self) -> str:
        """A current version, with its batch row if there is one."""
        dim = self.dim
        copied = {c: ref(c, "s") for c in dim.overwritten}
        validity = {c: ref(c, "t") for c in dim.validity()}
        closing = {dim.end: _day_before(self.as_of), dim.current: "false"}
        results = {
            "unchanged": [self.version("unchanged", "t", copied)],
            "amended": [self.version("amended", "s", validity)],
            "changed": [self.version("expired", "t", closing), self.opened("changed")],
        }
        differs = any_differs(dim.tracked, "t", "s")
        rules = _current_rules(self.as_of, self.same_day, differs, ref(dim.start, "t"))
        known = _case(rules, lambda a: f"array({', '.join(results[a])})")
        return f"if(s.__s is null, array({self.version('kept', 't')}), {known})"


def scd2_check(df: DataFrame, dim: Dimension) -> DataFrame:
    """Violations of the version rules: key columns, start date, ``rule`` and ``versions``.

    Rules: ``missing_date`` (no start or no end), ``current_flag`` (flagged exactly when the
    end is open; without a flag a version counts as closed), ``start_after_end``,
    ``several_current``, ``overlap`` (a version starts before an earlier one has ended).

    Versions are first combined per key and start date in the map tasks. The window that
    looks for overlaps then sees at most one row per key and day, however long a history is.
    """
    keys = [ref(k) for k in dim.keys]
    start, end, current = (ref(c) for c in dim.validity())
    days = df.groupBy(*keys, start).agg(
        F.expr("count(*) as __rows"),
        F.expr(f"max({end}) as __end"),
        F.expr(f"count_if({start} is null or {end} is null) as __missing"),
        F.expr(f"count_if(coalesce({current}, false) <> ({end} = {OPEN_END_SQL})) as __flag"),
        F.expr(f"count_if({start} > {end}) as __order"),
        F.expr(f"count_if({current}) as __current"),
    )
    by_key = ", ".join(keys)
    earlier = (
        f"partition by {by_key} order by {start} rows between unbounded preceding and 1 preceding"
    )
    days = days.selectExpr(
        "*",
        f"sum(__current) over (partition by {by_key}) as __all_current",
        f"max(__end) over ({earlier}) as __earlier_end",
    )
    rules = {
        "missing_date": "__missing",
        "current_flag": "__flag",
        "start_after_end": "__order",
        "several_current": "if(__all_current > 1, __current, 0)",
        "overlap": f"if({start} is not null and __rows > 1 or coalesce(__earlier_end >= {start}, false), __rows, 0)",
    }
    found = ", ".join(
        f"named_struct('rule', '{rule}', 'versions', cast({versions} as bigint))"
        for rule, versions in rules.items()
    )
    return days.selectExpr(*keys, start, f"inline(array({found}))").where("versions > 0")


def scd2_ordered(df: DataFrame, dim: Dimension) -> DataFrame:
    """The dimension in key and start order, for reading."""
    return df.orderBy(*[col_of(k) for k in dim.keys], col_of(dim.start))
