"""Type 2 dimensions from changes that are not one row a key and newer than all before: logs and late batches."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from chronofold.functions import OPEN_END_SQL, any_null, col_of, ref, text
from chronofold.operators.merge import prepare_batch
from chronofold.operators.neighbours import in_order, nearest, without_place
from chronofold.operators.scd2 import SEVERAL, Dimension
from chronofold.operators.sizing import BROADCAST_BYTES, broadcast_if
from chronofold.operators.skew import salted_join
from chronofold.sources.scratch import freeze

AT = "__at"
RESERVED = {
    AT, "__log", "__open", "__end", "__task", "__position", "__dealt", "__prev", "__starts", "__next", "__ends", "__last", "__cover",
    "__before", "__differs", "__version", "__cut", "__following",
}


def _prepared(
    target: DataFrame, rows: DataFrame, dim: Dimension, at: str, order: Mapping[str, str] | None, broadcast_bytes: int
) -> tuple[DataFrame, bool]:
    """The rows by name and in the target's types, one for each key and day, and whether they are few.

    Rows without a key or a day can't be placed and are left out.
    """
    fields = dim.attributes(target)
    taken = sorted(RESERVED & {c.lower() for c in (*target.columns, *rows.columns)})
    if taken:
        raise ValueError(f"columns have names that are needed here: {taken}")
    missing = [c for c in [f.name for f in fields] + [at] if c not in rows.columns]
    if missing:
        raise ValueError(f"the rows lack columns of the dimension: {missing}")
    names = [f.name for f in fields]
    typed = [F.expr(f"cast({ref(f.name)} as {f.dataType.simpleString()}) as {ref(f.name)}") for f in fields]
    rest = [col_of(c) for c in order or {} if c not in names]
    placed = rows.select(*typed, *rest, col_of(at).cast("date").alias(AT))
    placed = placed.where(f"NOT {any_null([*dim.keys, AT])}")
    one, small = prepare_batch(placed, [*dim.keys, AT], order, broadcast_bytes)
    return freeze(one.select(*map(col_of, names), AT)), small


def _led(big: DataFrame, other: DataFrame, keys: Sequence[str], small: bool) -> DataFrame:
    """A left join with a side of one row a key; keys with very many rows of ``big`` are dealt over tasks."""
    return big.join(F.broadcast(other), list(keys), "left") if small else salted_join(big, other, keys, "left")


def _value(columns, relation: str | None = None) -> str:
    """Columns as one struct, whose fields keep their names."""
    return f"named_struct({', '.join(f'{text(c)}, {ref(c, relation)}' for c in columns)})"


def _differs(columns, struct: str) -> str:
    same = " AND ".join(f"{struct}.{ref(c)} <=> {ref(c)}" for c in columns)
    return f"(NOT ({same}))"


def _version(target: DataFrame, dim: Dimension, start: str, end: str, changes: Mapping[str, str] = {}) -> list[Column]:
    """A version in the target's columns."""
    validity = {dim.start: start, dim.end: end, dim.current: f"{end} = {OPEN_END_SQL}"}
    values = {f.name: validity.get(f.name, changes.get(f.name, ref(f.name))) for f in target.schema.fields}
    return [F.expr(f"cast({values[f.name]} as {f.dataType.simpleString()})").alias(f.name) for f in target.schema.fields]


def _split(target: DataFrame, rows: DataFrame, dim: Dimension, small: bool) -> tuple[DataFrame, DataFrame]:
    """The target's rows with a key of these rows, and the others, null keys among them."""
    keys = rows.select(*map(col_of, dim.keys)).distinct().withColumn("__log", F.lit(True))
    found = _led(target, keys, dim.keys, small)
    columns = [col_of(c) for c in target.columns]
    return freeze(found.where("__log").select(*columns)), found.where("__log is null").select(*columns)


def scd2_change_log(
    target: DataFrame,
    log: DataFrame,
    dim: Dimension,
    at: str,
    order: Mapping[str, str] | None = None,
    reopen_closed: bool = False,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """The next snapshot after a log with any number of changes a key, each from its day ``at`` on.

    Of several rows of a key and day the first by ``order`` counts; without it they raise ``DuplicateKeys``. Neighbours with
    equal tracked values are one version, from the first one's day, with ``overwritten`` columns of the last. Each other row
    opens a version, which ends on the day before the next. A row of the day on which the current version began is
    written into that version; an earlier one fails the job (see ``scd2_apply_late``), as do several current versions. A key with
    closed versions only has no effect, or with ``reopen_closed`` new versions, which must begin after the last has ended.

    Keys of the log are sorted by day over all tasks, so the changes of one key may be any part of the log.
    """
    rows, small = _prepared(target, log, dim, at, order, broadcast_bytes)
    mine, others = _split(target, rows, dim, small)
    keys = [col_of(k) for k in dim.keys]
    flag = f"coalesce({ref(dim.current)}, false)"
    # combined in the map tasks: a long history is one row for each task
    known = mine.groupBy(*keys).agg(
        F.expr(f"if(count_if({flag}) > 1, raise_error({text(SEVERAL)}), max(if({flag}, {ref(dim.start)}, null))) as __open"),
        F.expr(f"max(if({flag}, null, {ref(dim.end)})) as __end"),
        F.expr(f"bool_or({flag}) as __log"),
    )
    known = freeze(known)
    early = text("a change of the log is dated before the current version")
    ended = text("a version that would be reopened ends on the day of a change or later")
    placed = _led(rows, known, dim.keys, small)
    effect = (
        f"case when __log is null then true when __log then if({AT} < __open, raise_error({early}), true) "
        + (f"else if({AT} <= __end, raise_error({ended}), true) end" if reopen_closed else "else false end")
    )
    placed = placed.where(F.expr(effect)).drop("__log", "__end")
    # the current version is the first change; one of the same day takes its place
    attributes = [c for c in rows.columns if c != AT]
    amended = placed.where(f"{AT} = __open").select(*keys).distinct()
    current = mine.where(flag)
    first = current.join(broadcast_if(small, amended), list(dim.keys), "left_anti")
    changes = placed.select(*map(col_of, attributes), AT).unionByName(
        first.select(*map(col_of, attributes), col_of(dim.start).alias(AT))
    )
    ordered = nearest(in_order(changes, dim.keys, [AT]), dim.keys, {"__prev": (_value(dim.tracked), "true")})
    ordered = ordered.withColumn("__starts", F.expr(f"__prev is null or {_differs(dim.tracked, '__prev')}")).drop("__prev")
    if dim.overwritten:
        ordered = nearest(freeze(ordered), dim.keys, {"__next": ("__starts", "true")}, later=True)
        ordered = ordered.withColumn("__ends", F.expr("coalesce(__next, true)")).drop("__next")
    else:
        ordered = ordered.where("__starts")
    ordered = freeze(ordered)
    found = {"__following": (AT, "__starts")}
    if dim.overwritten:
        found["__last"] = (_value(dim.overwritten), "__ends")
    ordered = nearest(ordered, dim.keys, found, later=True).where("__starts")
    last = {c: f"if(__ends, {ref(c)}, __last.{ref(c)})" for c in dim.overwritten}
    end = f"coalesce(date_sub(__following, 1), {OPEN_END_SQL})"
    versions = without_place(ordered).select(*_version(target, dim, AT, end, last))
    return others.unionByName(mine.where(f"not {flag}")).unionByName(versions)


def scd2_apply_late(
    target: DataFrame,
    batch: DataFrame,
    dim: Dimension,
    at: str,
    order: Mapping[str, str] | None = None,
    reopen_closed: bool = False,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """The next snapshot after rows that tell what was so from a day ``at`` on, which may be long past.

    A row with the tracked values of the version of its day changes nothing. Otherwise it takes the rest of that version: the
    version ends on the day before, and the row is valid until that version's end. On the day the version began the row takes its
    place. Where no version holds the day, it is valid until the next one, or is current if there is none; a key with closed versions
    only gets a current one by ``reopen_closed`` alone. Several rows of a key are taken in order of their days, those of
    one day as in ``scd2_change_log``. ``overwritten`` columns are set when a version opens. Versions must not overlap.

    Versions of the batch's keys and its rows are sorted together over all tasks; other keys are not shuffled if the batch is small.
    """
    rows, small = _prepared(target, batch, dim, at, order, broadcast_bytes)
    mine, others = _split(target, rows, dim, small)
    names = dim.validity()
    attributes = [c for c in rows.columns if c != AT]
    own = mine.select(
        *map(col_of, attributes), F.expr(f"{ref(dim.start)} as {AT}"), F.lit(False).alias("__log"), col_of(dim.end).alias("__end"),
        col_of(dim.current).alias("__open"),
    )
    given = rows.withColumns({"__log": F.lit(True), "__end": F.lit(None).cast("date"), "__open": F.lit(None).cast("boolean")})
    placed = in_order(own.unionByName(given), dim.keys, [AT, "__log"])
    values = _value(dim.tracked)
    found = {
        "__cover": (f"named_struct('s', {AT}, 'e', __end, 'v', {values})", "not __log"),
        "__before": (f"named_struct('s', {AT}, 'v', {values})", "__log"),
    }
    judged = nearest(placed, dim.keys, found)
    held = f"coalesce(__cover.e >= {AT}, false)"
    # what the row before in the batch has said still holds, if no version began since
    from_before = f"coalesce(__before.s >= __cover.s and ({held} or __before.s > __cover.e), __before.s is not null and __cover is null)"
    differs = (
        f"case when {from_before} then {_differs(dim.tracked, '__before.v')} "
        f"when {held} then {_differs(dim.tracked, '__cover.v')} else true end"
    )
    judged = freeze(judged.withColumn("__differs", F.expr(f"__log and {differs}")).drop("__before"))
    found = {
        "__version": (AT, "not __log"),
        "__cut": (AT, "__differs"),
    }
    judged = nearest(judged, dim.keys, found, later=True)
    stays = f"__log is false and not coalesce(__cut = {AT}, false)"
    # nothing but closed versions before it
    past = f"(__cover is not null and not {held} and __version is null)"
    opens = "__differs" + ("" if reopen_closed else f" and not {past}")
    until = f"if(__log, if({held}, __cover.e, coalesce(date_sub(__version, 1), {OPEN_END_SQL})), __end)"
    end = f"least({until}, coalesce(date_sub(__cut, 1), {until}))"
    versions = without_place(judged).where(f"({stays}) or ({opens})")
    kept = _version(target, dim, AT, end)
    flag = names[2]
    # a version that keeps its end keeps its flag as it was
    kept = [
        F.expr(f"if(not __log and ({end} <=> __end), __open, {end} = {OPEN_END_SQL})").alias(flag) if f.name == flag else c
        for f, c in zip(target.schema.fields, kept)
    ]
    return others.unionByName(versions.select(*kept))
