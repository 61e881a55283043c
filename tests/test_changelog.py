import datetime as dt
import random

import pytest

from chronofold.operators import changelog, neighbours
from chronofold.operators.merge import DuplicateKeys
from chronofold.operators.scd2 import Dimension, scd2_check
from helpers import rows

DIM = Dimension(keys=("id",), tracked=("city",))
NOTED = Dimension(keys=("id",), tracked=("city",), overwritten=("note",))
SCHEMA = "id bigint, city string, note string, eff_start date, eff_end date, is_current boolean"
ROWS = "id bigint, city string, note string, day date, n int"
OPEN = dt.date(9999, 12, 31)


def d(n):
    return dt.date(2024, 1, 1) + dt.timedelta(days=n)


def histories(seed, keys=30, most=4):
    """Versions without overlaps, some with gaps between, some keys closed, and rows without a key."""
    rng, out = random.Random(seed), [(None, "x", None, d(0), OPEN, True), (None, "y", None, d(0), d(1), False)]
    for key in range(keys):
        at, n = rng.randint(0, 20), rng.randint(1, most)
        for i in range(n):
            end = at + rng.randint(0, 9)
            last = i == n - 1 and rng.random() < 0.7
            out.append((key, rng.choice("abc"), rng.choice(["n", None]), d(at), OPEN if last else d(end), last))
            at = end + rng.choice([1, 1, 5])
    return out


@pytest.fixture(params=["few", "many"])
def way(request, small_conf):
    """Small batches, and plans for large ones with keys over several tasks."""
    small_conf("spark.sql.adaptive.coalescePartitions.enabled", "false")
    return {} if request.param == "few" else {"broadcast_bytes": 0}


def by_hand_log(versions, log, dim, reopen):
    out = [v for v in versions if v[0] is None]
    for key in {v[0] for v in versions} | {r[0] for r in log}:
        if key is None:
            continue
        own = [v for v in versions if v[0] == key]
        mine = {}
        for r in sorted((r for r in log if r[0] == key and r[3] is not None), key=lambda r: r[4]):
            mine[r[3]] = r
        current = [v for v in own if v[5]]
        if not mine or own and not current and not reopen:
            out += own
            continue
        out += [v for v in own if not v[5]]
        events = {v[3]: v[1:3] for v in current} | {day: r[1:3] for day, r in mine.items()}
        islands = []
        for day, (city, note) in sorted(events.items()):
            if islands and islands[-1][0] == city:
                if dim.overwritten:
                    islands[-1][1] = note
            else:
                islands.append([city, note, day])
        for i, (city, note, day) in enumerate(islands):
            end = islands[i + 1][2] - dt.timedelta(days=1) if i + 1 < len(islands) else OPEN
            out.append((key, city, note, day, end, end == OPEN))
    return out


def counted(listed):
    from collections import Counter

    return Counter(listed)


@pytest.mark.parametrize("dim", [DIM, NOTED], ids=["plain", "overwritten"])
@pytest.mark.parametrize("reopen", [False, True])
def test_change_log_by_hand(spark, way, dim, reopen):
    versions = histories(3)
    begins = {v[0]: v[3] for v in versions if v[5]}
    ends = {}
    for v in versions:
        ends[v[0]] = max(ends.get(v[0], v[4]), v[4])
    rng, log = random.Random(4), [(None, "z", "n", d(3), 0), (1, "z", "n", None, 0)]
    for i in range(300):
        key = rng.choice([0, 0, 0, *range(40)])
        first = begins.get(key) or (ends[key] + dt.timedelta(days=1) if key in ends else d(0))
        log.append((key, rng.choice("aab"), rng.choice(["m", None, "n"]), first + dt.timedelta(days=rng.randint(0, 60)), i))
    got = changelog.scd2_change_log(
        spark.createDataFrame(versions, SCHEMA), spark.createDataFrame(log, ROWS).repartition(3), dim, "day", {"n": "desc"}, reopen, **way
    )
    assert got.columns == ["id", "city", "note", "eff_start", "eff_end", "is_current"]
    assert rows(got) == counted(by_hand_log(versions, log, dim, reopen))


def test_change_log_errors(spark):
    target = spark.createDataFrame([(1, "a", None, d(5), OPEN, True), (2, "a", None, d(0), d(9), False)], SCHEMA)

    def run(*log, **options):
        return changelog.scd2_change_log(target, spark.createDataFrame([(*r, 0) for r in log], ROWS), DIM, "day", **options).collect()

    with pytest.raises(Exception, match="dated before the current version"):
        run((1, "b", "n", d(4)))
    with pytest.raises(Exception, match="would be reopened"):
        run((2, "b", "n", d(9)), reopen_closed=True)
    with pytest.raises(DuplicateKeys):
        run((1, "b", "n", d(6)), (1, "c", "n", d(6)))
    with pytest.raises(ValueError, match="lack columns"):
        changelog.scd2_change_log(target, target.select("id", "city"), DIM, "day")
    twice = target.union(target)
    with pytest.raises(Exception, match="several current"):
        changelog.scd2_change_log(twice, spark.createDataFrame([(1, "b", "n", d(6), 0)], ROWS), DIM, "day").collect()


def test_a_hot_key_of_the_log_is_in_many_tasks(spark, small_conf):
    small_conf("spark.sql.adaptive.coalescePartitions.enabled", "false")
    log = spark.range(4000).selectExpr(
        "7L as id", "cast(id div 2 % 3 as string) as city", "'n' as note", "date_add(date'2000-01-01', cast(id as int)) as day", "1 as n"
    )
    placed = neighbours.in_order(log, ["id"], ["day"])
    assert placed.select("__task").distinct().count() > 4
    empty = spark.createDataFrame([], SCHEMA)
    got = changelog.scd2_change_log(empty, log, DIM, "day", broadcast_bytes=0)
    assert got.count() == 2000 and got.where("is_current").count() == 1
    assert scd2_check(got, DIM).isEmpty()


def by_hand_late(versions, late, reopen):
    """Applies the rows one after another to lists of versions."""
    by = {}
    for v in versions:
        by.setdefault(v[0], []).append(v)
    past_only = {k for k, own in by.items() if k is not None and not any(v[5] for v in own)}
    for key, city, note, day, _ in sorted((r for r in late if r[0] is not None and r[3] is not None), key=lambda r: (r[0], r[3])):
        own = sorted(by.setdefault(key, []), key=lambda v: v[3])
        cover = next((v for v in own if v[3] <= day <= v[4]), None)
        later = [v[3] for v in own if v[3] > day]
        if cover:
            if cover[1] == city:
                continue
            own.remove(cover)
            if cover[3] < day:
                own.append((*cover[:4], day - dt.timedelta(days=1), False))
            own.append((key, city, note, day, cover[4], cover[5]))
        elif later:
            own.append((key, city, note, day, min(later) - dt.timedelta(days=1), False))
        elif not own or reopen or key not in past_only:
            own.append((key, city, note, day, OPEN, True))
        by[key] = own
    return [v for own in by.values() for v in own]


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("reopen", [False, True])
def test_late_rows_by_hand(spark, way, reopen, seed):
    versions = histories(seed)
    rng, late = random.Random(seed + 50), {}
    for _ in range(250):
        key, day = rng.choice([0, 0, 0, *range(40), None]), rng.choice([None, *map(d, range(70))])
        late[key, day] = (key, rng.choice("abc"), "late", day, 0)
    target = spark.createDataFrame(versions, SCHEMA).repartition(3)
    batch = spark.createDataFrame(list(late.values()), ROWS).repartition(2)
    got = changelog.scd2_apply_late(target, batch, DIM, "day", reopen_closed=reopen, **way)
    assert got.columns == target.columns
    assert rows(got) == counted(by_hand_late(versions, list(late.values()), reopen))
    assert scd2_check(got.where("id is not null"), DIM).isEmpty()


def test_late_row_in_a_long_history(spark, small_conf):
    small_conf("spark.sql.adaptive.coalescePartitions.enabled", "false")
    target = spark.range(3000).selectExpr(
        "1L as id", "cast(id % 2 as string) as city", "'n' as note", "date_add(date'2000-01-01', cast(id * 3 as int)) as eff_start",
        "if(id = 2999, date'9999-12-31', date_add(date'2000-01-01', cast(id * 3 + 2 as int))) as eff_end", "id = 2999 as is_current",
    )
    batch = target.selectExpr("id", "'x' as city", "note", "date_add(eff_start, 1) as day").where("note = 'n'")
    got = changelog.scd2_apply_late(target, batch, DIM, "day", broadcast_bytes=0)
    assert got.count() == 6000 and scd2_check(got, DIM).isEmpty()
    assert got.where("is_current").first()["city"] == "x"


def test_names_that_are_needed(spark):
    target = spark.createDataFrame([], SCHEMA)
    with pytest.raises(ValueError, match="names that are needed"):
        changelog.scd2_apply_late(target.selectExpr("*", "1 as __cut"), target, DIM, "day")


def test_nearest(spark, small_conf):
    small_conf("spark.sql.adaptive.coalescePartitions.enabled", "false")
    rng = random.Random(9)
    listed = [(rng.choice([1, 1, 1, 2, None]), i, rng.random() < 0.01) for i in range(900)]
    placed = neighbours.in_order(spark.createDataFrame(listed, "k int, i int, m boolean"), ["k"], ["i"])
    for later in (False, True):
        got = neighbours.nearest(placed, ["k"], {"near": ("i", "m"), "next": ("i", "true")}, later)
        for k, i, _, _, _, near, beside in got.select("k", "i", "m", "__task", "__position", "near", "next").collect():
            side = [(j, m) for o, j, m in listed if o == k and (j > i if later else j < i)]
            pick = min if later else max
            assert near == pick((j for j, m in side if m), default=None)
            assert beside == pick((j for j, _ in side), default=None)
