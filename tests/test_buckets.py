import datetime as dt
import random

import pytest

from chronofold.operators import scd2
from chronofold.operators.scd2 import Dimension
from chronofold.sources import buckets, tables
from chronofold.sources.scratch import freeze
from helpers import plan, rows

DIM = Dimension(keys=("id", "part"), tracked=("city",), overwritten=("note",))
SCHEMA = "id bigint, part string, city string, note string, other int, eff_start date, eff_end date, is_current boolean"
OPEN = dt.date(9999, 12, 31)


def day(n):
    return dt.date(2024, 1, 1) + dt.timedelta(days=n)


def first_versions():
    out = []
    for i in range(60):
        out.append((i, "a", f"c{i % 7}", "n", i, day(-9), day(-2), False))
        if i % 3:
            out.append((i, "a", f"c{i % 5}", "n", i, day(-1), OPEN, True))
    out += [(None, "a", "x", "n", 0, day(-3), OPEN, True), (7, None, "y", None, 0, day(-3), day(-2), None)]
    return out


def batch(spark, seed, n=25):
    rng = random.Random(seed)
    ids = rng.sample(range(90), n)
    data = [(i, rng.choice("aab"), f"c{rng.randint(0, 5)}", rng.choice(["n", "m", None]), i + seed) for i in ids]
    return spark.createDataFrame([*data, (None, "a", "z", "n", 1)], "id int, part string, city string, note string, other int")


@pytest.mark.parametrize("share,reopen", [(0.0, True), (0.6, False), (100.0, True)])
def test_commits_give_the_rows_of_the_plain_operator(spark, schema, share, reopen):
    table = f"{schema}.d"
    expected = spark.createDataFrame(first_versions(), SCHEMA)
    buckets.create_bucketed(expected, table, DIM, buckets=3)
    expected = expected.selectExpr("id", "part", "city", "note", "other", "eff_start", "eff_end", "coalesce(is_current, false) as is_current")
    for n in range(3):
        given = batch(spark, n)
        options = {"reopen_closed": reopen, "as_of": day(n)}
        metrics = buckets.commit_bucketed(spark, table, given, DIM, share=share, **options)
        counted = scd2.scd2_metrics(scd2.scd2_classify(expected, given, DIM, **options)).first().asDict()
        assert {m: counted[m] for m in metrics if m in counted} == {m: v for m, v in metrics.items() if m in counted}
        expected = freeze(scd2.scd2_apply(expected, given, DIM, **options))
        assert rows(spark.table(table).select(*expected.columns)) == rows(expected)
    assert [r["version"] for r in tables.history(spark, table).collect()] == [3, 2, 1, 0]


def many(spark, schema, n=40_000):
    table, dim = f"{schema}.many", Dimension(keys=("id",), tracked=("v",))
    df = spark.range(n).selectExpr(
        "id", "'old' as v", "date '2023-01-01' as eff_start", "date '9999-12-31' as eff_end", "true as is_current"
    )
    buckets.create_bucketed(df, table, dim, buckets=4)
    return table, dim


def test_a_small_batch_writes_little_wherever_its_keys_are(spark, schema):
    table, dim = many(spark, schema)
    scattered = spark.range(0, 40_000, 1000).selectExpr("id", "'new' as v")
    buckets.commit_bucketed(spark, table, scattered, dim, day(0))
    store = spark.table(f"{table}__rows")
    assert store.where("__commit = 1").count() == 80 < 0.05 * 40_000
    assert store.where("__commit = 1").selectExpr("count(distinct __bucket)").first()[0] == 4
    assert spark.table(table).where("is_current").count() == 40_000
    one = spark.createDataFrame([(5, "again")], "id bigint, v string")
    buckets.commit_bucketed(spark, table, one, dim, day(1))
    assert store.where("__commit = 2").selectExpr("count(distinct __bucket)").first()[0] == 1


def test_a_bucket_is_written_whole_when_its_changes_have_grown(spark, schema):
    table, dim = many(spark, schema, 800)
    for n in range(4):
        given = spark.range(0, 800, 12).selectExpr("id", f"'v{n}' as v")
        buckets.commit_bucketed(spark, table, given, dim, day(n))
    listed = [p for p in buckets._parts(spark, table) if p.current]
    assert any(p.whole and p.commit for p in listed)
    # those of two bases before are gone
    store = buckets._open(spark, table, dim)
    bases = store.bases()
    assert all(sum(p.whole for p in listed if p.bucket == b) <= 2 for b in bases)
    assert spark.table(table).where("is_current").count() == 800
    assert scd2.scd2_check(spark.table(table), dim).isEmpty()


def test_closed_partitions_without_the_keys_are_not_read(spark, schema):
    dim = Dimension(keys=("id",), tracked=("v",))
    table = f"{schema}.d"
    df = spark.range(3000).selectExpr(
        "id", "'a' as v", "date '2023-01-01' as eff_start",
        "if(id < 1500, date '2023-02-01', date '9999-12-31') as eff_end", "id >= 1500 as is_current",
    )
    buckets.create_bucketed(df, table, dim, buckets=4)
    buckets.commit_bucketed(spark, table, spark.range(2000, 2400).selectExpr("id", "'b' as v"), dim, day(0))
    store = buckets._open(spark, table, dim)
    closed = {(p.bucket, p.commit) for p in store.parts if not p.current}
    assert len(closed) == 8
    past = spark.createDataFrame([(i,) for i in (3, 1200)], "id bigint")
    own = store.rows.where("id in (3, 1200) and not is_current").select("__bucket", "__commit").distinct()
    found = set(buckets.closed_partitions(store, past))
    assert {tuple(r) for r in own.collect()} <= found < closed
    fresh = spark.createDataFrame([(10**9,)], "id bigint")
    assert len(buckets.closed_partitions(store, fresh)) <= 1
    assert buckets.closed_partitions(store, past.limit(0)) == []
    keys = spark.createDataFrame([(2500,), (1600,)], "id bigint")
    touched = plan(buckets._touched(store, keys, "__bucket in (0, 1, 2, 3)", 2**26))
    # all keys have current versions, so no closed partition is left in the plan
    assert touched.count("Scan parquet") == plan(spark.sql(store.current_sql())).count("Scan parquet")


def test_no_key_is_missed_by_the_bitmaps(spark, schema):
    dim = Dimension(keys=("id",), tracked=("v",))
    table = f"{schema}.d"
    df = spark.range(70_000).selectExpr(
        "id", "'a' as v", "date '2023-01-01' as eff_start", "date '2023-02-01' as eff_end", "false as is_current"
    )
    buckets.create_bucketed(df, table, dim, buckets=2)
    given = spark.range(0, 70_000, 7).selectExpr("id", "'b' as v").union(spark.range(70_000, 70_010).selectExpr("id", "'b'"))
    metrics = buckets.commit_bucketed(spark, table, given, dim, day(0))
    assert (metrics["inserted_new"], metrics["inserted_changed"]) == (10, 0)
    assert buckets.commit_bucketed(spark, table, given, dim, day(0), reopen_closed=True)["reopened"] == 10_000


def test_of_two_interleaved_commits_none_is_lost(spark, schema, monkeypatch):
    table, dim = many(spark, schema, 100)
    plain, calls = buckets._stage, []

    def stage(*args):
        staged = plain(*args)
        calls.append(args[0].live)
        if len(calls) == 1:
            # the other writer is faster
            buckets.commit_bucketed(spark, table, spark.range(5).selectExpr("id", "'other' as v"), dim, day(0))
        return staged

    monkeypatch.setattr(buckets, "_stage", stage)
    buckets.commit_bucketed(spark, table, spark.range(3, 8).selectExpr("id", "'mine' as v"), dim, day(1))
    assert calls == [0, 0, 1]
    current = spark.table(table).where("is_current and v <> 'old'").select("id", "v")
    assert dict(tuple(r) for r in current.collect()) == {0: "other", 1: "other", 2: "other"} | {i: "mine" for i in range(3, 8)}
    closed = spark.table(table).where("v = 'other' and not is_current").select("id").collect()
    assert sorted(r[0] for r in closed) == [3, 4]
    assert [r["version"] for r in tables.history(spark, table).collect()] == [2, 1, 0]


def test_one_writer_holds_a_table(spark, schema):
    table, dim = many(spark, schema, 10)
    given = spark.range(2).selectExpr("id", "'new' as v")
    with buckets.claimed(spark, table):
        with pytest.raises(buckets.Conflict, match="release"):
            buckets.commit_bucketed(spark, table, given, dim, day(0), patience=0.2)
    assert spark.table(table).where("v = 'new'").isEmpty()
    buckets.commit_bucketed(spark, table, given, dim, day(0), patience=0.2)
    assert spark.table(table).where("v = 'new'").count() == 2


@pytest.mark.parametrize("step", ["_add_bitmaps", "point_view"])
def test_a_commit_that_is_cut_off_has_no_effect(spark, schema, monkeypatch, step):
    table, dim = many(spark, schema, 40)
    before = rows(spark.table(table))

    def failing(*_, **__):
        raise RuntimeError("cut off")

    with monkeypatch.context() as m:
        m.setattr(buckets, step, failing)
        with pytest.raises(RuntimeError, match="cut off"):
            buckets.commit_bucketed(spark, table, spark.range(9).selectExpr("id", "'lost' as v"), dim, day(0))
    assert rows(spark.table(table)) == before
    buckets.commit_bucketed(spark, table, spark.range(2).selectExpr("id", "'new' as v"), dim, day(0))
    assert spark.table(table).where("v = 'lost'").isEmpty()
    assert spark.table(table).where("v = 'new'").count() == 2


def test_fingerprints(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (2, None), (3, "")], "k int, v string")
    mark = buckets.fingerprint(df)
    assert buckets.fingerprint(df.repartition(3).orderBy("k", ascending=False).select("v", "k")) == mark
    others = [df.distinct(), df.na.fill("a"), df.withColumnRenamed("v", "w"), df.limit(0), df.union(df), df.na.fill("x")]
    assert len({buckets.fingerprint(o) for o in others} | {mark}) == 7


def test_a_replayed_batch_is_listed_and_changes_nothing(spark, schema):
    table, dim = many(spark, schema, 20)
    old = spark.range(4).selectExpr("id", "'one' as v")
    buckets.commit_bucketed(spark, table, old, dim, day(0), skip_replays=True)
    buckets.commit_bucketed(spark, table, spark.range(4).selectExpr("id", "'two' as v"), dim, day(1), skip_replays=True)
    before = rows(spark.table(table))
    assert buckets.commit_bucketed(spark, table, old.repartition(3), dim, day(2), skip_replays=True) == {}
    assert rows(spark.table(table)) == before
    assert [r["operation"] for r in tables.history(spark, table).collect()] == ["REPLAY", "SCD2", "SCD2", "CREATE"]
    buckets.commit_bucketed(spark, table, old, dim, day(3))
    assert spark.table(table).where("is_current and v = 'one'").count() == 4


def test_a_commit_that_breaks_a_rule_is_not_shown(spark, schema):
    table, dim = many(spark, schema, 20)
    before = rows(spark.table(table))
    given = spark.range(4).selectExpr("id", "'early' as v")
    options = {"same_day": "keep", "check": True}
    assert buckets.commit_bucketed(spark, table, given, dim, dt.date(2022, 1, 1), **options)["violations"] > 0
    assert rows(spark.table(table)) == before
    assert tables.history(spark, table).first()["operation"] == "REJECTED"
    buckets.commit_bucketed(spark, table, given, dim, day(0), **options)
    assert spark.table(table).where("is_current and v = 'early'").count() == 4


def test_only_the_keys_of_a_batch_are_judged(spark, schema):
    dim, table = Dimension(keys=("id",), tracked=("v",)), f"{schema}.d"
    broken = [(None, "a", day(0), OPEN, True), (None, "b", day(0), OPEN, True), (1, "a", day(5), day(3), False), (1, "a", day(6), OPEN, True)]
    df = spark.createDataFrame([*broken, (2, "a", day(0), OPEN, True)], "id bigint, v string, eff_start date, eff_end date, is_current boolean")
    buckets.create_bucketed(df, table, dim, buckets=1)
    options = {"check": True, "share": 0.0}
    assert buckets.commit_bucketed(spark, table, spark.createDataFrame([(2, "b")], "id bigint, v string"), dim, day(9), **options)["expired"] == 1
    assert buckets.commit_bucketed(spark, table, spark.createDataFrame([(1, "b")], "id bigint, v string"), dim, day(9), **options) == {"violations": 1}
    assert spark.table(table).where("is_current").count() == 4


def test_kinds_and_names(spark, schema):
    table, dim = many(spark, schema, 5)
    with pytest.raises(ValueError, match="is a bucketed table"):
        tables.publish(spark.range(1), table)
    with pytest.raises(ValueError, match="names that are needed"):
        buckets.create_bucketed(spark.table(table).selectExpr("*", "1 as __bucket"), f"{schema}.x", dim)
    with pytest.raises(ValueError, match="exists"):
        buckets.create_bucketed(spark.table(table), table, dim)
    tables.drop_table(spark, table)
    assert spark.sql(f"show tables in {schema}").isEmpty()


def test_an_empty_batch(spark, schema):
    table, dim = many(spark, schema, 5)
    before = rows(spark.table(table))
    metrics = buckets.commit_bucketed(spark, table, spark.range(0).selectExpr("id", "'x' as v"), dim, day(0), check=True)
    assert set(metrics.values()) == {0} and rows(spark.table(table)) == before
