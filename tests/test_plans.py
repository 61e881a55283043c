"""Shapes of the plans that matter at scale."""

import datetime as dt

import pytest

from chronofold.operators import merge, scd2, sizing
from chronofold.operators.sizing import measure, measure_by_key
from helpers import plan, rows
from test_scd2 import BATCH, DAY, DIM, TARGET, target  # noqa: F401


@pytest.fixture
def no_auto_broadcast(small_conf):
    small_conf("spark.sql.autoBroadcastJoinThreshold", "-1")


@pytest.fixture
def stored(spark, target, tmp_path):  # noqa: F811
    path = str(tmp_path / "dim")
    target.write.partitionBy("live").parquet(path)
    return spark.read.schema(target.schema).parquet(path)


def batch(spark):
    return spark.createDataFrame([(70, "lathe", "annex"), (83, "crane", "dock")], BATCH)


def test_small_batch_shuffles_keys_only(spark, stored, no_auto_broadcast):
    text = plan(scd2.scd2_actions(stored, batch(spark), DIM, DAY))
    assert "BroadcastHashJoin [code#" in text and "LeftOuter, BuildRight" in text
    assert "LeftSemi, BuildRight" in text
    for line in text.splitlines():
        if "Exchange hashpartitioning" in line:
            assert "code#" in line
    assert "PartitionFilters: [isnotnull(live" in text


def test_key_scan_reads_only_keys(spark, stored, no_auto_broadcast):
    text = plan(scd2.scd2_actions(stored, batch(spark), DIM, DAY))
    assert "ReadSchema: struct<code:int>" in text


def test_large_batch_takes_one_outer_join_of_current_rows(spark, stored, no_auto_broadcast):
    text = plan(scd2.scd2_actions(stored, batch(spark), DIM, DAY, broadcast_bytes=0))
    assert text.count("FullOuter") == 1
    assert "BroadcastExchange" not in text


def test_large_batch_stays_in_pushed_partitions(spark, stored):
    actions = scd2.scd2_apply(stored, batch(spark), DIM, DAY, broadcast_bytes=0)
    assert actions.count() == 8


def test_hot_target_keys_are_dealt_out_without_aqe(spark, small_conf, no_auto_broadcast):
    """Null keys bypass the join; a hot key's rows go to several partitions of it."""
    small_conf("spark.sql.adaptive.enabled", "false")
    hot = spark.range(3000, numPartitions=8).selectExpr("if(id % 10 < 3, null, if(id % 10 < 9, 1, id)) as k", "id as v")
    batch = spark.range(100).selectExpr("id as k", "-id as v")
    result = merge.updated(hot, batch, ["k"], {"v": "s.v"}, None, False, rows_per_salt=100)
    text = plan(result)
    assert text.count("LeftOuter") >= 1 and "isnotnull(" in text.lower()
    parts = result.where("k = 1").selectExpr("spark_partition_id() as p").distinct().count()
    assert parts > 3
    expected = hot.alias("t").join(batch.alias("s"), "k", "left").selectExpr("k", "coalesce(s.v, t.v)")
    assert rows(result) == rows(expected)


def test_measure(spark):
    df = spark.createDataFrame(
        [(1, "abc", [1, 2], None), (1, None, None, b"xy")],
        "k int, s string, a array<int>, b binary",
    )
    size = measure_by_key(df, ["k"])
    assert (size.rows, size.most_per_key) == (2, 2)
    assert size.bytes == measure(df).bytes >= 2 * (16 + 8 * 4) + 3 + 2
    assert measure(df.limit(0)).bytes == 0
    assert size.fits(sizing.BROADCAST_BYTES) and not size.fits(0)


def test_measure_counts_what_values_hold(spark):
    wide = "parse_json(concat('\"', repeat('x', 10000), '\"'))"
    for value in (wide, f"array({wide})", "map('k', repeat('x', 10000))", "array(named_struct('s', repeat('x', 10000)))"):
        assert measure(spark.sql(f"select {value} as v from range(10)")).bytes > 10 * 10_000
    structs = "transform(sequence(1, 100), i -> named_struct('a', cast(null as bigint), 'b', cast(null as bigint)))"
    assert measure(spark.sql(f"select {structs} as v from range(100)")).bytes > 100 * 100 * 16
    empty = spark.sql("select cast(null as array<map<string, array<string>>>) as v, cast(null as variant) as w")
    assert 0 < measure(empty).bytes < 200


def test_a_type_without_a_rule_is_never_small(spark, monkeypatch):
    df = spark.sql("select id, make_interval(0, 1, 0, 1) as i from range(3)")
    assert not measure(df).fits(1 << 50) and measure(df).rows == 3


def test_operators_do_not_collect_rows():
    """Rows reach the driver only as aggregates, dates, schemas and catalog listings."""
    from pathlib import Path

    import chronofold

    root = Path(chronofold.__file__).parent
    for path in root.rglob("*.py"):
        if path.parent.name == "llm":
            continue
        source = path.read_text()
        for banned in (".toPandas(", ".rdd", "localCheckpoint", "crossJoin", ".limit(", "rand("):
            assert banned not in source, f"{banned} in {path.name}"
        if path.parent.name in ("operators", "functions", "plans"):
            assert ".collect()" not in source, path.name
