import datetime as dt
from pathlib import Path
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from chronofold.operators import scd2
from chronofold.sources import dimension, scratch, tables
from helpers import plan, rows
from test_scd2 import BATCH, DAY, DIM, EVE, OPEN, TARGET, d, target  # noqa: F401


def numbers(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "v int")


def test_publish_replaces_what_it_reads(spark, schema):
    table = f"{schema}.numbers"
    assert tables.publish(numbers(spark, 1, 2), table) == 1
    before = spark.table(table)
    assert tables.publish(spark.table(table).union(numbers(spark, 3)), table) == 2
    assert rows(spark.table(table)) == {(1,): 1, (2,): 1, (3,): 1}
    assert rows(before) == {(1,): 1, (2,): 1}, "a reader that began earlier keeps its version"


def test_publish_drops_old_versions(spark, schema):
    table = f"{schema}.numbers"
    for n in range(4):
        tables.publish(numbers(spark, n), table)
    data = {r["tableName"] for r in spark.sql(f"show tables in {schema}").collect()}
    assert data == {"numbers", "numbers__v3", "numbers__v4", "numbers__audit"}


def test_publish_may_change_the_schema(spark, schema):
    table = f"{schema}.numbers"
    tables.publish(numbers(spark, 1), table)
    tables.publish(numbers(spark, 1).withColumn("w", F.lit("x")), table)
    assert rows(spark.table(table)) == {(1, "x"): 1}


def test_failed_publish_changes_nothing(spark, schema):
    table = f"{schema}.numbers"
    tables.publish(numbers(spark, 1), table)
    failing = numbers(spark, 2).selectExpr("if(v = 2, raise_error('broken'), v) as v")
    with pytest.raises(Exception, match="broken"):
        tables.publish(failing, table)
    assert rows(spark.table(table)) == {(1,): 1}
    assert tables.publish(numbers(spark, 5), table) == 2
    assert rows(spark.table(table)) == {(5,): 1}


def failing(*_, **__):
    raise RuntimeError("cut off")


def test_interrupted_before_the_view_changed(spark, schema, monkeypatch):
    table = f"{schema}.numbers"
    tables.publish(numbers(spark, 1), table)
    for step in ("add_audit", "point_view"):
        with monkeypatch.context() as m:
            m.setattr(tables, step, failing)
            with pytest.raises(RuntimeError, match="cut off"):
                tables.publish(numbers(spark, 7), table, metrics={"rows": 7})
        assert rows(spark.table(table)) == {(1,): 1}
        assert [r["version"] for r in tables.history(spark, table).collect()] == [1]
    tables.publish(numbers(spark, 8), table, metrics={"rows": 8})
    assert rows(spark.table(table)) == {(8,): 1}
    assert [(r["version"], r["metrics"]) for r in tables.history(spark, table).collect()] == [
        (2, {"rows": "8"}),
        (1, {}),
    ]


@pytest.mark.parametrize("step", ["claim", "add_audit", "point_view"])
def test_a_first_publish_that_is_cut_off_loses_nothing(spark, schema, monkeypatch, step):
    table = f"{schema}.numbers"
    numbers(spark, 1, 2).write.saveAsTable(table)
    with monkeypatch.context() as m:
        m.setattr(tables, step, failing)
        with pytest.raises(RuntimeError, match="cut off"):
            tables.publish(numbers(spark, 3), table)
    assert tables.live_version(spark, table) is None
    assert rows(spark.table(table)) == {(1,): 1, (2,): 1}
    assert tables.publish(spark.table(table).union(numbers(spark, 3)), table) == 1
    assert rows(spark.table(table)) == {(1,): 1, (2,): 1, (3,): 1}
    assert rows(spark.table(f"{table}__v0")) == {(1,): 1, (2,): 1}


def test_recovery_after_the_rename(spark, schema, monkeypatch):
    table = f"{schema}.numbers"
    numbers(spark, 1).write.saveAsTable(table)
    with monkeypatch.context() as m:
        m.setattr(tables, "point_view", failing)
        with pytest.raises(RuntimeError):
            tables.publish(numbers(spark, 2), table)
    assert not spark.catalog.tableExists(table)
    assert tables.recover(spark, table) and not tables.recover(spark, table)
    assert rows(spark.table(table)) == {(1,): 1}


def test_kinds_are_not_mixed(spark, schema, target):  # noqa: F811
    table, other = f"{schema}.machines", f"{schema}.numbers"
    dimension.create_dimension(target, table, DIM)
    before = rows(spark.table(table))
    for write in (tables.publish, tables.append_rows):
        with pytest.raises(ValueError, match="is a dimension table"):
            write(target, table)
    tables.publish(numbers(spark, 1), other)
    with pytest.raises(ValueError, match="is a published table"):
        dimension.commit_dimension(spark, other, target, DIM, DAY)
    with pytest.raises(ValueError, match="exists"):
        dimension.create_dimension(target, other, DIM)
    assert rows(spark.table(table)) == before and rows(spark.table(other)) == {(1,): 1}


def test_tables_of_others_are_left_alone(spark, schema, target):  # noqa: F811
    mine = f"{schema}.mine"
    for suffix in ("__v1", "__rows", "__audit", "__lookup", "__v2x"):
        numbers(spark, 9).write.saveAsTable(mine + suffix)
    with pytest.raises(ValueError, match="mine__v1 is in the way"):
        tables.publish(numbers(spark, 1), mine)
    with pytest.raises(ValueError, match="mine__rows is in the way"):
        dimension.create_dimension(target, mine, DIM)
    tables.drop_table(spark, mine)
    for suffix in ("__v1", "__rows", "__audit", "__lookup", "__v2x"):
        assert rows(spark.table(mine + suffix)) == {(9,): 1}
    spark.sql(f"drop table {mine}__v1")
    with pytest.raises(ValueError, match="mine__audit is in the way"):
        tables.publish(numbers(spark, 1), mine)


def test_appends_are_versions_of_their_own(spark, schema):
    table = f"{schema}.numbers"
    tables.publish(numbers(spark, 1), table)
    first = spark.table(table)
    assert tables.append_rows(numbers(spark, 2, 3), table) == 2
    second = spark.table(table)
    assert tables.append_rows(numbers(spark, 4), table) == 3
    assert (first.count(), second.count(), spark.table(table).count()) == (1, 3, 4)
    found = [(r["version"], r["operation"], r["metrics"]) for r in tables.history(spark, table).collect()]
    assert found == [(3, "APPEND", {"rows": "1"}), (2, "APPEND", {"rows": "2"}), (1, "PUBLISH", {})]
    tables.publish(numbers(spark, 5), table)
    assert second.count() == 3, "the version before and its parts stay"
    tables.publish(numbers(spark, 6), table)
    left = {r["tableName"] for r in spark.sql(f"show tables in {schema}").collect()}
    assert left == {"numbers", "numbers__audit", "numbers__v4", "numbers__v5"}


def test_commits_drop_old_current_versions(spark, schema, target):  # noqa: F811
    table = f"{schema}.machines"
    dimension.create_dimension(target, table, DIM)
    for n in range(3):
        batch = spark.createDataFrame([(70, "lathe", f"h{n}")], BATCH)
        dimension.commit_dimension(spark, table, batch, DIM, DAY + dt.timedelta(days=n))
    parts = [r["partition"] for r in spark.sql(f"show partitions {table}__rows").collect()]
    assert sorted(p for p in parts if "true" in p) == ["live=true/__commit=2", "live=true/__commit=3"]


def test_publish_adopts_a_plain_table(spark, schema):
    table = f"{schema}.numbers"
    numbers(spark, 1).write.saveAsTable(table)
    tables.publish(spark.table(table).union(numbers(spark, 2)), table)
    assert rows(spark.table(table)) == {(1,): 1, (2,): 1}
    spark.sql(f"create view {schema}.other as select 1 as v")
    with pytest.raises(ValueError, match="not made by publish"):
        tables.publish(numbers(spark, 1), f"{schema}.other")


def test_append_by_name(spark, schema):
    pair = spark.createDataFrame([(1, "x")], "a int, b string")
    plain, published = f"{schema}.plain", f"{schema}.published"
    pair.write.saveAsTable(plain)
    tables.publish(pair, published)
    for table in (plain, published):
        tables.append_rows(spark.createDataFrame([("y", 2)], "b string, a int"), table)
        assert rows(spark.table(table)) == {(1, "x"): 1, (2, "y"): 1}


def test_drop_table(spark, schema):
    tables.publish(numbers(spark, 1), f"{schema}.gone")
    tables.publish(numbers(spark, 1), f"{schema}.gone_not")
    numbers(spark, 1).write.saveAsTable(f"{schema}.plain")
    for name in ("gone", "plain", "never_there"):
        tables.drop_table(spark, f"{schema}.{name}")
    left = {r["tableName"] for r in spark.sql(f"show tables in {schema}").collect()}
    assert left == {"gone_not", "gone_not__v1", "gone_not__audit"}


def test_prepare_schema_twice(spark, schema):
    tables.prepare_schema(spark, schema, catalog="spark_catalog")
    assert spark.catalog.databaseExists(schema)


def test_freeze_is_fixed(spark, schema):
    table = f"{schema}.numbers"
    numbers(spark, 1).write.saveAsTable(table)
    frozen, lazy = scratch.freeze(spark.table(table)), spark.table(table)
    numbers(spark, 2).write.mode("append").saveAsTable(table)
    assert (frozen.count(), lazy.count()) == (1, 2)


def test_shared_folder_follows_the_session(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    folder = scratch.new_folder(spark, "x")
    assert folder != scratch.new_folder(spark, "x")
    if named:
        assert folder.startswith(named)


def stub_session(named, current, master):
    """Only what shared_folder asks of a session."""
    state = SimpleNamespace(folder=current)
    context = SimpleNamespace(
        master=master,
        getCheckpointDir=lambda: state.folder,
        setCheckpointDir=lambda folder: setattr(state, "folder", folder),
    )
    conf = SimpleNamespace(get=lambda name, default: named)
    return SimpleNamespace(conf=conf, sparkContext=context)


def test_shared_folder_on_a_cluster_is_never_local():
    assert scratch.shared_folder(stub_session("hdfs:/x", None, "yarn")) == "hdfs:/x"
    assert scratch.shared_folder(stub_session(None, "hdfs:/y", "yarn")) == "hdfs:/y"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch.shared_folder(stub_session(None, None, "yarn"))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch.shared_folder(stub_session(None, None, "local-cluster[2,1,1024]"))
    for master in ("local", "local[2]", "local[*,4]"):
        local = stub_session(None, None, master)
        assert scratch.shared_folder(local) == scratch.shared_folder(local)


def test_a_run_leaves_nothing(spark, monkeypatch):
    monkeypatch.setattr(scratch, "_RUNS", {})
    schema = scratch.new_schema(spark, "t")
    tables.publish(numbers(spark, 1), f"{schema}.numbers")
    frozen = scratch.freeze(numbers(spark, 1, 2))
    folder = scratch._run_of(spark)["folder"].removeprefix("file:")
    assert frozen.count() == 2 and Path(folder).exists()
    scratch.end_run(spark)
    assert not Path(folder).exists() and not spark.catalog.databaseExists(schema)
    scratch.end_run(spark)


def test_dimension_commits(spark, schema, target):  # noqa: F811
    table = f"{schema}.dim_machine"
    dimension.create_dimension(target, table, DIM)
    assert rows(spark.table(table)) == rows(target)
    state = target
    batches = [
        ([(70, "lathe", "annex"), (48, "drill", "north"), (83, "crane", "dock")], DAY),
        ([(70, "lathe", "dock"), (21, "press", "dock")], DAY),
        ([(70, "lathe", "pit"), (83, "crane", "pit")], d("2024-07-01")),
    ]
    for batch, day in batches:
        batch = spark.createDataFrame(batch, BATCH)
        state = spark.createDataFrame(scd2.scd2_apply(state, batch, DIM, day).collect(), TARGET)
        dimension.commit_dimension(spark, table, batch, DIM, day)
        assert rows(spark.table(table)) == rows(state)
        assert spark.table(table).columns == target.columns
    assert scd2.scd2_check(spark.table(table), DIM).isEmpty()
    history = tables.history(spark, table).collect()
    assert [r["version"] for r in history] == [3, 2, 1, 0]
    assert history[0]["metrics"]["expired"] == "2"
    assert history[1]["metrics"]["amended"] == "1"
    assert history[2]["metrics"]["inserted_new"] == "1"


@pytest.mark.parametrize("reopen", [False, True])
def test_metrics_are_what_a_commit_does(spark, schema, target, reopen):  # noqa: F811
    table = f"{schema}.machines"
    dimension.create_dimension(target, table, DIM)
    for n, batch in enumerate(
        [
            [(70, "lathe", "annex"), (48, "drill", "north"), (21, "press", "dock"), (83, "crane", "dock")],
            [(70, "lathe", "pit"), (83, "crane", "dock"), (84, "crane", "dock")],
        ]
    ):
        frame = spark.createDataFrame(batch, BATCH)
        options = {"as_of": DAY, "reopen_closed": reopen}
        kinds = scd2.scd2_classify(spark.table(table), frame, DIM, **options)
        told = scd2.scd2_metrics(kinds).first().asDict()
        seen = dimension.commit_dimension(spark, table, frame, DIM, **options)
        assert {k: told[k] for k in seen} == seen, n
        assert scd2.scd2_check(spark.table(table), DIM).isEmpty()


def test_current_rows_are_read_without_history(spark, schema, target):  # noqa: F811
    table = f"{schema}.dim_machine"
    dimension.create_dimension(target, table, DIM)
    batch = spark.createDataFrame([(70, "lathe", "annex")], BATCH)
    dimension.commit_dimension(spark, table, batch, DIM, DAY, rebalance=True)
    current = spark.table(table).where("live")
    assert all("live=true/__commit=1" in f for f in current.inputFiles())
    assert current.count() == 3


def test_leftovers_of_a_failed_commit_are_dropped(spark, schema, target):  # noqa: F811
    table = f"{schema}.dim_machine"
    dimension.create_dimension(target, table, DIM)
    stray = spark.createDataFrame(
        [("X", "Y", 99, EVE, OPEN, True, 1), ("X", "Y", 99, EVE, EVE, False, 1)],
        "model string, hall string, code int, since date, until date, live boolean, c int",
    )
    columns = [c for c in spark.table(f"{table}__rows").columns if c != dimension.COMMIT]
    stray.select(*columns, "c").write.mode("append").insertInto(f"{table}__rows")
    assert rows(spark.table(table)) == rows(target), "not visible before the view changes"
    batch = spark.createDataFrame([(48, "drill", "north")], BATCH)
    dimension.commit_dimension(spark, table, batch, DIM, DAY)
    assert rows(spark.table(table)) == rows(target)


def test_forgetting_old_snapshots(spark, schema, target):  # noqa: F811
    table = f"{schema}.dim_machine"
    dimension.create_dimension(target, table, DIM)
    for n in range(3):
        batch = spark.createDataFrame([(70, "lathe", f"c{n}")], BATCH)
        dimension.commit_dimension(spark, table, batch, DIM, DAY + dt.timedelta(days=n))
    expected = rows(spark.table(table))
    dimension.forget_old_snapshots(spark, table, DIM)
    assert rows(spark.table(table)) == expected
    left = {r["partition"] for r in spark.sql(f"show partitions {table}__rows").collect()}
    assert {p for p in left if "true" in p} == {
        "live=true/__commit=2",
        "live=true/__commit=3",
    }
    assert len([p for p in left if "false" in p]) == 4


def test_many_appends_are_merged(spark, schema):
    table = f"{schema}.numbers"
    tables.publish(numbers(spark, 0, 0), table)
    data = lambda: {r["tableName"] for r in spark.sql(f"show tables in {schema}").collect() if "__v" in r["tableName"]}
    before = None
    for n in range(1, 21):
        version = tables.append_rows(numbers(spark, n), table)
        assert version == n + 1
        assert rows(spark.table(table)) == {(0,): 2} | {(v,): 1 for v in range(1, n + 1)}
        if before is not None:
            # whoever began before the append still reads what there was
            assert before.count() == n + 1
        before = spark.table(table)
    query = spark.sql(f"show create table {table}").first()[0]
    assert query.count("UNION ALL") == 2  # 20 appends: 16 and 4, besides what was published
    assert "numbers__v1" in data() and "numbers__v17_16" in data() and len(data()) <= 6
    listed = tables.history(spark, table).collect()
    assert [r["version"] for r in listed] == list(range(21, 0, -1))
    assert {r["metrics"].get("rows") for r in listed if r["operation"] == "APPEND"} == {"1"}
    tables.publish(numbers(spark, 5), table)
    tables.publish(numbers(spark, 6), table)
    assert data() == {"numbers__v22", "numbers__v23"}


def test_merging_that_is_cut_off(spark, schema, monkeypatch):
    table = f"{schema}.numbers"
    tables.publish(numbers(spark, 0), table)
    tables.append_rows(numbers(spark, 1), table)
    with monkeypatch.context() as m:
        m.setattr(tables, "point_view", failing)
        with pytest.raises(RuntimeError):
            tables.append_rows(numbers(spark, 2), table)
    assert rows(spark.table(table)) == {(0,): 1, (1,): 1}
    tables.append_rows(numbers(spark, 3), table)
    tables.append_rows(numbers(spark, 4), table)
    assert rows(spark.table(table)) == {(v,): 1 for v in (0, 1, 3, 4)}


def test_views_without_a_list_of_parts(spark, schema):
    found = {tables.VERSION_PROPERTY: "4", tables.BASE_PROPERTY: "2"}
    assert tables._parts(found) == ["v2", "v3", "v4"]
    assert tables._parts(found | {tables.PARTS_PROPERTY: "v2,v4_2"}) == ["v2", "v4_2"]
