import pytest

from chronofold.operators import merge, skew
from chronofold.operators.merge import DuplicateKeys, merge_update, merge_upsert, scd1_apply
from helpers import final_plan, plan, rows

SCHEMA = "id int, v string, n bigint"


@pytest.fixture(params=["broadcast", "shuffle"])
def size(request):
    return {} if request.param == "broadcast" else {"broadcast_bytes": 0}


@pytest.fixture
def target(spark):
    return spark.createDataFrame(
        [(1, "a", 1), (2, "b", 2), (2, "bb", 3), (None, "x", 4), (3, None, 5)], SCHEMA
    )


@pytest.fixture
def batch(spark):
    return spark.createDataFrame([(2, "B"), (3, "C"), (9, "N"), (None, "X")], "id int, v string")


def test_update_ignores_unmatched_rows(target, batch, size):
    result = merge_update(target, batch, ["id"], set={"v": "s.v"}, when="t.n > 2", **size)
    assert rows(result) == {
        (1, "a", 1): 1,
        (2, "b", 2): 1,
        (2, "B", 3): 1,
        (None, "x", 4): 1,
        (3, "C", 5): 1,
    }


def test_condition_that_is_null_does_not_match(target, batch, size):
    result = merge_update(target, batch, ["id"], set={"n": "0"}, when="t.v <> s.v", **size)
    assert (3, None, 5) in rows(result) and (2, "b", 0) in rows(result)


def test_upsert_takes_one_branch_per_row(target, batch, size):
    given = {"id": "s.id", "v": "s.v"}
    result = merge_upsert(
        target, batch, ["id"], set={"v": "concat(t.v, s.v)"}, values=given, **size
    )
    assert rows(result) == {
        (1, "a", 1): 1,
        (2, "bB", 2): 1,
        (2, "bbB", 3): 1,
        (None, "x", 4): 1,
        (3, None, 5): 1,
        (9, "N", None): 1,
        (None, "X", None): 1,
    }


def test_scd1(spark, size):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    batch = spark.createDataFrame([(2, None), (3, "c")], "id int, v string")
    result = scd1_apply(target, batch, ["id"], **size)
    assert rows(result) == {(1, "a"): 1, (2, None): 1, (3, "c"): 1}


def test_duplicate_batch_keys(spark, target, size):
    batch = spark.createDataFrame([(1, "x", 1), (1, "y", 2)], "id int, v string, seq int")
    with pytest.raises(DuplicateKeys):
        merge_update(target, batch, ["id"], set={"v": "s.v"}, **size)
    latest = merge_update(target, batch, ["id"], set={"v": "s.v"}, order={"seq": "desc"}, **size)
    assert (1, "y", 1) in rows(latest)


@pytest.mark.parametrize("order", [None, {"seq": "desc"}])
def test_rows_with_a_null_key_are_no_duplicates(spark, target, size, order):
    batch = spark.createDataFrame([(None, "x", 1), (None, "y", 2)], "id int, v string, seq int")
    values = {"id": "s.id", "v": "s.v"}
    result = merge_upsert(target, batch, ["id"], {"v": "s.v"}, values, order=order, **size)
    assert rows(result) - rows(target) == {(None, "x", None): 1, (None, "y", None): 1}


def test_unknown_columns(target, batch):
    with pytest.raises(ValueError, match="set names"):
        merge_update(target, batch, ["id"], set={"w": "s.v"})
    with pytest.raises(ValueError, match="values name"):
        merge_upsert(target, batch, ["id"], set={"v": "s.v"}, values={"w": "s.v"})


def test_hot_target_key_is_split_by_the_shuffle_plan(spark, small_conf):
    small_conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    small_conf("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    small_conf("spark.sql.adaptive.advisoryPartitionSizeInBytes", "20k")
    small_conf("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "20k")
    small_conf("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "2")
    hot = spark.range(200000).selectExpr("if(id % 10 < 8, 0, id % 100) as id", "uuid() as v")
    batch = spark.range(100).selectExpr("id", "'new' as v")
    result = merge_update(
        hot.repartition(16), batch, ["id"], set={"v": "s.v"}, broadcast_bytes=0
    )
    assert "skew=true" in final_plan(result)
    assert result.where("v = 'new'").count() == 200000


def test_small_batch_leaves_the_target_unshuffled(target, batch):
    small = plan(merge_update(target, batch, ["id"], set={"v": "s.v"}))
    assert "BroadcastHashJoin" in small and "hashpartitioning" not in small


@pytest.mark.parametrize("rows_per_salt", [1, 10, skew.ROWS_PER_SALT])
@pytest.mark.parametrize("broadcast_bytes", [0, 2**26])
def test_keys_of_mixed_types(spark, broadcast_bytes, rows_per_salt):
    target = spark.createDataFrame([("01", "a")] * 40 + [("2", "b"), ("004", "c"), (None, "d")], "k string, v string")
    batch = spark.createDataFrame([(1, "x"), (4, "y"), (5, "z")], "k int, v string")
    options = {"broadcast_bytes": broadcast_bytes, "rows_per_salt": rows_per_salt}
    got = merge.merge_upsert(target, batch, ["k"], {"v": "s.v"}, {"k": "s.k", "v": "s.v"}, **options)
    assert rows(got) == {("01", "x"): 40, ("2", "b"): 1, ("004", "y"): 1, (None, "d"): 1, ("5", "z"): 1}
    got = merge.merge_update(target, batch, ["k"], {"v": "s.v"}, **options)
    assert rows(got) == {("01", "x"): 40, ("2", "b"): 1, ("004", "y"): 1, (None, "d"): 1}


@pytest.mark.parametrize("broadcast_bytes", [0, 2**26])
def test_spellings_of_one_key_are_one_key(spark, broadcast_bytes):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    batch = spark.createDataFrame([("1", "x", 1), ("01", "y", 2), ("2", "z", 1)], "k string, v string, n int")
    with pytest.raises(merge.DuplicateKeys):
        merge.merge_update(target, batch, ["k"], {"v": "s.v"}, broadcast_bytes=broadcast_bytes)
    got = merge.merge_update(target, batch, ["k"], {"v": "s.v"}, order={"n": "desc"}, broadcast_bytes=broadcast_bytes)
    assert rows(got) == {(1, "y"): 1, (2, "z"): 1}
