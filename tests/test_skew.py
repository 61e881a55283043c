import pytest

from chronofold.operators import skew, topn
from helpers import final_plan, plan, rows


@pytest.fixture
def big(spark):
    """Nine tenths of the rows on key 0, most of them identical; some keys null or unknown."""
    return spark.range(4000).selectExpr(
        "case when id % 10 < 9 then 0 when id % 100 = 9 then null else id % 50 end as k",
        "id % 3 as v",
    ).repartition(8)


@pytest.fixture
def other(spark):
    data = [(0, "zero"), (0, "nil"), (19, "a"), (29, "b"), (7, "c")]
    return spark.createDataFrame(data, "k bigint, s string")


@pytest.mark.parametrize("how", ["inner", "left"])
def test_all_ways_agree(spark, big, other, how):
    plain = rows(big.join(other, ["k"], how))
    assert rows(skew.salted_join(big, other, ["k"], how, rows_per_salt=100)) == plain
    assert rows(skew.broadcast_join(big, other, ["k"], how)) == plain
    assert rows(skew.broadcast_join(big, other, ["k"], how, broadcast_bytes=0)) == plain
    assert rows(skew.adaptive_join(big, other, ["k"], how)) == plain


def test_column_order_is_that_of_a_plain_join(big, other):
    assert skew.salted_join(big, other, ["k"], rows_per_salt=100).columns == ["k", "v", "s"]


def test_salts_follow_the_row_count(spark, big, other):
    parts = skew.hot_keys(big, other, ["k"], rows_per_salt=1000).collect()
    assert [(r[skew.BIG_PARTS], r[skew.OTHER_PARTS]) for r in parts] == [(4, 1)]
    assert skew.hot_keys(big, other, ["k"], rows_per_salt=10**6).isEmpty()


def test_both_sides_are_counted_together(spark):
    left = spark.createDataFrame([(1,)] * 25 + [(2,)] * 3 + [(3,)] * 10, "k int")
    right = spark.createDataFrame([(1,)] * 2 + [(2,)] * 21 + [(4,)] * 11, "k int")
    parts = skew.hot_keys(left, right, ["k"], rows_per_salt=10).collect()
    assert sorted((r[skew.BIG_PARTS], r[skew.OTHER_PARTS]) for r in parts) == [(1, 2), (1, 3), (3, 1)]


def test_rows_are_repeated_only_against_hot_keys(spark, big, other):
    def generated(rows_per_salt, left=big, right=other):
        joined = skew.salted_join(left, right, ["k"], "left", rows_per_salt)
        # once it has run, the plan is shown twice
        found = plan(joined).count("Generate explode")
        assert rows(joined) == rows(left.join(right, ["k"], "left"))
        return found

    assert generated(10**6) == 0
    assert generated(100) == 2
    assert generated(1) > 2
    empty = spark.createDataFrame([], other.schema)
    assert generated(100, right=empty) == 2 and generated(100, left=big.limit(0)) == 0


def test_a_key_over_the_limit_is_hot_however_large_the_table(spark):
    even = spark.range(100_000).selectExpr("id % 50000 as k")
    one = spark.createDataFrame([(0,)], "k bigint")
    assert skew.hot_keys(even, one, ["k"], rows_per_salt=1).count() == 50_000


def test_identical_rows_spread_over_salts(spark, other):
    same = spark.range(8000, numPartitions=8).selectExpr("0L as k", "1 as v")
    dealt = same.selectExpr(skew.stable_salt(same.schema, "16") + " as salt")
    assert dealt.distinct().count() > 3


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("rows_per_salt", [1, 7, 50, 10**6])
def test_keys_hot_on_both_sides(spark, how, rows_per_salt):
    left = spark.range(400).selectExpr("case when id < 200 then 1 when id < 300 then null else id % 20 end as k", "id as v")
    right = spark.range(150).selectExpr("case when id < 90 then 1L when id < 110 then null else id % 9 end as k", "id as w")
    plain = rows(left.join(right, ["k"], how))
    assert rows(skew.salted_join(left, right, ["k"], how, rows_per_salt)) == plain


def test_a_row_is_repeated_without_long_arrays(spark, monkeypatch):
    monkeypatch.setattr(skew, "STRIDE", 4)
    df = spark.createDataFrame([(n,) for n in (1, 3, 4, 5, 19)], "n bigint")
    got = rows(skew._repeated(df, "n", "part"))
    assert got == {(n, i): 1 for n in (1, 3, 4, 5, 19) for i in range(n)}


@pytest.mark.parametrize("how", ["inner", "left"])
def test_keys_of_different_types(spark, how):
    left = spark.createDataFrame([(1,), (1,), (1,), (2,), (None,)], "k int")
    right = spark.createDataFrame([(1, "a"), (2**40, "b"), (2, "c")], "k bigint, s string")
    assert rows(skew.salted_join(left, right, ["k"], how, 1)) == rows(left.join(right, ["k"], how))


@pytest.mark.parametrize("how", ["inner", "left"])
def test_fields_of_structs_behind_the_join(spark, how):
    left = spark.range(300).selectExpr("id % 3 as k", "named_struct('p', id, 'q', id + 1, 'r', 'x') as v")
    right = spark.createDataFrame([(0, ("a", "b", 1)), (1, (None, "d", 2))], "k bigint, s struct<x:string,y:string,z:int>")
    read = ["k", "v.p", "v.q", "s.x", "coalesce(s.y, 'none') as y"]
    got = skew.salted_join(left, right, ["k"], how, 10).selectExpr(*read)
    assert rows(got) == rows(left.join(right, ["k"], how).selectExpr(*read))


MIXED = {
    "string/int": ("string", ["01"] * 50 + ["2", "002", None], "int", [1, 2, 3, None]),
    "int/string": ("int", [1] * 50 + [2, None], "string", ["01", "2", " 1", "0002"]),
    "decimal/double": ("decimal(9,2)", ["1.50"] * 30 + ["2.00"], "double", [1.5, 2.0, 1.25]),
    "decimal/decimal": ("decimal(9,2)", ["1.50"] * 30 + ["2.00"], "decimal(20,6)", ["1.5", "2.000000", "1.500001"]),
    "string/date": ("string", ["2024-01-02"] * 30 + ["2024-1-2"], "date", ["2024-01-02", "2024-01-03"]),
    "bigint/double": ("bigint", [2**53] * 30 + [2**53 + 1], "double", [float(2**53)]),
}


@pytest.mark.parametrize("rows_per_salt", [1, 10, skew.ROWS_PER_SALT])
@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("case", MIXED)
def test_mixed_types_match_as_in_a_plain_join(spark, case, how, rows_per_salt):
    kind, values, other_kind, others = MIXED[case]

    def frame(values, kind, name):
        written = spark.createDataFrame([(None if v is None else str(v), i) for i, v in enumerate(values)], f"k string, {name} int")
        return written.withColumn("k", written.k.cast(kind))

    left, right = frame(values, kind, "v"), frame(others, other_kind, "w")
    plain = left.join(right, ["k"], how)
    got = skew.salted_join(left, right, ["k"], how, rows_per_salt)
    assert got.columns == plain.columns and got.schema["k"].dataType == left.schema["k"].dataType
    assert rows(got) == rows(plain)
    assert rows(skew.broadcast_join(left, right, ["k"], how, broadcast_bytes=0)) == rows(plain)


def test_types_that_are_compared(spark):
    left = spark.createDataFrame([("01", 1)], "k string, v int")
    right = spark.createDataFrame([(1, 7)], "k int, w int")
    assert skew.compared_types(left, right, ["k"]) != [None]
    assert skew.compared_types(left, left, ["k"]) == [None]


ANY_TYPE = (
    "id, id % 3 as g, map('a', id) as m, parse_json(concat('{\"x\":', id % 2, '}')) as v, "
    "array(map(1, id)) as am, named_struct('n', cast(null as int), 'm', map('b', 1)) as s, "
    "if(id % 5 = 0, null, array(id)) as a"
)


def shown(df):
    """Rows as text: maps and variants can't be counted as they are."""
    return sorted(str(r) for r in df.selectExpr("to_json(struct(*)) as j").collect())


def test_the_size_switches_keep_working_with_any_type(spark):
    df = spark.sql(f"select {ANY_TYPE} from range(200)")
    names = spark.sql("select id as g, map('n', id) as note from range(2)")
    for how in ("inner", "left"):
        small, large = (skew.broadcast_join(df, names, ["g"], how, b) for b in (1 << 30, 0))
        assert shown(small) == shown(large) == shown(skew.salted_join(df, names, ["g"], how, 10))
    for dense in (False, True):
        best = [topn.top_ranked(df, 2, ["g"], {"a": "desc"}, dense, "r", b) for b in (1 << 30, 0)]
        assert shown(best[0]) == shown(best[1])
    assert topn.top_rows(df, 2000, ["g"], {"id": "asc"}).count() == 200


def test_composite_and_null_keys(spark):
    data = [(1, "a")] * 30 + [(None, "b")] * 30 + [(2, None)]
    left = spark.createDataFrame(data, "p int, q string")
    right = spark.createDataFrame([(1, "a", 9), (None, "b", 8)], "p int, q string, r int")
    for how in ("inner", "left"):
        salted = skew.salted_join(left, right, ["p", "q"], how, rows_per_salt=5)
        assert rows(salted) == rows(left.join(right, ["p", "q"], how))


def test_struct_keys_join_on_null_fields(spark):
    left = spark.sql("select struct(if(id % 2 = 0, null, 1) as a, 'x' as b) as k, id from range(40)")
    right = spark.sql("select struct(cast(null as int) as a, 'x' as b) as k, 'hit' as r")
    joined = skew.salted_join(left, right, ["k"], rows_per_salt=5)
    assert joined.count() == 20 == left.join(right, ["k"]).count()


def test_only_a_measured_side_is_broadcast(spark, big, other, small_conf):
    small_conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    assert "BroadcastHashJoin" in plan(skew.broadcast_join(big, other, ["k"]))
    salted = plan(skew.broadcast_join(big, other, ["k"], broadcast_bytes=0))
    assert "SortMergeJoin" in salted


def test_adaptive_join_splits_the_hot_partition(spark, small_conf):
    small_conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    small_conf("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    small_conf("spark.sql.adaptive.advisoryPartitionSizeInBytes", "20k")
    small_conf("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "20k")
    small_conf("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "2")
    hot = spark.range(200000).selectExpr("if(id % 10 < 8, 0, id % 100) as k", "uuid() as v")
    hot = hot.repartition(16)
    names = spark.range(100).selectExpr("id as k", "concat('n', id) as s")
    assert "skew=true" in final_plan(skew.adaptive_join(hot, names, ["k"]))


def test_unsupported_join_types(big, other):
    for join in (skew.salted_join, skew.broadcast_join):
        with pytest.raises(ValueError):
            join(big, other, ["k"], "full")
