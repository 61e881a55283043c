import pytest
from pyspark.sql import functions as F

from chronofold.operators import topn
from chronofold.operators.aggregate import Measure, salted_aggregate, salted_partials
from chronofold.plans import queries
from helpers import final_plan, plan, rows

ALL = {
    "n": Measure("count"),
    "known": Measure("count", "v"),
    "total": Measure("sum", "v"),
    "low": Measure("min", "v"),
    "high": Measure("max", "s"),
    "mean": Measure("avg", "v"),
    "texts": Measure("distinct", "s"),
    "values": Measure("distinct", "v"),
}


@pytest.fixture
def hot(spark):
    """Four fifths of the rows on key 0, many of them equal; some keys and values null."""
    return spark.range(5000, numPartitions=5).selectExpr(
        "if(id % 10 < 8, 0, if(id % 50 = 9, null, id % 13)) as k", "if(id % 7 = 0, null, id % 3) as v", "cast(id % 101 as string) as s"
    )


@pytest.mark.parametrize("parts", [None, 1, 40])
def test_exact_measures(hot, parts):
    plain = hot.groupBy("k").agg(
        F.count("*"), F.count("v"), F.sum("v"), F.min("v"), F.max("s"), F.avg("v"), F.count_distinct("s"), F.count_distinct("v")
    )
    got = salted_aggregate(hot, ["k"], ALL, parts)
    assert got.columns == ["k", *ALL]
    assert rows(got) == rows(plain)


def test_a_hot_key_is_aggregated_in_parts(spark, hot):
    partials = salted_partials(hot, ["k"], {"n": Measure("count")}, 40)
    own = partials.where("k = 0")
    assert own.count() == 40 and own.agg(F.max("n")).first()[0] < 250
    assert partials.agg(F.sum("n")).first()[0] == 5000
    assert "hashpartitioning(k" in plan(partials) and "__salt" in plan(partials).split("hashpartitioning(")[1].split(")")[0]


def test_values_of_a_hot_key_are_distinct_in_many_tasks(spark, small_conf):
    small_conf("spark.sql.adaptive.coalescePartitions.enabled", "false")
    df = spark.range(40_000).selectExpr("0 as k", "id % 20000 as v")
    assert salted_aggregate(df, ["k"], {"v": Measure("distinct", "v")}).first()["v"] == 20_000
    dealt = df.distinct().groupBy(F.spark_partition_id()).count()
    assert dealt.agg(F.max("count")).first()[0] < 4000


@pytest.mark.parametrize("parts", [1, 64])
def test_sketches(spark, parts):
    df = spark.range(60_000, numPartitions=6).selectExpr("if(id % 5 < 4, 'hot', cast(id % 3 as string)) as k", "id % 30011 as v")
    measures = {"about": Measure("approx_distinct", "v", size=14), "exact": Measure("distinct", "v")}
    measures |= {f"q{q}": Measure("quantile", "v", q / 100, size=800) for q in (0, 10, 50, 99, 100)}
    for r in salted_aggregate(df, ["k"], measures, parts).collect():
        assert abs(r["about"] - r["exact"]) < 0.04 * r["exact"]
        values = sorted(x.v for x in df.where(F.col("k") == r["k"]).select("v").collect())
        for q in (0, 10, 50, 99, 100):
            below = sum(v < r[f"q{q}"] for v in values) / len(values)
            assert abs(below - q / 100) < 0.02


def test_no_measures_no_rows_and_wrong_kinds(spark, hot):
    assert rows(salted_aggregate(hot, ["k"], {})) == rows(hot.select("k").distinct())
    assert salted_aggregate(hot.limit(0), ["k"], ALL).count() == 0
    with pytest.raises(ValueError, match="no measure"):
        salted_aggregate(hot, ["k"], {"x": Measure("mode", "v")})
    with pytest.raises(ValueError, match="names that are needed"):
        salted_aggregate(hot.withColumnRenamed("v", "__salt"), ["k"], {})


def test_partitions_are_pruned_by_another_table(spark):
    df = queries.topn_dynamic_pruned(spark, "/root/testdata/sf0.01")
    assert "dynamicpruning" in final_plan(df)


def test_top_rows_of_many_wanted_groups(spark):
    df = spark.range(200).selectExpr("id % 20 as g", "id as v")
    wanted = spark.createDataFrame([(3,), (4,), (3,), (99,), (None,)], "g bigint")
    few = topn.top_rows_of(df, wanted, 2, ["g"], {"v": "desc"})
    assert rows(few) == {(3, 183): 1, (3, 163): 1, (4, 184): 1, (4, 164): 1}
    assert rows(topn.top_rows_of(df, wanted, 2, ["g"], {"v": "desc"}, broadcast_bytes=0)) == rows(few)
