"""Deduplication and top N per group."""

import random

import pytest

from chronofold.operators.dedup import drop_exact_copies, first_copies, keep_latest
from chronofold.operators.topn import top_ranked, top_rows
from helpers import plan, rows


def test_keep_latest_breaks_ties_the_same_way(spark):
    data = [(1, 5, "b"), (1, 5, "a"), (1, 4, "z"), (2, None, "n"), (None, 1, "k"), (None, 2, "l")]
    expected = {(1, 5, "a"): 1, (2, None, "n"): 1, (None, 2, "l"): 1}
    for seed in range(3):
        random.Random(seed).shuffle(data)
        df = spark.createDataFrame(data, "k int, t int, s string").repartition(4)
        assert rows(keep_latest(df, ["k"], {"t": "desc", "s": "asc"})) == expected


def test_keep_latest_settles_ties_by_the_other_columns(spark):
    data = [(1, 5, "b", {"x": 2}), (1, 5, "b", {"x": 1}), (1, 5, "c", None), (2, 1, None, {})]
    found = []
    for seed in range(3):
        random.Random(seed).shuffle(data)
        df = spark.createDataFrame(data, "k int, t int, s string, m map<string,int>").repartition(3)
        kept = keep_latest(df, ["k"], {"t": "desc"})
        assert kept.columns == ["k", "t", "s", "m"]
        found.append(sorted(map(str, kept.collect())))
    assert found[0] == found[1] == found[2] and "m={'x': 1}" in found[0][0]


def test_keep_latest_of_its_own_result(spark):
    df = spark.createDataFrame([(1, 1), (1, 2), (2, 1)], "k int, t int")
    once = keep_latest(df, ["k"], {"t": "desc"})
    assert rows(keep_latest(once, ["k"], {"t": "desc"})) == rows(once)


def test_first_copies(spark):
    data = [(3, "x"), (1, "x"), (2, "y"), (5, None), (4, None), (6, "x "), (7, "")]
    df = spark.createDataFrame(data, "id int, text string")
    assert rows(first_copies(df, ["text"], "id")) == {
        (1, 2): 1,
        (2, 1): 1,
        (4, 2): 1,
        (6, 1): 1,
        (7, 1): 1,
    }


def test_first_copies_over_several_columns(spark):
    data = [(1, "a", "bc"), (2, "ab", "c"), (3, "a", "bc")]
    df = spark.createDataFrame(data, "id int, p string, q string")
    assert rows(first_copies(df, ["p", "q"], "id")) == {(1, 2): 1, (2, 1): 1}


def test_first_copies_shuffles_digests_not_text(spark):
    df = spark.createDataFrame([(1, "a")], "id int, text string")
    text = plan(first_copies(df, ["text"], "id"))
    assert "partial_min" in text and "sha2" in text


def test_drop_exact_copies(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b")], "id int, v string")
    assert rows(drop_exact_copies(df)) == {(1, "a"): 1, (1, "b"): 1}
    assert drop_exact_copies(df, ["id"]).count() == 1


DATA = [
    ("g", 10, 1),
    ("g", 10, 2),
    ("g", 9, 3),
    ("g", 8, 4),
    ("g", 8, 5),
    ("g", 7, 6),
    ("h", None, 7),
    ("h", None, 8),
    ("h", 1, 9),
    (None, 3, 10),
    (None, 3, 11),
]
SCHEMA = "grp string, v int, id int"


def ranks(df):
    return {r["id"]: r["rank"] for r in df.collect()}


@pytest.mark.parametrize("limit", [64 << 20, 0])
def test_rank_and_dense_rank(spark, limit):
    df = spark.createDataFrame(DATA, SCHEMA)
    order = {"v": "desc"}
    assert ranks(top_ranked(df, 3, ["grp"], order, broadcast_bytes=limit)) == {
        1: 1,
        2: 1,
        3: 3,
        9: 1,
        7: 2,
        8: 2,
        10: 1,
        11: 1,
    }
    assert ranks(top_ranked(df, 3, ["grp"], order, dense=True, broadcast_bytes=limit)) == {
        1: 1,
        2: 1,
        3: 2,
        4: 3,
        5: 3,
        9: 1,
        7: 2,
        8: 2,
        10: 1,
        11: 1,
    }


@pytest.mark.parametrize("dense", [False, True])
@pytest.mark.parametrize("seed", range(3))
def test_ranks_match_the_window(spark, seed, dense):
    rng = random.Random(seed)
    data = [
        (rng.choice("abc"), rng.choice([None, *range(6)]), rng.choice([None, 1.5, -0.0, 0.0]), i)
        for i in range(300)
    ]
    df = spark.createDataFrame(data, "grp string, v int, w double, id int")
    function = "dense_rank" if dense else "rank"
    expected = df.selectExpr(
        "*", f"{function}() over (partition by grp order by v desc, w asc) as rank"
    ).where("rank <= 4")
    result = top_ranked(df, 4, ["grp"], {"v": "desc", "w": "asc"}, dense=dense)
    assert rows(result) == rows(expected)


def test_top_rows_gives_exactly_n(spark):
    df = spark.createDataFrame(DATA, SCHEMA)
    result = top_rows(df, 2, ["grp"], {"v": "desc", "id": "asc"}, "rn")
    assert {(r["id"], r["rn"]) for r in result.collect()} == {
        (1, 1),
        (2, 2),
        (9, 1),
        (7, 2),
        (10, 1),
        (11, 2),
    }


def test_large_n_cuts_groups_in_parts(spark, small_conf):
    df = spark.range(0, 5000, numPartitions=8).selectExpr("'g' as grp", "id % 1000 as v", "id")
    order = {"v": "desc", "id": "asc"}
    expected = rows(top_rows(df, 700, ["grp"], order, "rn"))
    small_conf("spark.sql.optimizer.windowGroupLimitThreshold", "10")
    result = top_rows(df, 700, ["grp"], order, "rn")
    assert rows(result) == expected
    assert plan(result).count("Exchange hashpartitioning") == 2


def test_group_limit_runs_before_the_shuffle(spark):
    text = plan(top_rows(spark.createDataFrame(DATA, SCHEMA), 2, ["grp"], {"v": "desc"}))
    assert "WindowGroupLimit" in text and "Partial" in text and "Final" in text


def test_ties_do_not_meet_in_one_task(spark):
    df = spark.range(20000).selectExpr("'g' as grp", "1 as v", "id").repartition(8)
    result = top_ranked(df, 3, ["grp"], {"v": "desc"})
    assert result.count() == 20000
    assert "Window" not in plan(result)


def test_partition_filter_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "parts")
    spark.createDataFrame(DATA, SCHEMA).write.partitionBy("grp").parquet(path)
    stored = spark.read.parquet(path)
    through = top_rows(stored, 2, ["grp"], {"v": "desc"}).where("grp = 'g'")
    assert "PartitionFilters: [isnotnull(grp" in plan(through)


def test_sort_direction_is_checked(spark):
    with pytest.raises(ValueError, match="asc"):
        top_rows(spark.createDataFrame(DATA, SCHEMA), 2, ["grp"], {"v": "down"})
