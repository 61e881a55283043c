import random
import zlib
from collections import Counter, defaultdict
from itertools import accumulate

import pytest

from chronofold.llm import prefix, shards
from samples import no_rows, odd_frame, odd_rows


def best_capacity(sizes, count):
    """The smallest capacity of a contiguous partition, tried one by one."""

    def fits(capacity):
        used, room = 1, capacity
        for s in sizes:
            if s > capacity:
                return False
            if s > room:
                used, room = used + 1, capacity
            room -= s
        return used <= count

    low, high = max(sizes), sum(sizes)
    while low < high:
        middle = (low + high) // 2
        low, high = (low, middle) if fits(middle) else (middle + 1, high)
    return low


def check(rows, out, count):
    """Every row once, equal texts together, gapless slots, and no shard above the optimum."""
    assert len(out) == len(rows)
    by_text, load, slots = defaultdict(set), Counter(), defaultdict(list)
    seen = Counter((r.key, r.size, r.text_crc32) for r in out)
    assert seen == Counter((k, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for k, t in rows)
    for r in out:
        by_text[r.size, r.text_crc32].add(r.shard)
        load[r.shard] += r.size
        slots[r.shard].append(r.slot)
    assert all(0 <= s < count for s in load)
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    return load


@pytest.mark.parametrize("grid", [7, 50, shards.GRID])
@pytest.mark.parametrize("count", [1, 3, 16])
def test_the_largest_shard_is_as_small_as_possible(spark, monkeypatch, grid, count):
    import hashlib

    monkeypatch.setattr(shards, "GRID", grid)
    rng = random.Random(grid * 100 + count)
    texts = ["x" * rng.randint(0, 300) + str(rng.randint(0, 60)) for _ in range(150)] + ["hot" * 40] * 70
    rows = list(enumerate(texts))
    df = spark.createDataFrame(rows, "key bigint, text string")
    load = check(rows, shards.shard_by_bytes(df, key="key", shards=count).collect(), count)
    groups = Counter()
    for t in texts:
        groups[hashlib.sha256(t.encode()).hexdigest()] += len(t) + 1
    assert max(load.values()) == best_capacity([groups[d] for d in sorted(groups)], count)


def test_sizes_are_near_equal_without_a_hot_group(spark):
    rows = [(i, f"{i} " * 50) for i in range(3000)]
    load = check(rows, shards.shard_by_bytes(spark.createDataFrame(rows, "key bigint, text string"), key="key").collect(), 16)
    assert len(load) == 16 and max(load.values()) < 1.05 * min(load.values())


def test_odd_rows(spark):
    out = shards.shard_by_bytes(odd_frame(spark))
    rows = [(r[0], r[1]) for r in odd_rows()]
    found = out.withColumnRenamed("doc_id", "key").collect()
    check(rows, found, 16)
    assert out.columns == ["doc_id", "size", "text_crc32", "shard", "slot"]
    again = Counter(tuple(r) for r in shards.shard_by_bytes(odd_frame(spark).repartition(5)).collect())
    assert again == Counter(tuple(r) for r in found)


def test_empty_table(spark):
    assert shards.shard_by_bytes(no_rows(spark)).count() == 0


@pytest.mark.parametrize(
    "sizes, grid, count",
    [
        ([33, 26, 42, 7, 5, 46, 34, 11], 7, 2),
        # cells as wide as what is open: a closer look at single stretches
        ([5, 35, 15, 7, 28, 43], 4, 3),
    ],
)
def test_the_search_ends_where_a_span_stops_short_of_the_next_end(spark, monkeypatch, sizes, grid, count):
    looks, look = [], shards.grid

    def counted(groups, upto, spans):
        looks.append(spans)
        assert len(looks) < 20, "looks at the same totals again"
        return look(groups, upto, spans)

    monkeypatch.setattr(shards, "GRID", grid)
    monkeypatch.setattr(shards, "grid", counted)
    ends = list(accumulate(sizes))
    groups = spark.createDataFrame(list(zip(sizes, ends)), "bytes bigint, upto bigint")
    capacity, cuts = shards.minimax_cuts(groups, "bytes", "upto", count)
    edges = [0, *cuts, ends[-1]]
    assert len(looks) > 1 and capacity == best_capacity(sizes, count)
    assert set(cuts) <= set(ends) and all(0 <= b - a <= capacity for a, b in zip(edges, edges[1:]))


@pytest.mark.parametrize("most, joins", [(1 << 16, 0), (0, 1)])
def test_rows_are_sorted_once_where_ranges_are_few(spark, monkeypatch, small_conf, most, joins):
    small_conf("spark.sql.adaptive.enabled", "false")
    small_conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    monkeypatch.setattr(prefix, "BROADCAST_RANGES", most, raising=False)
    rows = [(i, f"text {i % 37}") for i in range(400)]
    out = shards.shard_by_bytes(spark.createDataFrame(rows, "key bigint, text string"), key="key")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SortMergeJoin") == joins and plan.count("BroadcastHashJoin") == 1 - joins
    check(rows, out.collect(), 16)


def test_small_tables_make_few_files(spark, monkeypatch, small_conf):
    small_conf("spark.sql.adaptive.enabled", "false")
    small_conf("spark.sql.shuffle.partitions", "20")
    monkeypatch.setattr(shards, "FEW_TASKS", 3, raising=False)
    rows = [(i, f"text {i % 37}") for i in range(400)]
    out = shards.shard_by_bytes(spark.createDataFrame(rows, "key bigint, text string"), key="key")
    assert out.rdd.getNumPartitions() == 3
    check(rows, out.collect(), 16)
