"""Time the headline queries; prints one JSON line.

Every query is run once to warm up and then ``BENCH_RUNS`` times (default 3); its time is the
median, from building the plan to the last row (written to Spark's ``noop`` sink).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from chronofold.plans.queries import QUERIES  # noqa: E402
from chronofold.session import get_session  # noqa: E402
from chronofold.sources.scratch import end_run  # noqa: E402

HEADLINE = [
    "nested_explode_outer",
    "nested_explode_inner",
    "nested_explode_position",
    "nested_flatten_structs",
    "json_parse_explode",
    "json_event_props",
    "json_inferred_schema",
    "scd2_classify",
    "scd2_expire",
    "scd2_apply",
    "scd2_apply_shuffled",
    "scd2_apply_orders",
    "scd2_long_history",
    "scd2_long_history_shuffled",
    "scd2_violations_found",
    "merge_upsert",
    "dedup_latest",
    "dedup_documents",
    "topn_row_number",
    "topn_rank",
    "topn_dense_rank",
    "skew_salted_join",
    "skew_broadcast_join",
    "skew_aqe_join",
    "publish_roundtrip",
    "dimension_commit",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINE
    spark = get_session(
        "bench",
        master=f"local[{cpus}]",
        shuffle_partitions=8,
        extra={
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="bench-"),
        },
    )
    spark.sparkContext.setLogLevel("OFF")
    times = {}
    for name in names:
        taken = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
        times[name] = round(statistics.median(taken[1:]), 3)
    end_run(spark)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": Path(folder).name.removeprefix("sf"),
                "cpus": int(cpus),
                "runs": runs,
            }
        )
    )


if __name__ == "__main__":
    main()
