"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR names the data folder, BENCH_CPUS the number of local threads.
"""

from __future__ import annotations

import json
import os
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from olapkit.plans.tables import Tables  # noqa: E402
from olapkit.registry import QUERIES  # noqa: E402
from olapkit.registry.shapes import flat_shape, record_shape  # noqa: E402
from olapkit.sources.stored_shapes import ShapeStore  # noqa: E402
from olapkit.workspace import local_session, new_path  # noqa: E402

HEADLINE = [
    *["q1_pricing_summary", "q2_order_revenue", "q3_priority_count", "q4_local_supplier", "q5_forecast"],
    *[f"flat_q{i}" for i in range(1, 6)],
    *[f"kv_q{i}" for i in range(1, 6)],
    *["store_q1", "count_all", "count_quantity", "count_key"],
    *["flat_line_item", "sparse_order", "op_insert", "op_update", "op_upsert", "add_row_id", "latest", "diff_scan", "metric_resample"],
]


def run(spark, name: str, folder: str) -> float:
    """Seconds to compute every row and column of a result, without keeping it."""
    start = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def load(spark, shape, folder: str) -> float:
    """Seconds to write a stored shape into a store of its own; what it builds on is stored already."""
    store = ShapeStore(spark, new_path(spark, "loads"))
    start = time.perf_counter()
    store.load(shape(Tables(spark, folder)))
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))
    names = sys.argv[1:] or HEADLINE
    for _ in range(2):
        run(spark, "q1_pricing_summary", folder)
    # The flat and record queries read stored shapes; what it takes to write those is timed apart.
    loads = {}
    if any(name.startswith(("flat_q", "kv_q")) for name in names):
        for name, shape in (("load_flat", flat_shape), ("load_records", record_shape)):
            load(spark, shape, folder)
            loads[name] = round(min(load(spark, shape, folder) for _ in range(2)), 3)
    seconds = {name: round(min(run(spark, name, folder) for _ in range(3)), 3) for name in names}
    print(
        json.dumps(
            {
                "metric": "headline queries, best of three runs, summed",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "loads": loads,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
