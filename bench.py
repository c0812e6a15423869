"""Times the headline queries and prints one JSON line.

The rate tables are derived from $BENCH_SF_DIR and stored as Parquet first
(``setup_sec``); each query then runs over the stored tables, every column of
its result computed.  Per query the better of two runs counts.  $BENCH_FOLDER
names the folder of the stored tables, which a cluster has to share.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from ratelattice.plans.queries import PLANS
from ratelattice.session import build_session
from ratelattice.sources.tables import DerivedTables, StoredTables, store_tables

HEADLINE = [
    "rate_matrix_asof", "rate_asof", "rate_asof_multi", "rate_changes", "rate_intervals", "entry_history", "entry_lineage",
    "child_sum_violations", "max_allowed_rate", "row_tree_keys", "row_tree_cells", "row_tree_pivot", "group_tree_json",
    "upsert_product_lines", "upsert_nodes", "cascade_delete", "detached_entries", "add_rate_entries", "update_rate_entries",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = build_session(f"local[{cpus}]", int(cpus), **{"spark.driver.memory": "16g"})
    folder = os.environ.get("BENCH_FOLDER") or tempfile.mkdtemp(prefix="bench-")

    start = time.perf_counter()
    store_tables(DerivedTables(spark, sf_dir), folder)
    setup = time.perf_counter() - start

    tables = StoredTables(spark, folder, sf_dir)
    timings = {}
    for name in names:
        runs = []
        for _ in range(2):
            start = time.perf_counter()
            PLANS[name](tables).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        timings[name] = round(min(runs), 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": os.path.basename(os.path.normpath(sf_dir)).removeprefix("sf"),
                "setup_sec": round(setup, 3),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
