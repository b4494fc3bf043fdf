"""Time the headline queries on one scale factor; print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) pick
the data and local parallelism. Each query is timed from the call (some jobs
land files or write tables while being built) through a full execution into
Spark's no-op sink, so nothing is collected to the driver.

Before timing, the same query shapes run once on the smallest tables
(sf0.001, if present) so JIT and generated-code compilation are warm: the
numbers are steady-state times on the target data, as on a long-lived cluster.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "snapshot_open_po", "snapshot_all_prs", "mart_open_po_weekly", "mart_top_suppliers",
    "card_top_suppliers", "card_kpi_latest", "grid_resolve", "grid_snapshot_open_po",
    "compact_last", "dq_unique_keys", "dq_row_count_delta", "upsert_twice", "backfill_weeks",
    "stream_ingest_snapshot",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE

    from snapweave.registry import QUERIES
    from snapweave.session import get_session

    spark = get_session("snapweave-bench", cores=cpus)
    warm_dir = os.environ.get("BENCH_WARM_DIR", "/root/testdata/sf0.001")
    if os.path.isdir(warm_dir) and os.path.abspath(warm_dir) != os.path.abspath(sf_dir):
        for name in names:
            QUERIES[name](spark, warm_dir).write.format("noop").mode("overwrite").save()

    times: dict[str, float] = {}
    for name in names:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
        print(f"{name}: {times[name]}s", file=sys.stderr, flush=True)

    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "total_query_time",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": int(cpus) if cpus.isdigit() else cpus,
    }))


if __name__ == "__main__":
    main()
