"""Benchmark the headline queries.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query runs end to end into Spark's ``noop`` sink (the whole plan is
executed, nothing is collected to the driver): one warm-up, then
``BENCH_RUNS`` timed runs (default 5: run-to-run noise on a shared VM is
about ±10%); the median is reported. Prints ONE JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    # order / flight / retail analytics jobs
    "revenue_by_category", "top_products", "daily_order_trends",
    "delay_by_airline", "top_routes", "daily_flight_trends",
    "order_totals_df", "top_dates_df", "sql_cte_subquery",
    # shaping and cleaning operators on the largest tables
    "dedupe_by_key", "latest_per_key", "merge_upsert", "clean_orders",
    "apply_mapping", "order_item_discount", "join_right",
    # choice columns, nested data, Python row functions
    "resolve_cast_double", "choice_profile", "relationalize_items", "unbox_json",
    "map_rows", "filter_row_fn",
    # data-engineering jobs
    "quality_report", "scd2", "backfill_days",
]


# the end-to-end jobs, from source to sink; timed beside the total
JOBS = ["order_analytics_job", "airlines_job", "clean_orders_job", "incremental_append_job"]


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "5"))
    names = sys.argv[1:] or HEADLINE

    from cairn.plans import registry
    from cairn.session import build_session

    spark = build_session(f"local[{cpus}]", app="cairn-bench", shuffle_partitions=cpus,
                          extra={"spark.driver.memory": "16g"})
    qs = registry.queries()

    def timed(n: str, times: int) -> float:
        def once():
            t0 = time.perf_counter()
            qs[n](spark, sf).write.format("noop").mode("overwrite").save()
            return time.perf_counter() - t0
        once()  # warm-up
        return round(statistics.median(once() for _ in range(times)), 3)

    timings = {n: timed(n, runs) for n in names}
    total = round(sum(timings.values()), 3)
    jobs = {} if sys.argv[1:] else {n: timed(n, min(runs, 3)) for n in JOBS}
    print(json.dumps({"metric": "total_median_sec", "value": total, "unit": "sec",
                      "queries": timings, "jobs": jobs,
                      "sf": os.path.basename(sf.rstrip("/")).replace("sf", ""),
                      "cpus": cpus, "runs": runs}))
    spark.stop()


if __name__ == "__main__":
    main()
