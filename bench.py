"""Time the headline queries and print one JSON line.

BENCH_SF_DIR   folder of test tables (default /root/testdata/sf0.1)
BENCH_CPUS     local cores (default 8)
BENCH_REPEATS  timed runs per query after one warm-up run; the median counts (default 3)
BENCH_QUERIES  comma-separated query names instead of the headline ones, or "all"
"""

from __future__ import annotations

import json
import os
import statistics
import time

from cashline.plans.registry import all_queries
from cashline.session import local_session

HEADLINE = """
    fct_items billing_fact latest_by_change latest_max_by scd2_orders scd2_events pit_join
    pit_join_as_of orphan_flag order_calendar dim_customer fct_sales_order_items
    fct_billing_items fct_delivery_items fct_receivable_items value_by_customer_month
    open_value shipped_vs_ordered check_unique check_relationships check_overlap
""".split()

# Loading, a whole build with all checks, and three refreshes, timed once each.
ONCE = ["loaded_customers", "declared_checks", "refreshed_orders"]


def seconds(run) -> float:
    start = time.perf_counter()
    run()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = int(os.environ.get("BENCH_CPUS", "8"))
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    known = all_queries()
    chosen = os.environ.get("BENCH_QUERIES", "")
    names = list(known) if chosen == "all" else chosen.split(",") if chosen else [*HEADLINE, *ONCE]

    spark = local_session(cores, name="bench")

    def run(name: str) -> None:
        # Planned anew each time and written to nowhere: every column is computed, none collected.
        known[name](spark, sf_dir).write.format("noop").mode("overwrite").save()

    timings = {}
    for name in names:
        if name in ONCE:
            timings[name] = round(seconds(lambda: run(name)), 3)
            continue
        run(name)
        timings[name] = round(statistics.median(seconds(lambda: run(name)) for _ in range(repeats)), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(t for name, t in timings.items() if name not in ONCE), 3),
                "unit": "sec",
                "queries": timings,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "cores": cores,
            }
        )
    )


if __name__ == "__main__":
    main()
