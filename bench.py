"""Benchmark: headline queries over $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is executed in full through the ``noop`` sink (every row is
produced, nothing is collected to the driver).  After one process warm-up,
each query gets one untimed warm-up run (pays code generation and JIT for its plan; reported as
``cold_queries``), then ``$BENCH_REPEATS`` (default 3) timed runs whose median is reported in
``queries`` (all runs in ``runs``).  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "mrr_by_month_plan",      # flagship mart (running-sum form)
    "mrr_from_grain",         # same result by aggregating the exploded monthly grain
    "mrr_running_sum",        # the running-sum operator on its own
    "subscription_months",    # the monthly grain itself
    "churn_rates",
    "customer_ltv",
    "effective_dates",
    "stg_invoices",
    "incremental_invoices",
    "scd2_history",
    "fx_asof",
    "dq_column_checks",
]


def main() -> None:
    from ledgerline import get_session
    from ledgerline.plans.queries import QUERIES

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = sys.argv[1:] or HEADLINE
    spark = get_session("ledgerline-bench", master=f"local[{cpus}]", shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", cpus * 2)),
                        extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEM", "8g")})
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    run("mrr_running_sum")  # process warm-up (JVM start-up, first code generation)
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    cold, times, runs = {}, {}, {}
    for n in names:
        cold[n] = round(run(n), 3)
        runs[n] = [round(run(n), 3) for _ in range(repeats)]
        times[n] = statistics.median(runs[n])
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf, "cpus": cpus,
                      "protocol": f"process warm-up, then per query: warm-up run, median of {repeats} "
                                  "timed runs; noop sink",
                      "runs": runs, "cold_queries": cold, "cold_total": round(sum(cold.values()), 3)}))
    spark.stop()


if __name__ == "__main__":
    main()
