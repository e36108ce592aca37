"""Benchmark the headline queries; prints ONE JSON line.

env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_RUNS (timed runs per query, default 3; the median is reported),
BENCH_WARMUP (untimed runs per query before timing, default 0),
BENCH_QUERIES (comma list to override the headline set).
Each run is forced with a ``noop`` write, so the whole plan executes. One
untimed run of a small query warms the JVM first; per query, the median of 3
runs already leaves out a cold first run.
"""
from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "cdc_route_topic",          # decode + route every change event
    "raw_load",                 # landing write + exactly-once raw load
    "stg_customers",            # flatten + latest image per key
    "stg_transactions",
    "scd2_customers_day2",      # two SCD2 runs
    "dim_accounts",
    "facts_incremental",        # strict high-water incremental load
    "facts_upsert",             # partition-rewrite upsert
    "post_decisions",           # ordered conditional posting (fixpoint)
    "dq_suite_staging",         # 31 declared tests
    "kpi_customer_balance",     # dims -> KPI join/aggregate
    "kpi_amount_over_time",
    "stream_facts",             # Structured Streaming foreachBatch fact load
]


def input_times(spark, sf_dir: str) -> dict[str, float]:
    """Seconds that queries spend on their test inputs before any operator: building the change log of a table from the
    driver tables, and decoding it into stored raw rows (operator P1, shared by all that come after)."""
    from bankflow.plans import fixtures as fx
    from bankflow.sources import cdc

    out = {}
    for table in ("customers", "transactions"):
        t0 = time.perf_counter()
        fx.change_log(spark, sf_dir, (table,)).write.format("noop").mode("overwrite").save()
        t1 = time.perf_counter()
        cdc.materialize_raw(fx.change_log(spark, sf_dir, (table,)))
        out[f"{table}_log"], out[f"{table}_log_and_decode"] = round(t1 - t0, 3), round(time.perf_counter() - t1, 3)
    return out


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    warmup = int(os.environ.get("BENCH_WARMUP", "0"))
    names = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q] or HEADLINE

    from bankflow.plans.queries import QUERIES
    from bankflow.session import get_spark

    spark = get_spark(f"local[{cpus}]", shuffle_partitions=max(8, cpus * 2))
    QUERIES["stg_customers"](spark, sf_dir).write.format("noop").mode("overwrite").save()  # JVM warm-up
    inputs = input_times(spark, sf_dir)
    timings: dict[str, float] = {}
    for name in names:
        fn = QUERIES[name]
        samples = []
        for i in range(warmup + runs):
            t0 = time.perf_counter()
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            if i >= warmup:
                samples.append(time.perf_counter() - t0)
        timings[name] = round(statistics.median(samples), 3)
        print(f"{name}: {timings[name]}s", file=sys.stderr, flush=True)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({
        "metric": "headline_total_sec",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "inputs": inputs,
        "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
        "cpus": cpus,
        "runs": runs,
        "warmup": warmup,
        "shuffle_partitions": spark.conf.get("spark.sql.shuffle.partitions"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
