"""Print the physical plan of queries with a short scale checklist.

usage: python tools/explain_plans.py [sf_dir] [query ...]
For each query: shuffles (Exchange), broadcasts, per-key top-1 limits,
scan filters pushed to Parquet and partition filters, Python UDF nodes.
"""
import re
import sys

sys.path.insert(0, __file__.rsplit("/tools/", 1)[0])

from bankflow.plans.queries import QUERIES  # noqa: E402
from bankflow.session import get_spark  # noqa: E402

DEFAULT = ["stg_customers", "stg_transactions", "facts_incremental", "facts_upsert", "kpi_customer_balance",
           "dq_suite_staging", "landing_daily_scan", "post_decisions"]


def summary(plan: str) -> dict:
    return {
        "shuffles": len(re.findall(r"Exchange hashpartitioning|Exchange rangepartitioning|Exchange SinglePartition"
                                   r"|Exchange RoundRobin", plan)),
        "broadcasts": plan.count("BroadcastExchange"),
        "window_group_limit": plan.count("WindowGroupLimit"),
        "pushed_filters": len(re.findall(r"PushedFilters: \[[^\]]+\]", plan)),
        "partition_filters": len(re.findall(r"PartitionFilters: \[[^\]]+\]", plan)),
        "python_udf": plan.count("BatchEvalPython") + plan.count("ArrowEvalPython"),
        "single_partition": plan.count("SinglePartition"),
    }


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or DEFAULT
    spark = get_spark("local[8]")
    for name in names:
        df = QUERIES[name](spark, sf)
        plan = df._jdf.queryExecution().executedPlan().toString()
        print(f"=== {name}: {summary(plan)}")
        df.explain("formatted")


if __name__ == "__main__":
    main()
