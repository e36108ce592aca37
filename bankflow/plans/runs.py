"""Run composition: the daily ingest and the transform, as plain functions.

Scheduling, retries and e-mail are left to the caller; these return the data
the reports were built from. All state lies under paths that the caller names, so
a run goes on where the one before ended.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bankflow import schemas as S
from bankflow.operators import images, marts, quality, snapshots, staging
from bankflow.sources import cdc, landing


def run_ingest(spark: SparkSession, events: DataFrame, base: str, raw: str, checkpoint: str, run: str,
               day: str | None = None, as_of=None) -> DataFrame:
    """Land change events under ``base``, load the landed files (of one day, if given) that are not loaded yet into ``raw``,
    report this run per table. ``run`` names the run; ``checkpoint`` remembers the files over runs."""
    landing.write_landing(cdc.decode(events), base, as_of=as_of)
    landing.load_raw(spark, base, raw, checkpoint, day=day, run=run)
    return landing.load_report(spark, raw, run)


def run_transform(spark: SparkSession, raw: dict[str, DataFrame] | str, as_of, root: str) -> DataFrame:
    """staging -> staging tests -> snapshots -> analytics -> analytics tests, under ``root``.

    ``raw``: the raw table's path, of which staging, snapshots and the fact take the loads that they have not taken yet, or its rows per
    table, from which staging is rebuilt. A root belongs to one of the two ways. Returns one row per model: (model, layer, rows,
    failed_tests). Test failures never stop the run (the reference ignores them too).
    """
    as_of_ts = as_of if isinstance(as_of, dt.datetime) else dt.datetime.fromisoformat(str(as_of))
    by_load = isinstance(raw, str)
    if by_load:
        versions = {name: images.take_loads(spark, raw, f"{root}/{name}", name, as_of) for name in images.MODELS}
        staged = {name: images.read_model(spark, f"{root}/{name}", name) for name in images.MODELS}
        kept = {name: images.kept(spark, f"{root}/{name}", name) for name, model in images.MODELS.items() if not model.key}
    else:
        kept = {}
        stg = {
            "stg_customers": staging.stg_customers(raw["customers"], as_of),
            "stg_accounts": staging.stg_accounts(raw["accounts"], as_of),
            "stg_transactions": staging.stg_transactions(raw["transactions"], as_of, "as_written"),
            "stg_ledger_entries": staging.stg_ledger_entries(raw["ledger_entries"], as_of),
        }
        staged = {name: marts.as_table(df, f"{root}/{name}") for name, df in stg.items()}
    tests = quality.run_suite({name: df for name, df in staged.items() if name not in kept}, "staging")
    for _, results in kept.values():
        tests = tests.unionByName(results)

    def snapshot(name: str, of: str, check_cols: list[str]) -> DataFrame:
        path, key, source, taken = f"{root}/{name}", images.MODELS[of].key, staged[of], {}
        if by_load:                                  # images that have not changed since the last step cannot open or close a version
            source = images.read_model(spark, f"{root}/{of}", of, since=snapshots.taken(spark, path).get("images", 0))
            taken["images"] = versions[of]
        return snapshots.run_snapshot(spark, path, source, key, check_cols, as_of_ts, **taken)

    cust = snapshot("customers_snapshot", "stg_customers", S.CUSTOMER_CHECK_COLS)
    acct = snapshot("accounts_snapshot", "stg_accounts", S.ACCOUNT_CHECK_COLS)
    fact = marts.facts_from_raw(spark, raw if by_load else raw["transactions"], f"{root}/facts_transactions", as_of)
    analytics = {
        "dim_customers": marts.as_table(marts.dim_customers(cust), f"{root}/dim_customers"),
        "dim_accounts": marts.as_table(marts.dim_accounts(acct), f"{root}/dim_accounts"),
        "facts_transactions": fact.drop("txn_date"),
    }
    tests = tests.unionByName(quality.run_suite(analytics, "analytics"))
    failed = tests.groupBy("model").agg(F.sum(F.when(F.col("failures") > 0, 1).otherwise(0)).alias("failed_tests"))
    counts = None
    for name, df in {**staged, **analytics}.items():
        rows = spark.range(1).select(F.lit(kept[name][0]).cast("bigint").alias("rows")) if name in kept else df.agg(F.count(F.lit(1)).alias("rows"))
        c = rows.select(F.lit(name).alias("model"), F.lit(S.MODEL_LAYER[name]).alias("layer"), "rows")
        counts = c if counts is None else counts.unionByName(c)
    return counts.join(failed, "model", "left").select(
        "model", "layer", "rows", F.coalesce("failed_tests", F.lit(0)).cast("bigint").alias("failed_tests"))
