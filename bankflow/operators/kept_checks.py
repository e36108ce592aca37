"""Data tests of a growing model whose results are kept: a run scans the rows of its new loads only.

Beside a model's rows (``operators.images``) its published table holds two more kinds. ``fails``: per load, how often each value failed a
not_null or accepted_values test; these add up. ``keys-<column>``: how often each value of a unique column has come, bucketed, of which a
load opens the buckets of its own values; the number of values that came more than once is counted on as loads bring second ones and
stands in the version. Both are published with the load's rows, so they always describe the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bankflow.operators.published import Keyed, Published, State, level_of
from bankflow.operators.quality import checks_of_pairs, failing_pairs
from bankflow.schemas import DATA_TESTS
from bankflow.session import cut_lineage

FAILS, FAIL_SCHEMA = "fails", "t int, v string, count bigint"


def _keys(table: Published, column: str) -> Keyed:
    return Keyed(table, f"keys-{column}", "key", "key string, n bigint")


def of_load(table: Published, state: State, rows: DataFrame, model: str) -> tuple[dict[str, dict], dict[str, int]]:
    """Segments that ``rows`` (stored ones, of a new load) add, and per unique column the number of values that came more than once so far."""
    spec = DATA_TESTS[model]
    [(path, about)] = table.write(failing_pairs(rows, spec), FAILS).items()
    n = table.spark.read.schema(FAIL_SCHEMA).parquet(f"{table.root}/{path}").count()
    added = {path: {**about, "rows": n, "level": level_of(n)}} if n else {}
    repeated = {}
    for column in spec.get("unique", []):
        keys = _keys(table, column)
        new = cut_lineage(rows.where(F.col(column).isNotNull()).groupBy(F.col(column).cast("string").alias("key")).agg(F.count(F.lit(1)).alias("n")), "keys")
        known = keys.read(state, keys.buckets_of(state, new)).select("key", F.col("n").alias("before"))
        before = F.coalesce("before", F.lit(0))
        merged = cut_lineage(new.join(known, "key", "left").select("key", (F.col("n") + before).alias("n"), before.alias("before")), "keys-merged")
        many = F.sum(F.when((F.col("before") < 2) & (F.col("n") > 1), 1).otherwise(0))
        total, more = merged.agg(F.count(F.lit(1)), F.coalesce(many, F.lit(0))).first()
        if total:
            added |= keys.write(state, merged.select("key", "n"), total)
        repeated[column] = state.info.get("repeated", {}).get(column, 0) + more
    return added, repeated


def compact(table: Published, state: State, model: str) -> State:
    for column in DATA_TESTS[model].get("unique", []):
        state = _keys(table, column).compact(state)
    return table.compact(state, FAILS, FAIL_SCHEMA)


def results(table: Published, state: State, model: str) -> DataFrame:
    """The declared tests of all rows loaded so far, as ``quality.model_checks`` gives them; no row of the model is read."""
    spec, spark = DATA_TESTS[model], table.spark
    pairs = table.read(state, FAILS, FAIL_SCHEMA)
    out = checks_of_pairs(spark.createDataFrame([], FAIL_SCHEMA) if pairs is None else pairs, model, spec)
    unique = [(model, c, "unique", state.info["repeated"][c]) for c in spec.get("unique", [])]
    return out.unionByName(spark.createDataFrame(unique, "model string, column_name string, test string, failures bigint"))
