"""Declarative data tests and table constraints.

Every check returns failing counts as rows ``(model, column_name, test, failures)``;
nothing aborts unless a suite is run with ``on_failure="stop"``. A model's
not_null and accepted_values tests share ONE aggregation pass; each unique test
is one grouped count.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bankflow.schemas import DATA_TESTS, LENGTH_LIMITS, MODEL_LAYER

RESULT_COLS = ["model", "column_name", "test", "failures"]


def _rows(df_agg: DataFrame, model: str, entries: list[tuple[str, str, str]]) -> DataFrame:
    """Turn one aggregate row (one column per test) into one row per test."""
    structs = [F.struct(F.lit(model).alias("model"), F.lit(col).alias("column_name"), F.lit(test).alias("test"),
                        F.col(alias).cast("bigint").alias("failures"))
               for col, test, alias in entries]
    return df_agg.select(F.inline(F.array(*structs)))


def check_not_null(df: DataFrame, cols: list[str], model: str = "model") -> DataFrame:
    aggs = [F.sum(F.when(F.col(c).isNull(), 1).otherwise(0)).alias(f"nn_{i}") for i, c in enumerate(cols)]
    return _rows(df.agg(*aggs), model, [(c, "not_null", f"nn_{i}") for i, c in enumerate(cols)])


def check_accepted(df: DataFrame, col: str, values: list[str], model: str = "model") -> DataFrame:
    """Distinct values outside the list; NULL passes."""
    return model_checks(df, model, {"accepted_values": {col: values}})


def check_unique(df: DataFrame, col: str, model: str = "model") -> DataFrame:
    """Non-NULL values occurring more than once (one failure per such value)."""
    dup = df.where(F.col(col).isNotNull()).groupBy(col).count().where(F.col("count") > 1)
    return dup.agg(F.count(F.lit(1)).alias("u")).select(
        F.lit(model).alias("model"), F.lit(col).alias("column_name"), F.lit("unique").alias("test"),
        F.col("u").cast("bigint").alias("failures"))


def _tests(spec: dict) -> list[tuple[str, str]]:
    return [(c, "not_null") for c in spec.get("not_null", [])] + [(c, "accepted_values") for c in spec.get("accepted_values", {})]


def failing_pairs(df: DataFrame, spec: dict) -> DataFrame:
    """(t, v, count): how often each value fails the t-th of the not_null and accepted_values tests.

    A row gives one (test, value) pair for each test that it fails and none otherwise; pairs are counted on the map
    side, so only failures are shuffled."""
    fails = [F.when(F.col(c).isNull(), F.struct(F.lit(i).alias("t"), F.lit(None).cast("string").alias("v")))
             if test == "not_null" else
             F.when(~F.col(c).isin(*spec["accepted_values"][c]), F.struct(F.lit(i).alias("t"), F.col(c).cast("string").alias("v")))
             for i, (c, test) in enumerate(_tests(spec))]
    return df.select(F.inline(F.filter(F.array(*fails), lambda x: x.isNotNull()))).groupBy("t", "v").count()


def checks_of_pairs(pairs: DataFrame, model: str, spec: dict) -> DataFrame:
    """One row per not_null and accepted_values test: failing rows for the former, different values for the latter. The
    pairs of several parts of a model may be given together."""
    failed = (pairs.groupBy("t", "v").agg(F.sum("count").alias("count"))
              .groupBy("t").agg(F.sum("count").alias("rows"), F.count(F.lit(1)).alias("values")))
    names = pairs.sparkSession.createDataFrame([(i, model, c, test) for i, (c, test) in enumerate(_tests(spec))],
                                               "t int, model string, column_name string, test string")
    found = F.when(F.col("test") == "not_null", F.col("rows")).otherwise(F.col("values"))
    return names.join(F.broadcast(failed), "t", "left").select(      # one row per failed test
        "model", "column_name", "test", F.coalesce(found, F.lit(0)).cast("bigint").alias("failures"))


def model_checks(df: DataFrame, model: str, spec: dict | None = None) -> DataFrame:
    """All declared tests of one model: one pass for not_null + accepted_values, one per unique."""
    spec = spec or DATA_TESTS[model]
    out = checks_of_pairs(failing_pairs(df, spec), model, spec) if _tests(spec) else None
    for c in spec.get("unique", []):
        u = check_unique(df, c, model)
        out = u if out is None else out.unionByName(u)
    return out


def current_rows(dim: DataFrame) -> DataFrame:
    """The ``*_latest`` reading of a dimension: its current rows."""
    return dim.where(F.col("is_current"))


def run_suite(models: dict[str, DataFrame], layer: str | None = None, on_failure: str = "warn") -> DataFrame:
    """Run the declared tests of every given model (optionally one layer only).

    ``on_failure="stop"`` raises if any test fails; ``"warn"`` only reports.
    """
    results = None
    for name, df in models.items():
        if layer is not None and MODEL_LAYER.get(name) != layer:
            continue
        if name.startswith("dim_"):
            df = current_rows(df)
        r = model_checks(df, name)
        results = r if results is None else results.unionByName(r)
    if results is None:
        raise ValueError(f"no model of layer {layer!r}")
    if on_failure == "stop":
        failed = results.where(F.col("failures") > 0).limit(1).count()
        if failed:
            raise AssertionError(f"data tests failed in layer {layer!r}")
    return results


# ------------------------------------------------------------------ constraints
def check_expr(df: DataFrame, checks: dict[str, Column], model: str = "model") -> DataFrame:
    """Row CHECK constraints: rows where the condition is FALSE (NULL passes), one pass for all."""
    aggs = [F.sum(F.when(~cond, 1).otherwise(0)).alias(f"ck_{i}") for i, cond in enumerate(checks.values())]
    return _rows(df.agg(*aggs), model, [(name, "check", f"ck_{i}") for i, name in enumerate(checks)])


def check_key(df: DataFrame, cols: list[str], model: str = "model") -> DataFrame:
    """PRIMARY KEY / UNIQUE NOT NULL: not_null per column plus uniqueness of the (composite) key."""
    key = F.struct(*cols) if len(cols) > 1 else F.col(cols[0])
    nn = check_not_null(df, cols, model)
    dup = (df.where(F.lit(True) if len(cols) > 1 else F.col(cols[0]).isNotNull())
           .groupBy(key.alias("_k")).count().where(F.col("count") > 1)
           .agg(F.count(F.lit(1)).alias("u"))
           .select(F.lit(model).alias("model"), F.lit(",".join(cols)).alias("column_name"),
                   F.lit("unique").alias("test"), F.col("u").cast("bigint").alias("failures")))
    return nn.unionByName(dup)


def check_fk(child: DataFrame, col: str, parent: DataFrame, key: str, model: str = "model") -> DataFrame:
    """Orphans: non-NULL child values with no parent row."""
    orphans = (child.where(F.col(col).isNotNull()).select(F.col(col).alias("_fk"))
               .join(parent.select(F.col(key).alias("_fk")), "_fk", "left_anti"))
    return orphans.agg(F.count(F.lit(1)).alias("o")).select(
        F.lit(model).alias("model"), F.lit(col).alias("column_name"), F.lit("foreign_key").alias("test"),
        F.col("o").cast("bigint").alias("failures"))


def check_length(df: DataFrame, limits: dict[str, int], model: str = "model") -> DataFrame:
    """VARCHAR(n) / CHAR(n): values longer than n, one pass for all columns."""
    aggs = [F.sum(F.when(F.length(c) > n, 1).otherwise(0)).alias(f"ln_{i}")
            for i, (c, n) in enumerate(limits.items())]
    return _rows(df.agg(*aggs), model, [(c, f"length<={n}", f"ln_{i}") for i, (c, n) in enumerate(limits.items())])


def table_limits(table: str, columns: list[str]) -> dict[str, int]:
    return {c: n for c, n in LENGTH_LIMITS.get(table, {}).items() if c in columns}
