"""Small unit tests: sequence numbering, suite failure policy, shared folders."""
import pytest
from pyspark.sql import functions as F

from bankflow.functions.sequence import account_numbers, dense_sequence
from bankflow.operators import quality
from bankflow.session import checkpoint_root, drop_work, path_exists, work_dir


def test_dense_sequence_across_partitions(spark):
    df = spark.range(0, 3000, 3).repartition(7).select((F.col("id") * 1).alias("k"))
    got = [(r["k"], r["seq"]) for r in dense_sequence(df, ["k"], start=10).orderBy("k").collect()]
    assert [s for _, s in got] == list(range(10, 10 + 1000))
    nums = account_numbers(df.withColumnRenamed("k", "id"), ["id"]).orderBy("id").first()
    assert nums["account_number"] == "AC1000000000"


def test_suite_stop_raises_on_failure(spark):
    df = spark.createDataFrame([("1", None), ("1", "X")], "account_id string, customer_id string")
    models = {"dim_accounts": df.select("*", F.lit("SAVINGS").alias("account_type"),
                                        F.lit("ACTIVE").alias("account_status"), F.lit(True).alias("is_current"))}
    warn = quality.run_suite(models, "analytics", on_failure="warn")
    assert {(r["column_name"], r["test"]): r["failures"] for r in warn.collect()}[("account_id", "unique")] == 1
    with pytest.raises(AssertionError):
        quality.run_suite(models, "analytics", on_failure="stop")


def test_account_numbers_over_batches(spark):
    state = work_dir(spark, "t-numbers")
    first = account_numbers(spark.range(0, 50), ["id"], state=state)
    none = account_numbers(spark.range(0, 0), ["id"], state=state)
    second = account_numbers(spark.range(50, 80), ["id"], state=state)
    assert none.count() == 0
    assert sorted(r[0] for r in first.union(second).select("account_number").collect()) == [f"AC{1000000000 + i}" for i in range(80)]


def test_suite_counts_rows_and_values(spark):
    df = spark.createDataFrame([(None, "A"), (None, "B"), ("x", "B"), ("y", None), ("y", "C")], "k string, v string")
    spec = {"not_null": ["k", "v"], "unique": ["k"], "accepted_values": {"v": ["A"]}}
    got = {(r["column_name"], r["test"]): r["failures"] for r in quality.model_checks(df, "m", spec).collect()}
    assert got == {("k", "not_null"): 2, ("v", "not_null"): 1, ("v", "accepted_values"): 2, ("k", "unique"): 1}
    plan = quality.model_checks(df, "m", spec)._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan


def test_load_report_text(spark):
    from bankflow.sources.landing import report_text

    rows = spark.createDataFrame([("accounts", 2, 10), ("customers", 1, 3)], "table_name string, files long, rows long")
    assert report_text(rows).splitlines()[1:] == ["accounts: 10 rows from 2 files", "customers: 3 rows from 1 files"]
    assert "nothing" in report_text(rows.limit(0))


def test_no_private_folder_off_one_machine():
    class Conf:
        def get(self, *_):
            return None

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    for Context.master in ("spark://host:7077", "yarn", "local-cluster[3,2,1000]"):
        with pytest.raises(RuntimeError):
            checkpoint_root(Session())


def test_work_folders_go(spark):
    path = work_dir(spark, "t-gone")
    spark.range(3).write.parquet(path)
    assert path_exists(spark, path)
    drop_work(spark, path)
    assert not path_exists(spark, path)
    with pytest.raises(ValueError):
        drop_work(spark, "/tmp")
