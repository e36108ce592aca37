"""Staging kept up to date load by load: equal to the rebuild, from new loads only."""
import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

from bankflow.operators import images, published, quality, snapshots, staging
from bankflow.operators.published import Published
from bankflow.plans.runs import run_transform
from bankflow.session import list_names, work_dir, write_text
from bankflow.sources import landing

T0 = dt.datetime(2024, 1, 1)


def load(spark, raw, name, rows, table="accounts"):
    """Write one complete load: (row image, ts_ms, seq)."""
    df = spark.createDataFrame([(json.dumps(v), ts, seq) for v, ts, seq in rows], "j string, _ts_ms bigint, _seq bigint")
    df.select(F.parse_json("j").alias("v"), "_ts_ms", "_seq", F.lit("f").alias("_file"), F.lit(name).alias("load"), F.lit(table).alias("table_name"),
              F.lit(dt.date(2024, 1, 1)).alias("date")).coalesce(1).write.mode("append").partitionBy("load", "table_name", "date").parquet(raw)
    write_text(spark, f"{raw}/_loads/{name}", "")


def account(i, balance, hours=0):
    at = None if hours is None else (T0 + dt.timedelta(hours=hours)).isoformat()
    return {"id": i, "customer_id": 1, "account_type": "SAVINGS", "balance": balance, "currency": "EUR", "created_at": at}


def rows_of(df):
    return sorted(map(str, df.collect()))


def test_equals_rebuild_after_every_load(spark, monkeypatch):
    monkeypatch.setattr(published, "FAN", 3)                       # merges within a few loads
    rng, raw, path = random.Random(3), work_dir(spark, "t-raw"), work_dir(spark, "t-model")
    for n in range(5):
        rows = [(account(rng.choice([None, *range(12)]), n + k / 100, rng.choice([None, 0, 0, 1, 2])), rng.randrange(3), n * 100 + k)
                for k in range(rng.randrange(1, 15))]
        load(spark, raw, f"run{n}.0", rows + rows[:2])             # repeated rows
        as_of = T0 + dt.timedelta(days=n)
        images.take_loads(spark, raw, path, "stg_accounts", as_of)
        want = staging.stg_accounts(landing.raw(spark, raw, "accounts"), as_of)
        got = images.read_model(spark, path, "stg_accounts")
        assert got.columns == want.columns and rows_of(got) == rows_of(want)
    assert len(Published(spark, path).state().of(images.ROWS)) < 5


def test_every_image_model_equals_rebuild(spark):
    raw, path = work_dir(spark, "t-raw"), work_dir(spark, "t-model")
    for n in range(3):
        load(spark, raw, f"run{n}.0", [({"id": k, "account_id": 1, "amount": n}, n, k) for k in range(4)], "transactions")
        images.take_loads(spark, raw, path, "stg_transactions", T0)
    want = staging.stg_transactions(landing.raw(spark, raw, "transactions"), T0, "as_written")
    assert rows_of(images.read_model(spark, path, "stg_transactions")) == rows_of(want) and want.count() == 12


def test_kept_checks_equal_a_full_scan(spark, monkeypatch):
    monkeypatch.setattr(published, "FAN", 2)
    rng, raw, path = random.Random(4), work_dir(spark, "t-raw"), work_dir(spark, "t-model")
    for n in range(5):
        rows = [({"id": rng.choice([None, *range(40)]), "account_id": rng.choice([None, 1]), "txn_type": rng.choice([None, "DEPOSIT", "X", f"Y{n % 2}"]),
                  "status": rng.choice(["PENDING", "?"]), "created_at": rng.choice([None, T0.isoformat()])}, n, k) for k in range(rng.randrange(0, 25))]
        load(spark, raw, f"run{n}.0", rows, "transactions") if rows else write_text(spark, f"{raw}/_loads/run{n}.0", "")
        if n:
            images.take_loads(spark, raw, path, "stg_transactions", T0)
            whole = staging.stg_transactions(landing.raw(spark, raw, "transactions"), T0, "as_written")
            count, got = images.kept(spark, path, "stg_transactions")
            assert count == whole.count() and rows_of(got) == rows_of(quality.model_checks(whole, "stg_transactions"))
    assert any(r["test"] == "unique" and r["failures"] > 0 for r in got.collect())
    state = Published(spark, path).state()
    for segment in state.of(images.ROWS):                          # a later run opens no stored row
        for name in list_names(spark, f"{path}/{segment}"):
            write_text(spark, f"{path}/{segment}/{name}", "this is no parquet file")
    monkeypatch.setattr(published, "FAN", 100)
    load(spark, raw, "run9.0", [({"id": 1, "account_id": 1}, 9, 9)], "transactions")
    images.take_loads(spark, raw, path, "stg_transactions", T0)
    whole = staging.stg_transactions(landing.raw(spark, raw, "transactions"), T0, "as_written")
    assert rows_of(images.kept(spark, path, "stg_transactions")[1]) == rows_of(quality.model_checks(whole, "stg_transactions"))


def test_reads_new_loads_only(spark):
    raw, path = work_dir(spark, "t-raw"), work_dir(spark, "t-model")
    load(spark, raw, "run0.0", [(account(1, 1.0), 1, 1)])
    images.take_loads(spark, raw, path, "stg_accounts", T0)
    part = f"{raw}/load=run0.0/table_name=accounts/date=2024-01-01"
    for name in list_names(spark, part):                           # whoever opens the first load fails
        write_text(spark, f"{part}/{name}", "this is no parquet file")
    load(spark, raw, "run1.0", [(account(1, 2.0), 2, 2), (account(2, 5.0), 2, 3)])
    images.take_loads(spark, raw, path, "stg_accounts", T0)
    assert {r["account_id"]: float(r["balance"]) for r in images.read_model(spark, path, "stg_accounts").collect()} == {"1": 2.0, "2": 5.0}


def test_older_images_write_nothing_and_runs_without_loads_only_the_time(spark):
    raw, path = work_dir(spark, "t-raw"), work_dir(spark, "t-model")
    load(spark, raw, "run0.0", [(account(1, 1.0, 5), 9, 9)])
    first = images.take_loads(spark, raw, path, "stg_accounts", T0)
    load(spark, raw, "run1.0", [(account(1, 7.0, 4), 10, 10), (account(1, 1.0, 5), 9, 9)])
    images.take_loads(spark, raw, path, "stg_accounts", T0)
    state = Published(spark, path).state()
    assert len(state.of(images.ROWS)) == 1 and state.info["loads"] == ["run0.0", "run1.0"]
    later = images.take_loads(spark, raw, path, "stg_accounts", T0 + dt.timedelta(days=1))
    assert images.take_loads(spark, raw, path, "stg_accounts", T0 + dt.timedelta(days=1)) == later
    [row] = images.read_model(spark, path, "stg_accounts").collect()
    assert float(row["balance"]) == 1.0 and row["load_timestamp"] == T0 + dt.timedelta(days=1)
    assert images.read_model(spark, path, "stg_accounts", since=first).count() == 0


def test_a_writer_that_dies_takes_the_load_again(spark):
    raw, path = work_dir(spark, "t-raw"), work_dir(spark, "t-model")
    load(spark, raw, "run0.0", [(account(1, 1.0), 1, 1)])
    images.take_loads(spark, raw, path, "stg_accounts", T0)
    load(spark, raw, "run1.0", [(account(1, 2.0), 2, 2)])

    def die():
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError, match="lost"):
        images.take_loads(spark, raw, path, "stg_accounts", T0, before_publish=die)
    balance = lambda: [float(r["balance"]) for r in images.read_model(spark, path, "stg_accounts").collect()]
    assert balance() == [1.0]
    images.take_loads(spark, raw, path, "stg_accounts", T0)
    assert balance() == [2.0]


def test_snapshots_of_changed_images_equal_those_of_all(spark):
    raw, root, whole = (work_dir(spark, n) for n in ("t-raw", "t-root", "t-whole"))
    for n in range(4):
        for table in ("customers", "transactions", "ledger_entries"):
            load(spark, raw, f"run{n}.0", [({"id": n, "first_name": "A", "created_at": T0.isoformat()}, n, n)], table)
        # account 0 never changes, 1 does each day, n+10 is new; one load comes without a run of its own
        load(spark, raw, f"run{n}.0", [(account(1, float(n), n), n, n), (account(n + 10, 1.0), n, 50 + n)] + ([(account(0, 3.0), 0, 0)] if n == 0 else []))
        if n == 1:
            continue
        as_of = T0 + dt.timedelta(days=n)
        run_transform(spark, raw, as_of, root)
        want = snapshots.run_snapshot(spark, whole, staging.stg_accounts(landing.raw(spark, raw, "accounts"), as_of), "account_id",
                                      images.S.ACCOUNT_CHECK_COLS, as_of)
        got = snapshots.read_snapshot(spark, f"{root}/accounts_snapshot")
        assert rows_of(got) == rows_of(want.select(*got.columns))


def test_no_loads_at_all(spark):
    raw, path = work_dir(spark, "t-raw"), work_dir(spark, "t-model")
    load(spark, raw, "run0.0", [({"id": 1}, 1, 1)], "customers")       # none of accounts
    images.take_loads(spark, raw, path, "stg_accounts", T0)
    assert images.read_model(spark, path, "stg_accounts").count() == 0
    images.take_loads(spark, raw, path + "-t", "stg_transactions", T0)
    assert images.read_model(spark, path + "-t", "stg_transactions").count() == 0
