"""One query per operator of the inventory, each over the whole driver tables.

A query takes ``(spark, sf_dir)``, derives the banking inputs from the driver
tables (``plans.fixtures``), runs the operator the way the pipeline does
(change events -> decode -> raw -> staging -> ...) and returns a DataFrame.
Queries that persist state (landing, raw, snapshots, facts, streams) use a
fresh folder under the shared checkpoint root per call.
"""

from __future__ import annotations

import datetime as dt
import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bankflow import schemas as S
from bankflow.functions import scalars
from bankflow.functions.variant import flatten
from bankflow.operators import images, kpis, marts, posting, quality, snapshots, staging
from bankflow.operators.published import Published
from bankflow.session import apply_defaults, cut_lineage, drop_path, list_names, move_new, work_dir, write_text
from bankflow.plans import fixtures as fx
from bankflow.sources import cdc, landing
from bankflow.streaming import jobs

LATE_WINDOW = dt.timedelta(days=7)


def _ts(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text)


class Inputs:
    """Inputs of one query call, built lazily and at most once."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        apply_defaults(spark)
        self.spark, self.sf = spark, sf_dir
        self._memo: dict = {}

    def _once(self, key, build):
        if key not in self._memo:
            self._memo[key] = build()
        return self._memo[key]

    # change events and raw rows
    def log_events(self, tables=tuple(S.TABLES)) -> DataFrame:
        """The change log as stored (topic, value) records, as a broker would hold them."""
        tables = tuple(tables)
        return self._once(("log_events", tables),
                          lambda: cut_lineage(fx.change_log(self.spark, self.sf, tables), "events"))

    def log_raw(self, tables=tuple(S.TABLES)) -> DataFrame:
        tables = tuple(tables)
        return self._once(("log_raw", tables),
                          lambda: cdc.materialize_raw(fx.change_log(self.spark, self.sf, tables)))

    def raw(self, table: str) -> DataFrame:
        """One table's raw rows; reuses a stored multi-table raw if this call built one."""
        for key, df in self._memo.items():
            if key[0] == "log_raw" and table in key[1]:
                return df.where(F.col("table_name") == table).drop("table_name")
        return self.log_raw((table,)).drop("table_name")

    def customer_day_raw(self, day: int) -> DataFrame:
        return self._once(("cday", day), lambda: cdc.materialize_raw(fx.customer_events(self.spark, self.sf, day))
                          .drop("table_name"))

    def account_day_raw(self, day: int) -> DataFrame:
        return self._once(("aday", day), lambda: cdc.materialize_raw(fx.account_events(self.spark, self.sf, day))
                          .drop("table_name"))

    def images_raw(self) -> DataFrame:
        return self._once("images", lambda: cdc.materialize_raw(
            fx.customer_events(self.spark, self.sf, 0, second_images=True)).drop("table_name"))

    # staging over the full change log
    def stg_customers(self):
        return staging.stg_customers(self.raw("customers"), fx.AS_OF_2)

    def stg_accounts(self):
        return staging.stg_accounts(self.raw("accounts"), fx.AS_OF_2)

    def stg_transactions(self, mode="latest"):
        return staging.stg_transactions(self.raw("transactions"), fx.AS_OF_2, mode)

    def stg_ledger(self):
        return staging.stg_ledger_entries(self.raw("ledger_entries"), fx.AS_OF_2)

    # snapshots after the two daily runs
    def snapshot(self, entity: str, days=(1, 2), rerun: bool = False) -> DataFrame:
        def build():
            root = work_dir(self.spark, f"snap-{entity}")
            snap = None
            plan = [(d, fx.AS_OF_1 if d == 1 else fx.AS_OF_2) for d in days]
            if rerun:
                plan.append((days[-1], "2024-01-04 00:00:00"))
            for d, as_of in plan:
                if entity == "customers":
                    src = staging.stg_customers(self.customer_day_raw(d), as_of)
                    snap = snapshots.run_snapshot(self.spark, root, src, "customer_id", S.CUSTOMER_CHECK_COLS,
                                                  _ts(as_of))
                else:
                    src = staging.stg_accounts(self.account_day_raw(d), as_of)
                    snap = snapshots.run_snapshot(self.spark, root, src, "account_id", S.ACCOUNT_CHECK_COLS,
                                                  _ts(as_of))
            return snap
        return self._once(("snap", entity, days, rerun), build)

    def dim_customers(self):
        return marts.dim_customers(self.snapshot("customers"))

    def dim_accounts(self):
        return marts.dim_accounts(self.snapshot("accounts"))

    # incremental fact
    def txn_raw_run1(self) -> DataFrame:
        """Run-1 staging input: events before the cutoff, minus the withheld (late) ones.

        A filter over the one stored raw table: capture time and id are already there."""
        cutoff_ms = int((_ts(fx.RUN1_CUTOFF) - dt.datetime(1970, 1, 1)).total_seconds() * 1000)
        e = F.try_variant_get("v", "$.id", "bigint") - 1
        return self.raw("transactions").where((F.col("_ts_ms") < cutoff_ms) & (e % 50 != 0))

    def facts_two_runs(self, mode="insert_only", lateness=None, reversed_run2=False) -> DataFrame:
        def build():
            target = work_dir(self.spark, "facts")
            if mode == "insert_only":
                marts.facts_from_raw(self.spark, self.txn_raw_run1(), target, fx.AS_OF_1)
                return marts.facts_from_raw(self.spark, self.raw("transactions"), target, fx.AS_OF_2, lateness)
            marts.facts_transactions(self.spark, staging.stg_transactions(self.txn_raw_run1(), fx.AS_OF_1),
                                     target, fx.AS_OF_1)
            raw2 = self.raw("transactions")
            if reversed_run2:
                rows = fx.transaction_rows(self.spark, self.sf).withColumn(
                    "status", F.when(F.col("e") % 25 == 3, F.lit("REVERSED")).otherwise(F.col("status")))
                raw2 = cdc.materialize_raw(fx.transaction_events(rows)).drop("table_name")
            return marts.facts_transactions(self.spark, staging.stg_transactions(raw2, fx.AS_OF_2), target,
                                            fx.AS_OF_2, mode, lateness)
        return self._once(("facts", mode, lateness, reversed_run2), build)

    def facts_full(self) -> DataFrame:
        return self._once("facts_full", lambda: marts.facts_from_raw(
            self.spark, self.raw("transactions"), work_dir(self.spark, "facts"), fx.AS_OF_2))

    # posting
    def posting(self) -> posting.Posting:
        return self._once("posting", lambda: posting.post_batch(fx.opening_balances(self.spark, self.sf),
                                                                fx.requests(self.spark, self.sf)))


FACT_COLS = S.STG_TRANSACTIONS_COLS


def _fact_out(df: DataFrame) -> DataFrame:
    return df.select(*FACT_COLS)


def _row_id(col: str = "after"):
    return F.try_variant_get(F.col(col), "$.id", "bigint")


# ------------------------------------------------------------------ sources
def q_cdc_unwrap(spark, sf):
    Inputs(spark, sf)  # session defaults
    d = cdc.decode(fx.change_log(spark, sf))  # no filter after the decode: one job straight from the log
    return d.select("table_name", "op", F.col("_seq").alias("seq"), F.col("_ts_ms").alias("ts_ms"),
                    F.coalesce(_row_id("after"), _row_id("before")).alias("row_id"))


def q_cdc_drop_deletes(spark, sf):
    Inputs(spark, sf)  # session defaults
    d = cdc.keep_upserts(cdc.decode(fx.change_log(spark, sf)))  # one job straight from the log, each envelope parsed once
    return d.select("table_name", "op", F.col("_seq").alias("seq"), _row_id().alias("row_id"))


def q_cdc_route_topic(spark, sf):
    """Events, upserts and deletes per routed table, in one grouped pass over the decoded log."""
    Inputs(spark, sf)  # session defaults
    d = cdc.decode(fx.change_log(spark, sf))  # no filter after the decode: one job straight from the log
    return d.groupBy("table_name").agg(
        F.count(F.lit(1)).alias("events"),
        F.sum(F.col("_upsert").cast("bigint")).alias("upserts"),
        F.sum(F.when(F.col("op") == "d", 1).otherwise(0)).alias("deletes"))


def _landed(inp: Inputs, flush_sizes=None) -> str:
    """Land the change log. Landing filters nothing (deletes go to their own
    partition), so the log is decoded straight from its source in one job."""
    base = work_dir(inp.spark, "landing")
    landing.write_landing(cdc.decode(fx.change_log(inp.spark, inp.sf)), base, flush_sizes)
    return base


def q_cdc_flush_batches(spark, sf):
    inp = Inputs(spark, sf)
    base = _landed(inp, S.FLUSH_SIZES)
    per_file = landing.file_rows(spark, base)
    sizes = spark.createDataFrame(list(S.FLUSH_SIZES.items()), "table_name string, batch_size int")
    return per_file.join(F.broadcast(sizes), "table_name").groupBy("table_name", "batch_size").agg(
        F.sum("rows").alias("rows"),
        F.sum(F.when(F.col("rows") > F.col("batch_size"), 1).otherwise(0)).alias("oversize_files"))


def q_landing_daily_scan(spark, sf):
    inp = Inputs(spark, sf)
    base = _landed(inp)
    day = landing.scan_landing(spark, base, "transactions", "2024-01-02")
    return day.select(F.col("_seq").alias("seq"), _row_id("v").alias("row_id"), "date")


def _raw_loaded(inp: Inputs, twice: bool = True) -> str:
    base = _landed(inp)
    raw_base = work_dir(inp.spark, "raw")
    ckpt = work_dir(inp.spark, "raw-ckpt")
    landing.load_raw(inp.spark, base, raw_base, ckpt)
    if twice:  # a second load finds no new file
        landing.load_raw(inp.spark, base, raw_base, ckpt)
    return raw_base


def q_raw_load(spark, sf):
    raw_base = _raw_loaded(Inputs(spark, sf))
    r = landing.raw_rows(spark, raw_base)
    return r.select("table_name", F.col("_seq").alias("seq"), F.col("_ts_ms").alias("ts_ms"),
                    _row_id("v").alias("row_id"))


def q_raw_scan(spark, sf):
    """``source('raw', 'accounts')``: one table of raw, by its partitions."""
    r = landing.raw(spark, _raw_loaded(Inputs(spark, sf), twice=False), "accounts")
    return r.select(F.col("_seq").alias("seq"), _row_id("v").alias("row_id"), "date")


def q_cdc_read_batch(spark, sf):
    """Event files, read as a batch and decoded."""
    inp = Inputs(spark, sf)
    d = cdc.read_cdc_batch(spark, _event_files(inp, fx.change_log(spark, sf)))
    return d.select("table_name", "op", F.col("_seq").alias("seq"), F.col("_ts_ms").alias("ts_ms"),
                    F.coalesce(_row_id("after"), _row_id("before")).alias("row_id"))


def q_landing_unlisted_table(spark, sf):
    """Flush sizes that name one table only: the others land too, in files of the default size."""
    inp = Inputs(spark, sf)
    per_file = landing.file_rows(spark, _landed(inp, {"customers": 10}))
    size = F.when(F.col("table_name") == "customers", 10).otherwise(S.DEFAULT_FLUSH_SIZE)
    return per_file.groupBy("table_name").agg(
        F.sum("rows").alias("rows"), F.sum(F.when(F.col("rows") > size, 1).otherwise(0)).alias("oversize_files"))


def q_landing_no_timestamp(spark, sf):
    """Account events, a third of them without a capture time, a seventh cut short: the former land on the day of the
    landing run, the latter as bad events with their text; the day's load gets what landed on it."""
    inp = Inputs(spark, sf)
    events = fx.account_events(spark, sf)
    n = F.regexp_extract("value", '"seq":([0-9]+)', 1).cast("bigint") / 2
    value = F.when(n % 7 == 3, F.substring("value", 1, 40)).when(n % 3 == 1, F.regexp_replace("value", '"ts_ms":[0-9]+,', "")).otherwise(F.col("value"))
    base, raw_base = work_dir(spark, "landing"), work_dir(spark, "raw")
    landing.write_landing(cdc.decode(events.select("topic", value.alias("value"))), base, as_of="2024-03-05")
    landing.load_raw(spark, base, raw_base, work_dir(spark, "raw-ckpt"), day="2024-03-05")
    loaded = landing.raw(spark, raw_base, "accounts").select(F.lit("loaded").alias("kind"), "date")
    return (landing.landed(spark, base).select("kind", "date").union(loaded).groupBy("kind", "date").agg(F.count(F.lit(1)).alias("events")))


def q_raw_load_quarantine(spark, sf):
    """A landing folder with a damaged file of accounts: the load takes all others and sets that one aside; mended, it comes in.
    Rows and files set aside per table, before and after."""
    inp = Inputs(spark, sf)
    folder, raw_base, aside = (work_dir(spark, n) for n in ("landing", "raw", "aside"))
    base = f"{folder}/held=false"
    held = (F.col("table_name") == "accounts") & (F.col("kind") == "upsert") & (F.col("_seq") < 100)
    rows = landing.landing_rows(cdc.decode(fx.change_log(spark, sf))).withColumn("held", F.coalesce(held, F.lit(False)))
    rows.hint("rebalance", *landing.PARTITIONS).write.partitionBy("held", *landing.PARTITIONS).parquet(folder)     # one job straight from the log
    first = spark.read.schema(f"{landing.LANDING_SCHEMA}, held boolean").parquet(folder).where("held")
    first.drop("held", *landing.PARTITIONS).coalesce(1).write.parquet(aside)       # the file as it should be: the first few accounts
    [name] = [n for n in list_names(spark, aside) if n.endswith(".parquet")]
    file = f"{base}/table_name=accounts/date=2024-01-01/kind=upsert/{name}"
    write_text(spark, file, "this is no parquet file")
    ckpt = work_dir(spark, "raw-ckpt")
    landing.load_raw(spark, base, raw_base, ckpt)

    def seen(suffix: str) -> DataFrame:
        loaded = landing.raw_rows(spark, raw_base).groupBy("table_name").agg(F.count(F.lit(1)).alias(f"rows_{suffix}"))
        bad = landing.rejects(spark, raw_base).groupBy("table_name").agg(F.count(F.lit(1)).alias(f"rejected_{suffix}"))
        return cut_lineage(loaded.join(bad, "table_name", "left").fillna(0), "quarantine")

    before = seen("before")
    drop_path(spark, file)
    move_new(spark, f"{aside}/{name}", file)
    landing.reload_rejected(spark, base, raw_base, "mended")
    landing.load_raw(spark, base, raw_base, ckpt)              # finds nothing new
    return before.join(seen("after"), "table_name")


def q_load_report(spark, sf):
    return landing.load_report(spark, _raw_loaded(Inputs(spark, sf), twice=False))


def q_currencies(spark, sf):
    from bankflow.sources.reference import currencies

    acc = Inputs(spark, sf).stg_accounts()
    cur = currencies(spark)
    return (acc.groupBy(F.col("currency").alias("code")).agg(F.count(F.lit(1)).alias("accounts"))
            .join(F.broadcast(cur), "code", "left")
            .select(F.col("code").alias("currency"), F.col("name").alias("currency_name"), "accounts"))


# ------------------------------------------------------------------ staging
def q_variant_flatten(spark, sf):
    return flatten(Inputs(spark, sf).raw("customers"), S.STG_CUSTOMERS_SPEC, keep=["_seq"])


def _images(spark, sf) -> DataFrame:
    return flatten(Inputs(spark, sf).images_raw(), S.STG_CUSTOMERS_SPEC, keep=["_ts_ms", "_seq"])


def q_latest_per_key(spark, sf):
    latest = staging.latest_per_key(_images(spark, sf), "customer_id", [F.col("created_at").desc_nulls_first()],
                                    [F.col("_seq").desc()])
    return latest.select("customer_id", "cust_address", "created_at", "_ts_ms", "_seq")


def q_latest_per_key_tiebreak(spark, sf):
    latest = staging.latest_per_key(_images(spark, sf), "customer_id", [F.col("created_at").desc_nulls_first()],
                                    staging.cdc_tiebreak())
    return latest.select("customer_id", "cust_address", "created_at", "_ts_ms", "_seq")


def q_stg_customers(spark, sf):
    return Inputs(spark, sf).stg_customers()


def q_stg_accounts(spark, sf):
    return Inputs(spark, sf).stg_accounts()


def q_stg_transactions(spark, sf):
    return Inputs(spark, sf).stg_transactions("latest")


def q_stg_transactions_as_written(spark, sf):
    return Inputs(spark, sf).stg_transactions("as_written")


def q_stg_ledger_entries(spark, sf):
    return Inputs(spark, sf).stg_ledger()


# ------------------------------------------------------------------ snapshots
SNAP_CUSTOMER_COLS = S.STG_CUSTOMERS_COLS + S.SNAPSHOT_META
SNAP_ACCOUNT_COLS = S.STG_ACCOUNTS_COLS + S.SNAPSHOT_META


def q_scd2_customers_day1(spark, sf):
    return Inputs(spark, sf).snapshot("customers", days=(1,)).select(*SNAP_CUSTOMER_COLS)


def q_scd2_customers_day2(spark, sf):
    return Inputs(spark, sf).snapshot("customers").select(*SNAP_CUSTOMER_COLS)


def q_scd2_accounts_day2(spark, sf):
    return Inputs(spark, sf).snapshot("accounts").select(*SNAP_ACCOUNT_COLS)


def q_scd2_rerun_noop(spark, sf):
    return Inputs(spark, sf).snapshot("customers", rerun=True).select(*SNAP_CUSTOMER_COLS)


def q_scd2_same_day_batches(spark, sf):
    """Three steps within a day, the last two a microsecond apart, and one without a change."""
    inp, root = Inputs(spark, sf), work_dir(spark, "snap")
    src = cut_lineage(staging.stg_customers(inp.customer_day_raw(1), fx.AS_OF_1), "same-day")
    n = F.col("customer_id").cast("bigint")
    second = src.withColumn("phone", F.when(n % 10 == 0, F.lit("555-1111")).otherwise(F.col("phone")))
    third = second.withColumn("phone", F.when(n % 5 == 0, F.lit("555-2222")).otherwise(F.col("phone")))
    for at, df in (("00:00:00", src), ("10:30:00", second), ("10:30:00.000001", third), ("11:00:00", third)):
        snap = snapshots.run_snapshot(spark, root, df, "customer_id", S.CUSTOMER_CHECK_COLS, _ts(f"2024-01-02 {at}"))
    return snap.select("customer_id", "phone", "dbt_scd_id", "dbt_valid_from", "dbt_valid_to")


def q_dim_customers(spark, sf):
    return Inputs(spark, sf).dim_customers()


def q_dim_accounts(spark, sf):
    return Inputs(spark, sf).dim_accounts()


# ------------------------------------------------------------------ facts
def q_facts_full(spark, sf):
    return _fact_out(Inputs(spark, sf).facts_full())


def q_facts_incremental(spark, sf):
    return _fact_out(Inputs(spark, sf).facts_two_runs())


def q_facts_incremental_late(spark, sf):
    return _fact_out(Inputs(spark, sf).facts_two_runs(lateness=LATE_WINDOW))


def q_facts_upsert(spark, sf):
    return _fact_out(Inputs(spark, sf).facts_two_runs("upsert", LATE_WINDOW, reversed_run2=True))


class _Killed(Exception):
    """Stands for a writer that dies."""


def _die() -> None:
    raise _Killed


def q_facts_upsert_interrupted(spark, sf):
    """An upsert that dies after it has written all its rows, and is repeated: the fact that readers see before and after."""
    inp, target = Inputs(spark, sf), work_dir(spark, "facts")
    marts.facts_transactions(spark, staging.stg_transactions(inp.txn_raw_run1(), fx.AS_OF_1), target, fx.AS_OF_1)
    rows = fx.transaction_rows(spark, sf).withColumn("status", F.when(F.col("e") % 25 == 3, F.lit("REVERSED")).otherwise(F.col("status")))
    stg = staging.stg_transactions(cdc.materialize_raw(fx.transaction_events(rows)).drop("table_name"), fx.AS_OF_2)
    try:
        marts.facts_transactions(spark, stg, target, fx.AS_OF_2, "upsert", LATE_WINDOW, before_publish=_die)
    except _Killed:
        during = marts.read_target(spark, target)
    after = marts.facts_transactions(spark, stg, target, fx.AS_OF_2, "upsert", LATE_WINDOW)
    return _fact_out(during).withColumn("seen", F.lit("during")).unionByName(_fact_out(after).withColumn("seen", F.lit("after")))


def q_high_water_mark(spark, sf):
    inp = Inputs(spark, sf)
    target = work_dir(spark, "facts")
    fact = marts.facts_from_raw(spark, inp.txn_raw_run1(), target, fx.AS_OF_1)
    mark = F.lit(marts.high_water(Published(spark, target).state())).cast("timestamp_ntz")
    return fact.agg(F.count(F.lit(1)).alias("loaded")).select(mark.alias("high_water"), "loaded")


def q_facts_null_time_rerun(spark, sf):
    """Transactions that have lost their time (each fifth), loaded twice with all others: every id once."""
    inp = Inputs(spark, sf)
    target = work_dir(spark, "facts")
    stg = staging.stg_transactions(inp.raw("transactions"), fx.AS_OF_1)
    stg = stg.withColumn("txn_time", F.when(F.col("transaction_id").cast("bigint") % 5 != 0, F.col("txn_time")))
    stg = cut_lineage(stg, "null-time")
    marts.facts_transactions(spark, stg.where("txn_time is null"), target, fx.AS_OF_1)
    for _ in range(2):
        fact = marts.facts_transactions(spark, stg, target, fx.AS_OF_2, allowed_lateness=dt.timedelta(days=3650))
    return fact.select("transaction_id", "txn_time", "load_timestamp")


# ------------------------------------------------------------------ scalar rules
def q_direction_rule(spark, sf):
    t = fx.transaction_rows(spark, sf)
    return t.select(F.col("id").alias("transaction_id"), "txn_type",
                    scalars.direction_of(F.col("txn_type")).alias("direction"))


def q_txn_description(spark, sf):
    t = fx.transaction_rows(spark, sf)
    return t.select(F.col("id").alias("transaction_id"),
                    scalars.describe_txn(F.col("txn_type"), F.col("amount"), F.lit("USD")).alias("txn_desc"))


def q_account_number(spark, sf):
    from bankflow.functions.sequence import account_numbers

    return account_numbers(fx.account_rows(spark, sf, 1).select(F.col("id").alias("account_id")), ["account_id"])


def q_account_number_batches(spark, sf):
    """All accounts in two batches against one stored mark."""
    from bankflow.functions.sequence import account_numbers

    acc, state = fx.account_rows(spark, sf, 1).select(F.col("id").alias("account_id")), work_dir(spark, "numbers")
    odd = F.col("account_id") % 3 == 1
    first = account_numbers(acc.where(odd), ["account_id"], state=state)
    return first.unionByName(account_numbers(acc.where(~odd), ["account_id"], state=state))


def q_as_view(spark, sf):
    """The current accounts as a view, counted through its name."""
    view = marts.as_view(marts.dim_accounts(Inputs(spark, sf).snapshot("accounts")).where("is_current"), "current_accounts")
    return view.groupBy("account_type").agg(F.count(F.lit(1)).alias("accounts"))


def q_round_down_money(spark, sf):
    ev = fx.table(spark, sf, "events").select("event_id", "value")
    return ev.select("event_id", scalars.round_down_cents(F.col("value") / 3).alias("amount"))


def q_apply_defaults(spark, sf):
    events = fx.customer_events(spark, sf, 0)
    k = F.get_json_object("value", "$.payload.after.id")
    k = F.coalesce(k, F.get_json_object("value", "$.after.id")).cast("bigint")
    v = F.col("value")
    v = F.when(k % 7 == 3, F.regexp_replace(v, '"status":"[A-Z]*",', "")).otherwise(v)
    v = F.when(k % 7 == 5, F.regexp_replace(v, '"status":"[A-Z]*"', '"status":null')).otherwise(v)
    v = F.when(k % 11 == 4, F.regexp_replace(v, '"created_at":(null|"[^"]*"),', "")).otherwise(v)
    raw = cdc.materialize_raw(events.select("topic", v.alias("value")))
    spec = {"cust_status": ("$.status", "string", F.lit("ACTIVE")),
            "created_at": ("$.created_at", "timestamp_ntz", F.lit(fx.AS_OF_1).cast("timestamp_ntz"))}
    out = scalars.apply_defaults(raw, spec)
    return out.select(F.try_variant_get("v", "$.id", "string").alias("customer_id"), "cust_status", "created_at")


def q_clean_text(spark, sf):
    c = fx.table(spark, sf, "customer")
    geo = fx.table(spark, sf, "nation")
    k = F.col("c_custkey")
    raw_phone = F.concat(F.lit("+1-555-"), F.lpad(k.cast("string"), 6, "0"), F.lit(" x"), (k % 1000).cast("string"))
    return c.join(geo, F.col("c_nationkey") == F.col("n_nationkey"), "left").select(
        k.alias("customer_id"),
        scalars.clean_address(F.concat_ws("\n", F.col("n_name"), F.col("c_mktsegment"))).alias("address"),
        scalars.cut(raw_phone, 20).alias("phone"),
        scalars.capitalize(F.col("c_mktsegment")).alias("segment"))


# ------------------------------------------------------------------ posting
def q_post_validate(spark, sf):
    v = posting.validate_requests(fx.requests(spark, sf), fx.opening_balances(spark, sf))
    return v.select("id", "reject_reason")


def q_post_decisions(spark, sf):
    return Inputs(spark, sf).posting().decisions.select("id", "accepted", "reject_reason", "balance_after")


def q_post_balance_after(spark, sf):
    d = Inputs(spark, sf).posting().decisions
    return d.where("accepted").select("id", "balance_after")


def q_ledger_entries(spark, sf):
    return Inputs(spark, sf).posting().ledger


def q_closing_balances(spark, sf):
    return Inputs(spark, sf).posting().closing


def q_post_hovering(spark, sf):
    """Every event as one request of one account that hovers near zero: deposit 5, withdraw 10 of 10."""
    e = fx.table(spark, sf, "events").select((F.col("event_id") + 1).alias("id"), F.col("ts").alias("created_at"))
    out = F.col("id") % 2 == 1
    req = e.select("id", F.lit(1).cast("bigint").alias("account_id"), F.lit(None).cast("bigint").alias("related_account_id"),
                   F.when(out, "WITHDRAWAL").otherwise("DEPOSIT").alias("txn_type"),
                   F.when(out, 10).otherwise(5).cast("decimal(18,2)").alias("amount"), "created_at")
    opening = e.agg(F.lit(1).cast("bigint").alias("account_id"), F.lit(10).cast("decimal(18,2)").alias("balance"))
    return posting.post_batch(opening, req).decisions.select("id", "accepted", "reject_reason", "balance_after")


def _faulty_ledger(ledger: DataFrame) -> DataFrame:
    """A ledger with faults: a leg lost per 97 transactions, a cent too much in one leg per 101."""
    t, leg = F.col("transaction_id"), F.col("id") % 2
    cent = F.when((t % 101 == 4) & (leg == 0), F.lit("0.01")).otherwise(F.lit("0.00")).cast("decimal(18,2)")
    return ledger.where((t % 97 != 3) | (leg != 1)).withColumn("amount", (F.col("amount") + cent).cast("decimal(18,2)"))


def q_ledger_balance_check(spark, sf):
    return posting.ledger_imbalances(_faulty_ledger(Inputs(spark, sf).posting().ledger))


def q_balance_reconcile(spark, sf):
    """The sound ledger against closing balances of which each 53rd account's is 1.00 too high."""
    p = Inputs(spark, sf).posting()
    wrong = F.when(F.col("account_id") % 53 == 2, 1).otherwise(0).cast("decimal(38,2)")
    closing = p.closing.withColumn("balance", (F.col("balance") + wrong).cast("decimal(38,2)"))
    return posting.reconcile(fx.opening_balances(spark, sf), p.ledger, closing)


def q_reject_report(spark, sf):
    return posting.reject_report(Inputs(spark, sf).posting().decisions)


# ------------------------------------------------------------------ data tests
def _stg_models(inp: Inputs, stored: bool = True) -> dict:
    """The staging models, each stored once for all its tests; not ``stored`` for a test that reads a model once."""
    inp.log_raw(tuple(S.TABLES))  # decode all four topics in one job
    models = {"stg_customers": inp.stg_customers(), "stg_accounts": inp.stg_accounts(),
              "stg_transactions": inp.stg_transactions("as_written"), "stg_ledger_entries": inp.stg_ledger()}
    return {name: cut_lineage(df, name) if stored else df for name, df in models.items()}


def _by_test(inp: Inputs, test: str) -> DataFrame:
    out = None
    for name, df in _stg_models(inp, stored=test == "accepted_values").items():       # it reads a model once per column
        spec = S.DATA_TESTS[name]
        if test == "accepted_values":       # values outside the lists, two different ones per column
            key = F.coalesce(F.col("id" if name == "stg_ledger_entries" else name[4:-1] + "_id").cast("bigint"), F.lit(0))
            for c in spec["accepted_values"]:
                df = df.withColumn(c, F.when(key % 43 == 1, F.concat(F.lit("ODD"), (key % 2).cast("string"))).otherwise(F.col(c)))
        if test == "not_null":
            r = quality.check_not_null(df, spec["not_null"], name)
        elif test == "unique":
            r = None
            for c in spec["unique"]:
                u = quality.check_unique(df, c, name)
                r = u if r is None else r.unionByName(u)
        else:
            r = None
            for c, values in spec["accepted_values"].items():
                a = quality.check_accepted(df, c, values, name)
                r = a if r is None else r.unionByName(a)
        out = r if out is None else out.unionByName(r)
    return out


def q_dq_not_null(spark, sf):
    return _by_test(Inputs(spark, sf), "not_null")


def q_dq_unique(spark, sf):
    return _by_test(Inputs(spark, sf), "unique")


def q_dq_accepted_values(spark, sf):
    return _by_test(Inputs(spark, sf), "accepted_values")


def _oltp(spark, sf) -> dict:
    """All rows of the OLTP tables with faults of every kind that the constraints look for."""
    k, many = F.col("id"), F.repeat(F.lit("x"), F.lit(300))
    bad = lambda cond, value, c: F.when(cond, value).otherwise(F.col(c)).alias(c)

    def faulty(df: DataFrame, faults: dict) -> DataFrame:
        return df.select(*[bad(*faults[c], c) if c in faults else F.col(c) for c in df.columns])

    def twice(df: DataFrame, every: int, rest: int) -> DataFrame:
        return df.unionByName(df.where(k % every == rest))

    null, odd = F.lit(None).cast("string"), F.lit("ODD")
    customers = faulty(fx.customer_rows(spark, sf, 0), {
        "email": (k % 41 == 3, null), "first_name": (k % 37 == 5, many), "status": (k % 43 == 1, odd)})
    accounts = faulty(fx.account_rows(spark, sf, 1), {
        "customer_id": (k % 59 == 4, -k - 1), "account_type": (k % 61 == 2, odd), "account_number": (k % 67 == 3, many),
        "status": (k % 43 == 1, odd)})
    txn = faulty(fx.transaction_rows(spark, sf, faults=True), {
        "reference": (k % 73 == 6, many), "direction": (k % 79 == 5, odd), "status": (k % 89 == 6, odd), "txn_type": (k % 97 == 8, odd)})
    txn = cut_lineage(twice(txn, 83, 0), "oltp-txn")
    ledger = posting.ledger_legs(fx.transaction_rows(spark, sf, faults=True).select(
        "id", "account_id", "related_account_id", "txn_type", "amount", "created_at"))
    ledger = faulty(ledger, {"entry_type": (k % 71 == 2, F.lit("ODD ENTRY TYPE")), "transaction_id": (k % 101 == 9, -k)})
    return {"customers": cut_lineage(twice(customers, 50, 7), "oltp-cust"), "accounts": cut_lineage(twice(accounts, 71, 0), "oltp-acct"),
            "transactions": txn, "ledger_entries": cut_lineage(twice(ledger, 91, 1), "oltp-ledger")}


def q_dq_check(spark, sf):
    t = _oltp(spark, sf)
    c = F.col
    out = quality.check_expr(t["customers"], {"status_in": c("status").isin(*S.CUSTOMER_STATUS)}, "customers")
    out = out.unionByName(quality.check_expr(t["accounts"], {
        "account_type_in": c("account_type").isin(*S.ACCOUNT_TYPES),
        "status_in": c("status").isin(*S.ACCOUNT_STATUS)}, "accounts"))
    out = out.unionByName(quality.check_expr(t["transactions"], {
        "txn_type_in": c("txn_type").isin(*S.TXN_TYPES),
        "direction_in": c("direction").isin(*S.DIRECTIONS),
        "amount_positive": c("amount") > 0,
        "status_in": c("status").isin(*S.TXN_STATUS)}, "transactions"))
    return out.unionByName(quality.check_expr(t["ledger_entries"], {
        "entry_type_in": c("entry_type").isin(*S.ENTRY_TYPES), "amount_positive": c("amount") > 0},
        "ledger_entries"))


def q_dq_conditional_check(spark, sf):
    t = _oltp(spark, sf)["transactions"]
    cond = (F.col("txn_type") != "TRANSFER") | F.col("related_account_id").isNotNull()
    return quality.check_expr(t, {"transfer_has_destination": cond}, "transactions")


def q_dq_primary_key(spark, sf):
    t = _oltp(spark, sf)
    out = quality.check_key(t["customers"], ["id"], "customers")
    out = out.unionByName(quality.check_key(t["customers"], ["email"], "customers"))
    out = out.unionByName(quality.check_key(t["accounts"], ["id"], "accounts"))
    out = out.unionByName(quality.check_key(t["accounts"], ["account_number"], "accounts"))
    out = out.unionByName(quality.check_key(t["transactions"], ["id"], "transactions"))
    return out.unionByName(quality.check_key(t["ledger_entries"], ["id"], "ledger_entries"))


def q_dq_foreign_key(spark, sf):
    t = _oltp(spark, sf)
    out = quality.check_fk(t["accounts"], "customer_id", t["customers"], "id", "accounts")
    out = out.unionByName(quality.check_fk(t["transactions"], "account_id", t["accounts"], "id", "transactions"))
    out = out.unionByName(quality.check_fk(t["transactions"], "related_account_id", t["accounts"], "id",
                                           "transactions"))
    out = out.unionByName(quality.check_fk(t["ledger_entries"], "transaction_id", t["transactions"], "id",
                                           "ledger_entries"))
    return out.unionByName(quality.check_fk(t["ledger_entries"], "account_id", t["accounts"], "id",
                                            "ledger_entries"))


def q_dq_length(spark, sf):
    t = _oltp(spark, sf)
    out = None
    for name, df in t.items():
        limits = quality.table_limits(name, df.columns)
        if limits:
            r = quality.check_length(df, limits, name)
            out = r if out is None else out.unionByName(r)
    return out


def q_dq_suite_staging(spark, sf):
    return quality.run_suite(_stg_models(Inputs(spark, sf)), "staging")


def q_dq_suite_analytics(spark, sf):
    inp = Inputs(spark, sf)
    models = {"facts_transactions": _fact_out(inp.facts_two_runs()), "dim_customers": cut_lineage(inp.dim_customers(), "dim"),
              "dim_accounts": cut_lineage(inp.dim_accounts(), "dim")}
    return quality.run_suite(models, "analytics")


# ------------------------------------------------------------------ KPIs
def q_kpi_total_balance(spark, sf):
    return kpis.total_balance(Inputs(spark, sf).dim_accounts())


def q_kpi_total_transactions(spark, sf):
    return kpis.total_transactions(Inputs(spark, sf).facts_full())


def q_kpi_avg_balance(spark, sf):
    return kpis.avg_balance(Inputs(spark, sf).dim_accounts())


def q_kpi_total_accounts(spark, sf):
    return kpis.total_accounts(Inputs(spark, sf).dim_accounts())


def q_kpi_total_customers(spark, sf):
    return kpis.total_customers(Inputs(spark, sf).dim_customers())


def q_kpi_amount_over_time(spark, sf):
    return kpis.amount_over_time(Inputs(spark, sf).facts_full())


def q_kpi_avg_balance_by_type(spark, sf):
    return kpis.avg_balance_by_type(Inputs(spark, sf).dim_accounts())


def q_kpi_amount_by_txn_type(spark, sf):
    return kpis.amount_by_txn_type(Inputs(spark, sf).facts_full())


def q_kpi_customer_balance(spark, sf):
    inp = Inputs(spark, sf)
    return kpis.customer_balance(inp.dim_customers(), inp.dim_accounts())


# ------------------------------------------------------------------ streaming
def _event_files(inp: Inputs, events: DataFrame, form: str = "json") -> str:
    """Write an event log as files: the arrivals a file stream will pick up."""
    path = work_dir(inp.spark, "event-files")
    events.write.format(form).option("parquet.block.size", 1 << 20).save(path)
    return path


def _stream_landed(inp: Inputs) -> str:
    """The change log as files of (topic, value) records, landed by a stream, a file at a time. Parquet: as JSON lines the log is
    twelve times as large, and compressed ones cannot be read in parts. Row groups are small, so that a file has parts for all cores."""
    log = _event_files(inp, inp.log_events(), "parquet")
    base = work_dir(inp.spark, "stream-landing")
    jobs.run_landing(inp.spark, log, base, work_dir(inp.spark, "stream-ckpt"), {"maxFilesPerTrigger": "1", "format": "parquet"})
    return base


def _arrivals(spark: SparkSession, parts: list[DataFrame], spread_by) -> str:
    """Append each part (a day or a week of raw rows) as its own set of files, in
    time order, so a file stream sees them in that order. Rows are spread over
    tasks by ``spread_by`` (both images of a transaction stay in one file)."""
    path = work_dir(spark, "arrivals")
    for part in parts:
        part.repartition(spread_by).write.mode("append").parquet(path)
    return path


def q_stream_landing(spark, sf):
    df = landing.upserts(spark.read.parquet(_stream_landed(Inputs(spark, sf))))
    return df.select("table_name", F.col("_seq").alias("seq"), _row_id("v").alias("row_id"))


def q_stream_raw(spark, sf):
    base = _stream_landed(Inputs(spark, sf))
    raw_base = work_dir(spark, "stream-raw")
    landing.load_raw(spark, base, raw_base, work_dir(spark, "raw-ckpt"))
    r = landing.raw_rows(spark, raw_base)
    return r.select("table_name", F.col("_seq").alias("seq"), F.col("_ts_ms").alias("ts_ms"),
                    _row_id("v").alias("row_id"))


STREAM_LATENESS = dt.timedelta(days=8)


def _weekly_facts(spark, sf, times=1, **how):
    """The fact from a stream of raw transactions, each week's files delivered ``times`` times."""
    inp = Inputs(spark, sf)
    raw = inp.raw("transactions").withColumn("_week", F.floor((F.col("_ts_ms") - fx.DAY1_MS) / (7 * 86400000)))
    staged, path = work_dir(spark, "weeks"), work_dir(spark, "arrivals")
    raw.repartition("_week", F.pmod(F.try_variant_get("v", "$.id", "bigint"), F.lit(4))).write.partitionBy("_week").parquet(staged)
    weeks = range(*raw.agg(F.min("_week"), F.max("_week") + 1).first())
    for w in weeks:                                     # files in the order in which they would arrive
        week = spark.read.parquet(staged).where(F.col("_week") == w).drop("_week")
        delivered = functools.reduce(DataFrame.unionByName, [week] * times)
        delivered.write.mode("append").option("parquet.block.size", 1 << 22).parquet(path)      # small row groups: a file has parts for all cores
    stream = spark.readStream.schema(spark.read.parquet(path).schema).option("maxFilesPerTrigger", "8") \
        .parquet(path)
    target = work_dir(spark, "stream-facts")
    jobs.run_facts(spark, stream, target, work_dir(spark, "facts-ckpt"), fx.AS_OF_2,
                   allowed_lateness=STREAM_LATENESS, **how)
    return _fact_out(marts.read_target(spark, target))


def q_stream_facts(spark, sf):
    """Raw transactions arrive in files by week; each micro-batch is loaded into the fact.
    A week may span micro-batches, so the load admits 8 days of lateness (ids
    already loaded are still skipped): every transaction is loaded once."""
    return _weekly_facts(spark, sf)


def q_stream_facts_repeats(spark, sf):
    """The same stream from a source that delivers every file twice; repeated images are taken out ahead of the load, by state that
    the lateness bounds."""
    return _weekly_facts(spark, sf, times=2, drop_repeats=True)


def q_stream_facts_second_checkpoint(spark, sf):
    """The strict rule through two streams: what run 1 sees comes by one checkpoint, then all raw rows by a new one. Late rows stay out, as in
    two batch runs: the second stream's first batch starts from what the first stream has loaded."""
    inp, target = Inputs(spark, sf), work_dir(spark, "stream-facts")
    for rows, as_of in ((inp.txn_raw_run1(), fx.AS_OF_1), (inp.raw("transactions"), fx.AS_OF_2)):
        path = work_dir(spark, "arrivals")
        rows.write.parquet(path)
        jobs.run_facts(spark, spark.readStream.schema(rows.schema).parquet(path), target, work_dir(spark, "facts-ckpt"), as_of)
    return _fact_out(marts.read_target(spark, target))


POSTING_BATCHES = 3


def q_stream_posting(spark, sf):
    """All requests in micro-batches, cut by id, against published balances; the last batch comes twice."""
    inp, root, path = Inputs(spark, sf), work_dir(spark, "books"), work_dir(spark, "arrivals")
    posting.open_accounts(spark, root, fx.opening_balances(spark, sf))
    requests = cut_lineage(fx.requests(inp.spark, sf), "requests")
    least, most = requests.agg(F.min("id"), F.max("id")).first()
    size = (most - least) // POSTING_BATCHES + 1
    for n in range(POSTING_BATCHES):                     # files in the order in which they would arrive
        requests.where((F.col("id") >= least + n * size) & (F.col("id") < least + (n + 1) * size)).coalesce(1).write.mode("append").parquet(path)
    stream = spark.readStream.schema(requests.schema).option("maxFilesPerTrigger", "1").parquet(path)
    ckpt = work_dir(spark, "posting-ckpt")
    jobs.run_posting(spark, stream, root, ckpt)
    posting.post_stream_batch(spark, root, requests.where(F.col("id") >= least + (POSTING_BATCHES - 1) * size), (jobs.stream_id(spark, ckpt), POSTING_BATCHES - 1))
    return posting.read_books(spark, root).decisions.select("id", "accepted", "reject_reason", "balance_after")


def q_stream_scd2(spark, sf):
    """Customer images arrive day by day (one file per micro-batch); each batch is one snapshot step."""
    inp = Inputs(spark, sf)
    days = [inp.customer_day_raw(d).drop("_file") for d in (1, 2)]
    path = _arrivals(spark, days, F.try_variant_get("v", "$.id", "bigint"))
    stream = spark.readStream.schema(spark.read.parquet(path).schema).option("maxFilesPerTrigger", "1") \
        .parquet(path)
    root = work_dir(spark, "stream-snap")
    jobs.run_scd2(spark, stream, root, work_dir(spark, "scd2-ckpt"))
    snap = snapshots.read_snapshot(spark, root)     # the day of a version; its time follows from the batch
    return snap.select(*[c for c in S.STG_CUSTOMERS_COLS if c != "load_timestamp"],
                       F.to_date("dbt_valid_from").alias("valid_from"), F.to_date("dbt_valid_to").alias("valid_to"))


# ------------------------------------------------------------------ runs
def _two_days(spark, sf) -> list[DataFrame]:
    """The change log, cut at the second day's start by capture time."""
    log = fx.change_log(spark, sf, times=True)        # with the time of each record, as a broker keeps it
    path = work_dir(spark, "events")
    log.select("topic", "value", (F.col("ts_ms") >= fx.DAY2_MS).alias("second")).write.partitionBy("second").parquet(path)
    days = spark.read.schema("topic string, value string, second boolean").parquet(path)
    return [days.where(~F.col("second")).drop("second"), days.where(F.col("second")).drop("second")]


class Paths:
    """Where a pipeline keeps its state."""

    def __init__(self, spark):
        self.base, self.raw, self.checkpoint, self.root = (work_dir(spark, n) for n in ("landing", "raw", "raw-ckpt", "transform"))


def q_ingest_run(spark, sf):
    from bankflow.plans.runs import run_ingest

    p = Paths(spark)
    return run_ingest(spark, fx.change_log(spark, sf), p.base, p.raw, p.checkpoint, "only")


def q_ingest_two_days(spark, sf):
    """Two runs on the same paths; the second one's report."""
    from bankflow.plans.runs import run_ingest

    p = Paths(spark)
    for n, events in enumerate(_two_days(spark, sf)):
        report = run_ingest(spark, events, p.base, p.raw, p.checkpoint, f"run{n}")
    return report


def q_transform_run(spark, sf):
    from bankflow.plans.runs import run_transform

    inp = Inputs(spark, sf)
    inp.log_raw(tuple(S.TABLES))  # decode all four topics in one job
    return run_transform(spark, {t: inp.raw(t) for t in S.TABLES}, fx.AS_OF_2, Paths(spark).root)


def q_pipeline_e2e(spark, sf):
    """From events to a KPI over two days: landing, raw, staging, snapshots, facts, dimensions, balances."""
    from bankflow.plans.runs import run_ingest, run_transform

    p = Paths(spark)
    for n, (events, as_of) in enumerate(zip(_two_days(spark, sf), (fx.AS_OF_1, fx.AS_OF_2))):
        run_ingest(spark, events, p.base, p.raw, p.checkpoint, f"run{n}")
        run_transform(spark, p.raw, as_of, p.root)
    dims = [spark.read.parquet(f"{p.root}/{d}") for d in ("dim_customers", "dim_accounts")]
    fact = marts.read_target(spark, f"{p.root}/facts_transactions")
    return kpis.customer_balance(*dims).withColumn("transactions", F.lit(fact.count()).cast("bigint"))


def _by_load(spark, sf, name):
    """Where a staging model lies after two days, each of which took that day's load only."""
    p = Paths(spark)
    for n, (events, as_of) in enumerate(zip(_two_days(spark, sf), (fx.AS_OF_1, fx.AS_OF_2))):
        landing.write_landing(cdc.decode(events), p.base)
        landing.load_raw(spark, p.base, p.raw, p.checkpoint, run=f"run{n}")
        images.take_loads(spark, p.raw, p.root, name, as_of)
    return p.root


def q_stg_accounts_by_load(spark, sf):
    return images.read_model(spark, _by_load(spark, sf, "stg_accounts"), "stg_accounts")


def q_stg_transactions_by_load(spark, sf):
    return images.read_model(spark, _by_load(spark, sf, "stg_transactions"), "stg_transactions")


def q_dq_transactions_by_load(spark, sf):
    """The tests of all transactions, from what two days kept of their own loads."""
    return images.kept(spark, _by_load(spark, sf, "stg_transactions"), "stg_transactions")[1]


QUERIES = {name[2:]: fn for name, fn in sorted(globals().items()) if name.startswith("q_") and callable(fn)}
