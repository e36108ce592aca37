"""Analytics models: SCD2 dimensions and the incremental transaction fact."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bankflow.operators.published import Keyed, Published, State
from bankflow.schemas import DIM_ACCOUNTS_COLS, DIM_CUSTOMERS_COLS, STG_TRANSACTIONS_COLS
from bankflow.session import cut_lineage, drops_own_work
from bankflow.sources import landing


def _dim(snapshot: DataFrame, cols: list[str]) -> DataFrame:
    return snapshot.select(
        *cols,
        F.col("dbt_valid_from").alias("effective_from"),
        F.col("dbt_valid_to").alias("effective_to"),
        F.col("dbt_valid_to").isNull().alias("is_current"),
    )


def dim_customers(snapshot: DataFrame) -> DataFrame:
    return _dim(snapshot, DIM_CUSTOMERS_COLS)


def dim_accounts(snapshot: DataFrame) -> DataFrame:
    """As the snapshot, without ``interest_rate``."""
    return _dim(snapshot, DIM_ACCOUNTS_COLS)


def as_table(df: DataFrame, path: str) -> DataFrame:
    """Full-rebuild materialization."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def as_view(df: DataFrame, name: str) -> DataFrame:
    """View materialization: recomputed on every read."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


# ------------------------------------------------------------------ incremental fact
FACT_SCHEMA = (", ".join(f"{c} {'double' if c == 'amount' else 'timestamp_ntz' if c in ('txn_time', 'load_timestamp') else 'string'}"
                         for c in STG_TRANSACTIONS_COLS) + ", txn_date date")
FACTS, KEYS = "facts", "keys"      # kinds of segments: one of facts is a day of one load; keys say on which day an id's row lies
KEY_SCHEMA = "transaction_id string, txn_date date"
NO_DAY = "__HIVE_DEFAULT_PARTITION__"


def _rows_of(table: Published, state: State, segments: list[str] | None = None) -> DataFrame:
    rows = table.read(state, FACTS, FACT_SCHEMA, segments)
    return table.spark.createDataFrame([], FACT_SCHEMA) if rows is None else rows


def read_target(spark: SparkSession, path: str) -> DataFrame | None:
    """The loaded fact as of its latest version, or None if there is none. Later loads and upserts do not show in it."""
    table = Published(spark, path)
    state = table.state()
    return _rows_of(table, state) if state.version else None


def high_water(state: State) -> dt.datetime | None:
    """MAX(txn_time) of the loaded fact; None without a timed row. It stands in the version's list of segments: no row is read."""
    return max((dt.datetime.fromisoformat(s["max"]) for s in state.of(FACTS).values() if s["max"]), default=None)


def not_yet_loaded(stg: DataFrame, target: DataFrame, key: str = "transaction_id") -> DataFrame:
    """Rows whose key is not in the target (a NULL key is kept, as LEFT JOIN ... IS NULL does)."""
    return stg.join(target.select(key), key, "left_anti")


def lower_bound(mark, allowed_lateness: dt.timedelta | None = None):
    """Time that a row must be newer than to be admitted; None admits all."""
    return None if mark is None else mark - (allowed_lateness or dt.timedelta(0))


def admit(stg: DataFrame, lower) -> DataFrame:
    """Late-data rule: rows newer than the bound. A row without a time is neither late nor early: it is admitted, and
    its id decides whether it has been loaded."""
    if lower is None:
        return stg
    return stg.where(F.col("txn_time").isNull() | (F.col("txn_time") > F.lit(lower).cast("timestamp_ntz")))


def _with_partition(df: DataFrame) -> DataFrame:
    return df.withColumn("txn_date", F.to_date("txn_time"))


def _store(table: Published, rows: DataFrame, keyed: bool) -> dict[str, dict]:
    """Write fact rows (with ``txn_date``); a segment per day, with its rows and times. ``keyed``: whether the ids are in the index."""
    [path] = table.write(rows, FACTS, ["txn_date"])
    days = table.spark.read.schema(FACT_SCHEMA).parquet(f"{table.root}/{path}").groupBy("txn_date").agg(
        F.count(F.lit(1)).alias("rows"), F.min("txn_time").alias("min"), F.max("txn_time").alias("max")).collect()     # one row per day
    text = lambda t: None if t is None else t.isoformat()
    return {f"{path}/txn_date={r['txn_date'] or NO_DAY}": {"level": 0, "day": text(r["txn_date"]), "rows": r["rows"], "min": text(r["min"]), "max": text(r["max"]),
                                                           "keyed": keyed} for r in days}


def batch_mark(spark: SparkSession, target_path: str, batch: tuple[str, int]) -> dt.datetime | None:
    """The high-water mark that a micro-batch (stream id, batch id) started from. It is published before the batch writes anything, and a
    repeated batch takes the published one, whatever other writers have loaded since. Each stream has its own."""
    table, (stream, number) = Published(spark, target_path), batch
    state = table.state()
    begun = state.info.get("begun", {}).get(stream)
    if not begun or begun[0] != number:
        mark = high_water(state)
        begun = [number, None if mark is None else mark.isoformat()]
        table.publish(state, begun={stream: begun})
    return None if begun[1] is None else dt.datetime.fromisoformat(begun[1])


def _index(spark: SparkSession, path: str) -> tuple[Published, Keyed, State]:
    """The table with its key index after all loaded ids have entered it. Loads leave that to the next upsert, which indexes
    the segments that have come since the last one."""
    table = Published(spark, path)
    state = table.state()
    keys = Keyed(table, KEYS, "transaction_id", KEY_SCHEMA)
    new = [p for p, s in state.of(FACTS).items() if not s["keyed"]]
    if new:
        ids = _rows_of(table, state, new).where("transaction_id is not null").groupBy("transaction_id").agg(F.max("txn_date").alias("txn_date"))
        entries = keys.write(state, ids, sum(state.segments[p]["rows"] for p in new))
        state = table.publish(state, {**entries, **{p: {**state.segments[p], "keyed": True} for p in new}})
    return table, keys, keys.compact(state)


@drops_own_work
def facts_transactions(spark: SparkSession, stg: DataFrame, target_path: str, as_of, mode: str = "insert_only",
                       allowed_lateness: dt.timedelta | None = None, mark="newest", before_publish=None, **taken) -> DataFrame:
    """Load the transaction fact from staging; returns the whole fact afterwards.

    New ids come in if they are newer than the high-water mark less the allowed lateness (all of them into an empty
    fact). ``insert_only`` stops there (the reference's behaviour: the merge's update branch is unreachable). ``upsert``
    also replaces every loaded row whose id the batch holds, whatever its time: the key index says on which days these lie, and the
    segments of those days (and of the batch's) are written anew. ``mark`` is the high-water mark, by default that of the loaded rows.

    Readers see the load at once, with the version that it publishes last; ``before_publish`` is called just before (for tests of a writer
    that dies there). ``taken`` enters the version: ``loads`` and ``streams``."""
    if mode not in ("insert_only", "upsert"):
        raise ValueError(f"unknown mode {mode!r}")
    rows = _with_partition(stg.select(*[c for c in STG_TRANSACTIONS_COLS if c != "load_timestamp"]).withColumn(
        "load_timestamp", F.lit(as_of).cast("timestamp_ntz"))).select(*STG_TRANSACTIONS_COLS, "txn_date")
    table = Published(spark, target_path)
    state = table.state()
    gone: list[str] = []
    if not state.of(FACTS):
        added = _store(table, rows, keyed=False)
    elif mode == "insert_only":
        lower = lower_bound(high_water(state) if mark == "newest" else mark, allowed_lateness)
        # only segments from the bound's day on, and those of rows without a time, can hold a row of this batch
        reach = [p for p, s in state.of(FACTS).items() if lower is None or s["day"] is None or s["day"] >= lower.date().isoformat()]
        added = _store(table, not_yet_loaded(admit(rows, lower), _rows_of(table, state, reach)), keyed=False)
    else:
        lower = lower_bound(high_water(state) if mark == "newest" else mark, allowed_lateness)
        table, keys, state = _index(spark, target_path)
        rows = cut_lineage(rows, "facts-batch")
        ids = rows.select("transaction_id")
        known = keys.read(state, keys.buckets_of(state, rows.where("transaction_id is not null")))
        known = cut_lineage(known.join(ids, "transaction_id", "left_semi"), "facts-loaded")
        batch = cut_lineage(rows.join(known, "transaction_id", "left_semi").unionByName(admit(not_yet_loaded(rows, known), lower)), "facts-new")
        days = {None if r[0] is None else r[0].isoformat() for r in known.select("txn_date").union(batch.select("txn_date")).distinct().collect()}   # one per day
        gone = [p for p, s in state.of(FACTS).items() if s["day"] in days]
        kept = _rows_of(table, state, gone).join(ids, "transaction_id", "left_anti")
        added = _store(table, kept.unionByName(batch).hint("rebalance", "txn_date"), keyed=True)
        moved = batch.where("transaction_id is not null").select("transaction_id", "txn_date").dropDuplicates(["transaction_id"])
        added |= keys.write(state, moved, moved.count())
    if before_publish is not None:
        before_publish()
    table.publish(state, added, gone, **taken)
    return read_target(spark, target_path)


def facts_from_raw(spark: SparkSession, raw: DataFrame | str, target_path: str, as_of, allowed_lateness: dt.timedelta | None = None,
                   batch: tuple[str, int] | None = None, mode: str = "insert_only") -> DataFrame:
    """The load straight from raw: rows, or the raw table's path, of which the loads that the fact has not taken yet are read, whatever the
    times in them, and nothing else. What has been taken is published with the rows, so a writer that dies takes the
    same loads again.

    A transaction's time never changes, so the bound is applied to the flattened rows before the latest image per id is
    taken. ``batch`` (stream id, batch id) names a micro-batch: it is loaded once, from the mark that it first started from."""
    from bankflow.operators.staging import stg_transactions

    state, taken = Published(spark, target_path).state(), {}
    if isinstance(raw, str):
        loads = [n for n in landing.loads(spark, raw) if n not in set(state.info.get("loads", []))]
        if not loads and state.version:
            return read_target(spark, target_path)
        raw, taken["loads"] = landing.raw(spark, raw, "transactions", loads), loads
    if batch is not None:
        if state.batch_done(*batch):
            return read_target(spark, target_path)
        mark, taken["streams"] = batch_mark(spark, target_path, batch), {batch[0]: batch[1]}
    else:
        mark = high_water(state)
    newer_than = lower_bound(mark, allowed_lateness) if mode == "insert_only" else None      # an upsert replaces rows of any time
    return facts_transactions(spark, stg_transactions(raw, as_of, newer_than=newer_than), target_path, as_of, mode, allowed_lateness, mark, **taken)
