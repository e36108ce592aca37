"""Banking rows and change events derived from the driver tables (FIXTURES.md §2).

Every fixture is a DataFrame computed by Spark from ``customer``, ``nation``,
``region`` and ``events``, so its size grows with the input. Money is built in
whole cents and divided once; never from float arithmetic.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bankflow.functions.scalars import describe_txn, direction_of
from bankflow.schemas import ACCOUNT_NUMBER_PREFIX, ACCOUNT_NUMBER_START, DEFAULT_CURRENCY, TOPIC_PREFIX

DAY1 = "2024-01-01 00:00:00"
DAY2 = "2024-01-02 00:00:00"
DAY1_MS = 1704067200000
DAY2_MS = 1704153600000
# as_of times of the two SCD2 / incremental runs.
AS_OF_1 = "2024-01-02 00:00:00"
AS_OF_2 = "2024-01-03 00:00:00"
# Incremental run 1 sees events before this time (minus the withheld ones).
RUN1_CUTOFF = "2024-01-16 00:00:00"
ISO = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(rows: DataFrame) -> DataFrame:
    """The same rows dealt over all cores by their content: a table of short rows is one small file that few tasks could read, while what is
    built of a row (images, envelopes) takes far longer than reading it. Small tables stay in few partitions (AQE)."""
    return rows.repartition(*rows.columns)


def ts(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def iso(c: Column) -> Column:
    """Wire form of a timestamp: ISO text with microseconds."""
    return F.date_format(c, ISO)


def epoch_ms(c: Column) -> Column:
    return F.timestamp_diff("MILLISECOND", ts("1970-01-01 00:00:00"), c)


def _column_max(spark: SparkSession, sf_dir: str, name: str, col: str) -> int:
    """MAX(col) of a driver table as a literal (one value)."""
    return int(table(spark, sf_dir, name).agg(F.max(col)).first()[0])


def customer_count(spark: SparkSession, sf_dir: str) -> int:
    return _column_max(spark, sf_dir, "customer", "c_custkey") + 1


def user_count(spark: SparkSession, sf_dir: str) -> int:
    return _column_max(spark, sf_dir, "events", "user_id") + 1


# ---------------------------------------------------------------- customers
def customer_rows(spark: SparkSession, sf_dir: str, day: int = 0) -> DataFrame:
    """OLTP customer rows. day 0: every key at its first values; 1: day-1 keys; 2: state after day 2."""
    c = spread(table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment"))
    geo = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"), "left"
    ).select("n_nationkey", F.concat_ws(", ", "n_name", "r_name").alias("address"))
    k = F.col("c_custkey")
    first = F.substring_index("c_name", "#", 1)
    last = F.substring_index("c_name", "#", -1)
    created = F.when(k % 97 == 0, F.lit(None).cast("timestamp_ntz")).otherwise(
        F.timestamp_add("SECOND", k, ts(DAY1)))
    rows = c.join(geo, F.col("c_nationkey") == F.col("n_nationkey"), "left").select(
        k.alias("id"),
        first.alias("first_name"),
        last.alias("last_name"),
        F.concat(F.lower(first), F.lit("."), last, F.lit("@example.com")).alias("email"),
        F.when(k % 13 == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("555-"), F.lpad((k % 10000).cast("string"), 4, "0"))).alias("phone"),
        F.when(k % 2 == 0, (k % 10000).cast("int")).alias("date_of_birth"),
        F.col("address"),
        F.when(F.col("c_mktsegment") == "MACHINERY", "INACTIVE")
         .when(F.col("c_mktsegment") == "FURNITURE", "SUSPENDED").otherwise("ACTIVE").alias("status"),
        created.alias("created_at"),
        created.alias("updated_at"),
    )
    if day == 0:
        return rows
    n = customer_count(spark, sf_dir)
    cutoff = n - n // 10
    if day == 1:
        return rows.where(F.col("id") < cutoff)
    old = F.col("id") < cutoff
    return rows.where(~(old & (F.col("id") % 10 == 7))).select(
        "id", "first_name", "last_name", "email",
        F.when(old & (F.col("id") % 10 == 0), F.lit("555-9999")).otherwise(F.col("phone")).alias("phone"),
        F.when(old & (F.col("id") % 10 == 5), F.lit(10957)).otherwise(F.col("date_of_birth")).alias("date_of_birth"),
        "address", "status", "created_at",
        F.when(old & (F.col("id") % 10 == 0), F.timestamp_add("SECOND", F.col("id"), ts(DAY2)))
         .otherwise(F.col("updated_at")).alias("updated_at"),
    )


CUSTOMER_FIELDS = ["id", "first_name", "last_name", "email", "phone", "date_of_birth", "address", "status",
                   "created_at", "updated_at"]


def _customer_struct(df: DataFrame) -> Column:
    return F.struct(*[iso(F.col(c)).alias(c) if c in ("created_at", "updated_at") else F.col(c)
                      for c in CUSTOMER_FIELDS])


def customer_events(spark: SparkSession, sf_dir: str, day: int = 0, second_images: bool = False) -> DataFrame:
    """Change events for customer rows; optionally a second image per key for k%4 in (1, 2).

    k%4=1: created_at + 1 hour but an *earlier* ts_ms (created_at decides);
    k%4=2: same created_at, address 'MOVED', later ts_ms (a tie decided by ts_ms).
    """
    rows = customer_rows(spark, sf_dir, day)
    base_ms = (DAY2_MS if day == 2 else DAY1_MS) + F.col("id") * 1000
    op = "r" if day == 2 else "c"
    events = envelopes(rows, "customers", _customer_struct(rows), F.lit(op), base_ms,
                       F.col("id") * 4 + (1 if day == 2 else 0))
    if not second_images:
        return events
    k = F.col("id")
    again = rows.where(k % 4 == 1).withColumn("created_at", F.timestamp_add("HOUR", F.lit(1), F.col("created_at")))
    moved = rows.where(k % 4 == 2).withColumn("address", F.lit("MOVED"))
    ev1 = envelopes(again, "customers", _customer_struct(again), F.lit("u"), base_ms - 1, k * 4 + 2)
    ev2 = envelopes(moved, "customers", _customer_struct(moved), F.lit("u"), base_ms + 1, k * 4 + 2)
    return events.unionByName(ev1).unionByName(ev2)


# ---------------------------------------------------------------- accounts
ACCOUNT_FIELDS = ["id", "account_number", "customer_id", "account_type", "status", "balance", "interest_rate",
                  "currency", "created_at"]


def account_rows(spark: SparkSession, sf_dir: str, day: int = 1) -> DataFrame:
    """Two accounts per customer (id = 2k+u); day 2 adds 100.00 to ids with id%6=0."""
    c = spread(table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal"))
    u = F.explode(F.array(F.lit(0), F.lit(1))).alias("u")
    acc = c.select("c_custkey", "c_acctbal", u)
    acc_id = F.col("c_custkey") * 2 + F.col("u")
    cents = F.round(F.abs(F.col("c_acctbal")) * 100).cast("bigint") / (F.lit(4) * (F.col("u") + 1))
    cents = F.floor(cents).cast("bigint")
    if day == 2:
        cents = cents + F.when(acc_id % 6 == 0, F.lit(10000)).otherwise(F.lit(0))
    acc_type = F.when(acc_id % 3 == 0, "SAVINGS").when(acc_id % 3 == 1, "CHECKING").otherwise("CREDIT")
    return acc.select(
        acc_id.alias("id"),
        F.concat(F.lit(ACCOUNT_NUMBER_PREFIX),
                 F.lpad((acc_id + ACCOUNT_NUMBER_START).cast("string"), 10, "0")).alias("account_number"),
        F.col("c_custkey").alias("customer_id"),
        acc_type.alias("account_type"),
        F.when(acc_id % 17 == 0, "CLOSED").when(acc_id % 19 == 0, "INACTIVE").otherwise("ACTIVE").alias("status"),
        (cents.cast("decimal(18,0)") / 100).cast("decimal(18,2)").alias("balance"),
        F.when(acc_type == "CHECKING", F.lit(None).cast("double"))
         .otherwise((acc_id % 5).cast("double") / 100).alias("interest_rate"),
        F.lit(DEFAULT_CURRENCY).alias("currency"),
        F.timestamp_add("SECOND", F.col("c_custkey"), ts(DAY1)).alias("created_at"),
    )


def _account_struct() -> Column:
    return F.struct(*[iso(F.col(c)).alias(c) if c == "created_at" else F.col(c) for c in ACCOUNT_FIELDS])


def account_events(spark: SparkSession, sf_dir: str, day: int = 1, times: bool = False) -> DataFrame:
    rows = account_rows(spark, sf_dir, day)
    k = F.col("customer_id")
    base_ms = (DAY2_MS if day == 2 else DAY1_MS) + k * 1000
    return envelopes(rows, "accounts", _account_struct(), F.lit("r" if day == 2 else "c"), base_ms,
                     F.col("id") * 2 + (1 if day == 2 else 0), times=times)


def opening_balances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Opening balances for posting: the day-1 accounts."""
    return account_rows(spark, sf_dir, 1).select(F.col("id").alias("account_id"), "balance")


# ---------------------------------------------------------------- transactions
TXN_FIELDS = ["id", "account_id", "related_account_id", "txn_type", "direction", "amount", "balance_after",
              "status", "reference", "description", "created_at", "posted_at"]


def transaction_rows(spark: SparkSession, sf_dir: str, faults: bool = False) -> DataFrame:
    """One transaction per event (id = e+1). ``faults`` injects the posting rejections."""
    m = user_count(spark, sf_dir)
    ev = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    e = F.col("event_id")
    txn_type = (F.when(F.col("event_type") == "purchase", "WITHDRAWAL")
                .when(F.col("event_type") == "click", "TRANSFER").otherwise("DEPOSIT"))
    account = F.col("user_id") * 2 + e % 2
    related = F.when(txn_type == "TRANSFER",
                     ((F.col("user_id") + 1 + e % 7) % m) * 2 + F.floor(e / 2).cast("bigint") % 2)
    cents = F.round(F.col("value") * 1000).cast("bigint")
    if faults:
        account = F.when(e % 211 == 5, F.lit(-1)).otherwise(account)
        related = F.when((txn_type == "TRANSFER") & (e % 223 == 7), F.lit(None).cast("bigint")).otherwise(related)
        cents = F.when(e % 307 == 11, F.lit(0)).otherwise(cents)
    status = (F.when(F.col("event_type") == "error", "FAILED").when(e % 101 == 0, "REVERSED")
              .when(e % 103 == 0, "PENDING").otherwise("COMPLETED"))
    amount = (cents.cast("decimal(18,0)") / 100).cast("decimal(18,2)")
    return ev.select(
        (e + 1).alias("id"),
        account.cast("bigint").alias("account_id"),
        related.cast("bigint").alias("related_account_id"),
        txn_type.alias("txn_type"),
        direction_of(txn_type).alias("direction"),
        amount.alias("amount"),
        cents.alias("cents"),
        status.alias("status"),
        F.concat(F.lit("EVT-"), e.cast("string")).alias("reference"),
        describe_txn(txn_type, amount, F.lit(DEFAULT_CURRENCY)).alias("description"),
        F.col("ts").alias("created_at"),
        F.col("ts").alias("posted_at"),
        e.alias("e"),
    )


def _txn_struct(balance_after: Column) -> Column:
    cols = []
    for c in TXN_FIELDS:
        if c == "balance_after":
            cols.append(balance_after.alias(c))
        elif c in ("created_at", "posted_at"):
            cols.append(iso(F.col(c)).alias(c))
        else:
            cols.append(F.col(c))
    return F.struct(*cols)


def transaction_events(rows: DataFrame, times: bool = False) -> DataFrame:
    """Two images per transaction: the insert (balance_after NULL) and the posting update."""
    ms = epoch_ms(F.col("created_at"))
    after = ((F.col("cents") + 100000).cast("decimal(18,0)") / 100).cast("decimal(18,2)")
    c_img = envelopes(rows, "transactions", _txn_struct(F.lit(None).cast("decimal(18,2)")), F.lit("c"), ms,
                      F.col("id") * 2, times=times)
    u_img = envelopes(rows, "transactions", _txn_struct(after), F.lit("u"), ms, F.col("id") * 2 + 1, times=times)
    return c_img.unionByName(u_img)


LEDGER_FIELDS = ["id", "transaction_id", "account_id", "entry_type", "amount", "created_at"]


def ledger_events(ledger: DataFrame, times: bool = False) -> DataFrame:
    body = F.struct(*[iso(F.col(c)).alias(c) if c == "created_at" else F.col(c) for c in LEDGER_FIELDS])
    return envelopes(ledger, "ledger_entries", body, F.lit("c"), epoch_ms(F.col("created_at")), F.col("id"), times=times)


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posting requests: transactions with faults injected."""
    return transaction_rows(spark, sf_dir, faults=True).select(
        "id", "account_id", "related_account_id", "txn_type", "amount", "created_at")


# ---------------------------------------------------------------- envelopes
def envelopes(rows: DataFrame, table_name: str, body: Column, op: Column, ts_ms: Column, seq: Column,
              delete: bool = False, times: bool = False) -> DataFrame:
    """Wrap row images as change events, in three envelope forms chosen by ``seq % 3``:
    ``{"payload": env}``, ``{"payload": null, ...env}`` and the bare ``env``. ``times``: with the time of each as a column of its own."""
    before = body if delete else F.lit(None).cast("string")
    after = F.lit(None).cast("string") if delete else body
    env = [before.alias("before"), after.alias("after"), op.alias("op"), ts_ms.alias("ts_ms"), seq.alias("seq")]
    # Serialise once, then wrap as text: repeating the struct per form would
    # triple the generated code.
    staged = rows.select(F.to_json(F.struct(*env), {"ignoreNullFields": "false"}).alias("_env"),
                         (seq % 3).alias("_form"), ts_ms.cast("bigint").alias("ts_ms"))
    body_json = F.col("_env")
    value = (F.when(F.col("_form") == 0, F.concat(F.lit('{"payload":'), body_json, F.lit("}")))
             .when(F.col("_form") == 1, F.concat(F.lit('{"payload":null,'), F.substring(body_json, 2, 1 << 30)))
             .otherwise(body_json))
    return staged.select(F.lit(TOPIC_PREFIX + table_name).alias("topic"), value.alias("value"), *(["ts_ms"] if times else []))


def change_log(spark: SparkSession, sf_dir: str, tables=("customers", "accounts", "transactions",
                                                       "ledger_entries"), times: bool = False) -> DataFrame:
    """The full change log of two days for the given topics; ``times``: with each event's ``ts_ms`` beside it.

    customers: day-1 inserts; day 2 inserts new keys, updates changed ones and
    deletes the k%10=7 ones. accounts: day-1 inserts, day-2 updates (id%6=0).
    transactions: insert + posting update. ledger_entries: two legs each.
    """
    from bankflow.operators.posting import ledger_legs

    parts = []
    if "customers" in tables:
        day1 = customer_rows(spark, sf_dir, 1)
        day2 = customer_rows(spark, sf_dir, 2)
        n = customer_count(spark, sf_dir)
        cutoff = n - n // 10
        k = F.col("id")
        parts.append(envelopes(day1, "customers", _customer_struct(day1), F.lit("c"), DAY1_MS + k * 1000, k * 4, times=times))
        changed = day2.where((k >= cutoff) | (k % 10 == 0) | (k % 10 == 5))
        op2 = F.when(k >= cutoff, F.lit("c")).otherwise(F.lit("u"))
        parts.append(envelopes(changed, "customers", _customer_struct(changed), op2, DAY2_MS + k * 1000,
                               k * 4 + 1, times=times))
        gone = day1.where(k % 10 == 7)
        parts.append(envelopes(gone, "customers", _customer_struct(gone), F.lit("d"), DAY2_MS + k * 1000,
                               k * 4 + 1, delete=True, times=times))
    if "accounts" in tables:
        parts.append(account_events(spark, sf_dir, 1, times))
        acc2 = account_rows(spark, sf_dir, 2).where(F.col("id") % 6 == 0)
        parts.append(envelopes(acc2, "accounts", _account_struct(), F.lit("u"),
                               DAY2_MS + F.col("customer_id") * 1000, F.col("id") * 2 + 1, times=times))
    if "transactions" in tables or "ledger_entries" in tables:
        txn = transaction_rows(spark, sf_dir)
        if "transactions" in tables:
            parts.append(transaction_events(txn, times))
        if "ledger_entries" in tables:
            parts.append(ledger_events(ledger_legs(txn.select("id", "account_id", "related_account_id",
                                                              "txn_type", "amount", "created_at")), times))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
