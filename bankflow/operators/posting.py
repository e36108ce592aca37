"""Posting: deposits, withdrawals and transfers as a double-entry ledger with funds checks.

The reference posts one row at a time inside the OLTP transaction. Here a
batch of id-ordered requests is posted at once and gives the same result as
that sequential fold:

    post_batch(opening, requests) -> Posting(decisions, ledger, closing)

Acceptance of a debit depends on every earlier accepted request that touched
its account, and transfers couple accounts, so no per-account or per-component
grouping is exact and bounded at once. Instead a fixpoint over "legs" (one row
per request and account touched) decides requests round by round:

* legs are range-partitioned once by (account, id); an account's legs in one
  partition are a bucket, so buckets hold rows, however sparse ids are, and an account
  with a third of all legs has many. Each leg is Accepted or Undecided;
* bucket totals, prefix-summed per account (one row per bucket), give two bounds
  on the balance at the start of each bucket: ``lo`` counts earlier undecided
  debits as accepted and undecided incoming transfers as absent, ``hi`` the reverse;
* one streaming pass goes through each bucket in id order and carries the bounds
  along: ``lo >= amount`` accepts, ``hi < amount`` rejects, else the debit waits a round. Stretches in
  which all are accepted are settled at once. Neighbouring buckets of an account are gone through as one run
  of up to ``LEGS_PER_RUN`` legs, from the bounds of its first.
  The decided prefix of a bucket is folded into one leg, and accounts with nothing
  undecided leave the working set.

It is sound (lo <= true balance <= hi) and always progresses. The bounds of an
account's first open run are equal, so all of it is settled in one pass as far
as no undecided incoming transfer stands in it: rounds follow the runs of the
hottest account and the chains of transfers between accounts, not the debits.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from bankflow.operators.published import Keyed, Published, State
from bankflow.session import cut_lineage, drops_own_work, work_dir

MONEY = "decimal(18,2)"
SUM_MONEY = "decimal(38,2)"
LEGS_PER_BUCKET = 1 << 18   # legs of a range partition, at which the first partitioning aims
LEGS_PER_RUN = 1 << 22      # legs of an account's neighbouring buckets that a round goes through in one pass

# Rejection reasons, in the order the OLTP database raises them: table CHECKs,
# then foreign keys, then the posting trigger.
AMOUNT_NOT_POSITIVE = "AMOUNT_NOT_POSITIVE"
MISSING_DESTINATION = "MISSING_DESTINATION"
UNSUPPORTED_TYPE = "UNSUPPORTED_TYPE"
UNKNOWN_ACCOUNT = "UNKNOWN_ACCOUNT"
UNKNOWN_DESTINATION = "UNKNOWN_DESTINATION"
NULL_BALANCE = "NULL_BALANCE"
INSUFFICIENT_FUNDS = "INSUFFICIENT_FUNDS"

DEBIT_TYPES = ("WITHDRAWAL", "TRANSFER")


@dataclass
class Posting:
    decisions: DataFrame   # id, account_id, txn_type, amount, accepted, reject_reason, balance_after
    ledger: DataFrame      # id, transaction_id, account_id, entry_type, amount, created_at
    closing: DataFrame     # account_id, balance
    rounds: int


# ------------------------------------------------------------------ L1
def validate_requests(requests: DataFrame, accounts: DataFrame) -> DataFrame:
    """Static checks (everything but funds): adds ``reject_reason`` (NULL = valid so far)."""
    acc = accounts.select(F.col("account_id").alias("_acc"), F.col("balance").alias("_src_balance"),
                          F.lit(True).alias("_src_known"))
    dst = accounts.select(F.col("account_id").alias("_dst"), F.lit(True).alias("_dst_known"))
    r = (requests.join(acc, requests["account_id"] == acc["_acc"], "left")
         .join(dst, requests["related_account_id"] == dst["_dst"], "left"))
    t = F.col("txn_type")
    reason = (F.when(F.col("amount").isNull() | (F.col("amount") <= 0), F.lit(AMOUNT_NOT_POSITIVE))
              .when((t == "TRANSFER") & F.col("related_account_id").isNull(), F.lit(MISSING_DESTINATION))
              .when(t.isNull() | ~t.isin("DEPOSIT", *DEBIT_TYPES), F.lit(UNSUPPORTED_TYPE))
              .when(F.col("_src_known").isNull(), F.lit(UNKNOWN_ACCOUNT))
              .when(F.col("related_account_id").isNotNull() & F.col("_dst_known").isNull(),
                    F.lit(UNKNOWN_DESTINATION))
              .when(t.isin(*DEBIT_TYPES) & F.col("_src_balance").isNull(), F.lit(NULL_BALANCE)))
    return r.select(*requests.columns, reason.alias("reject_reason"))


# ------------------------------------------------------------------ L3 / L5
def movements(accepted: DataFrame) -> DataFrame:
    """Balance legs of requests: (id, leg, account_id, delta). Leg 0 is the request's own account."""
    t = F.col("txn_type")
    a = F.col("amount").cast(MONEY)
    legs = F.when(t == "DEPOSIT", F.array(F.struct(F.lit(0).alias("leg"), F.col("account_id").alias("acct"),
                                                    a.alias("delta"))))
    legs = legs.when(t == "WITHDRAWAL", F.array(F.struct(F.lit(0).alias("leg"), F.col("account_id").alias("acct"),
                                                         (-a).alias("delta"))))
    legs = legs.when(t == "TRANSFER", F.array(
        F.struct(F.lit(0).alias("leg"), F.col("account_id").alias("acct"), (-a).alias("delta")),
        F.struct(F.lit(1).alias("leg"), F.col("related_account_id").alias("acct"), a.alias("delta"))))
    return (accepted.select("id", "txn_type", "amount", F.explode(legs).alias("l"))
            .select("id", F.col("l.leg").alias("leg"), F.col("l.acct").alias("account_id"),
                    F.col("l.delta").cast(MONEY).alias("delta"), "txn_type", "amount"))


def ledger_legs(accepted: DataFrame) -> DataFrame:
    """Double entry, two rows per transaction (id = 2*transaction_id + leg).

    DEPOSIT: account DEBIT, external CREDIT. WITHDRAWAL: account CREDIT,
    external DEBIT. TRANSFER: source CREDIT, destination DEBIT. External = NULL account.
    """
    t = F.col("txn_type")
    null_acct = F.lit(None).cast("bigint")
    own, other = F.col("account_id").cast("bigint"), F.col("related_account_id").cast("bigint")
    first_type = F.when(t == "DEPOSIT", F.lit("DEBIT")).otherwise(F.lit("CREDIT"))
    second_type = F.when(t == "DEPOSIT", F.lit("CREDIT")).otherwise(F.lit("DEBIT"))
    second_acct = F.when(t == "TRANSFER", other).otherwise(null_acct)
    legs = F.array(
        F.struct(F.lit(0).alias("leg"), own.alias("acct"), first_type.alias("entry_type")),
        F.struct(F.lit(1).alias("leg"), second_acct.alias("acct"), second_type.alias("entry_type")))
    return (accepted.where(t.isin("DEPOSIT", *DEBIT_TYPES))
            .select("id", "amount", "created_at", F.explode(legs).alias("l"))
            .select((F.col("id") * 2 + F.col("l.leg")).alias("id"), F.col("id").alias("transaction_id"),
                    F.col("l.acct").alias("account_id"), F.col("l.entry_type").alias("entry_type"),
                    F.col("amount").cast(MONEY).alias("amount"), "created_at"))


# ------------------------------------------------------------------ W3: two-level prefix sums
def bucketed(df: DataFrame, key: str, order: str, partitions: int | None = None) -> DataFrame:
    """Store ``df`` with a ``bucket``: rows are range-partitioned by (key, order), and the rows of a key in one partition
    are a bucket. Equal (key, order) share a bucket; a key of any size is spread over as many as it needs."""
    by = [F.col(key).asc_nulls_first(), F.col(order)]
    if partitions is None:
        partitions = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), df.count() // LEGS_PER_BUCKET + 1)
    return cut_lineage(df.repartitionByRange(partitions, *by).withColumn("bucket", F.spark_partition_id()), "bucketed")


def prefix_sums(df: DataFrame, key: str, cols: list[str], inclusive_same_id: bool = False) -> DataFrame:
    """Per ``key``, sums of ``cols`` over the rows before each row in (id, leg) order.

    ``inclusive_same_id=True`` sums every row with id <= this id instead (the
    state after this request). ``df`` is ``bucketed``: totals per (key, bucket) are
    prefix-summed per key (one row per bucket), and the row-level window is
    partitioned by (key, bucket), so no task holds more than one bucket of one key.
    """
    order = ["id"] if inclusive_same_id else ["id", "leg"]
    zero = F.lit(0)
    totals = df.groupBy(key, "bucket").agg(*[F.sum(c).alias(c) for c in cols])
    wb = Window.partitionBy(key).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    bucket_prefix = totals.select(key, "bucket", *[F.sum(c).over(wb).alias("_bp_" + c) for c in cols])
    wi = Window.partitionBy(key, "bucket").orderBy(*order)
    wi = wi.rangeBetween(Window.unboundedPreceding, Window.currentRow) if inclusive_same_id \
        else wi.rowsBetween(Window.unboundedPreceding, -1)
    within = df.select("*", *[F.sum(c).over(wi).alias("_wi_" + c) for c in cols])
    joined = within.join(bucket_prefix, [key, "bucket"], "left")
    return joined.select(*df.columns,
                         *[(F.coalesce(F.col("_wi_" + c), zero) + F.coalesce(F.col("_bp_" + c), zero))
                           .alias(c + "_before") for c in cols])


# ------------------------------------------------------------------ L7
LEG_COLS = ["id", "leg", "account_id", "cents", "state", "is_debit", "bucket"]
LEG_SCHEMA = ("id bigint, leg int, account_id bigint, cents bigint, state string, is_debit boolean, bucket int, "
              "kind string")


def _cents(c):
    return (F.col(c).cast(MONEY) * 100).cast("bigint")


def _opening_legs(opening: DataFrame) -> DataFrame:
    return opening.select(
        F.lit(-1).cast("bigint").alias("id"), F.lit(0).alias("leg"), F.col("account_id").cast("bigint"),
        F.coalesce(_cents("balance"), F.lit(0).cast("bigint")).alias("cents"),
        F.lit("A").alias("state"), F.lit(False).alias("is_debit"))


class _Settler:
    """Goes through buckets in id order and carries the bounds on the balance along, over batches too; only the running bucket's
    bounds are held. Whole stretches are accepted at once in numpy: if every undecided debit of a stretch leaves ``lo`` at zero or more,
    counting all of them, all are accepted. Rows are walked one by one only from the first debit that does not, ``STEP`` at a time."""

    STEP = 64
    SAFE = 2.0 ** 62       # cents; batches whose sums could go beyond are walked row by row in whole numbers of any size

    def __init__(self):
        self.key, self.lo, self.hi, self.settled, self.folded = None, 0, 0, True, 0
        self.verdict = (None, None)        # of the last debit: a transfer within an account has both its legs here

    def _load(self, batch: pa.RecordBatch) -> None:
        col = lambda name: batch.column(batch.schema.get_field_index(name))
        ints = lambda name: col(name).fill_null(-2).to_numpy(zero_copy_only=False).astype(np.int64)
        self.batch, self.ids, self.cents = batch, ints("id"), ints("cents")
        self.debit, self.account, self.part = col("is_debit").to_numpy(zero_copy_only=False), ints("account_id"), ints("run" if "run" in batch.schema.names else "bucket")      # buckets alone: each is a run
        self.open = pc.equal(col("state"), "U").to_numpy(zero_copy_only=False)
        n = batch.num_rows
        new = np.ones(n, bool)
        new[1:] = (self.account[1:] != self.account[:-1]) | (self.part[1:] != self.part[:-1])
        self.starts = np.append(np.flatnonzero(new), n)
        # the incoming leg of a transfer within an account stands right behind its debit and shares its verdict
        self.twin = np.zeros(n, bool)
        self.twin[1:] = self.open[1:] & ~self.debit[1:] & self.open[:-1] & self.debit[:-1] & (self.ids[1:] == self.ids[:-1]) & ~new[1:]
        self.loose = self.open & ~self.debit & ~self.twin       # incoming transfers that are not decided yet
        self.lo0, self.hi0 = ints("lo"), ints("hi")
        most = np.abs(self.cents.astype(float)).sum() + max(np.abs(b.astype(float)).max(initial=0) for b in (self.lo0, self.hi0))
        self.safe = most + abs(self.lo) + abs(self.hi) < self.SAFE
        self.sum_hi = np.append(0, np.cumsum(self.cents))
        self.sum_lo = np.append(0, np.cumsum(np.where(self.loose, 0, self.cents)))
        self.kept, self.decided, self.folds = [], [], []

    def take(self, batch: pa.RecordBatch) -> pa.RecordBatch:
        """The batch's output, tagged ``kind``: legs still to be worked on, and verdicts ('decided') on debits."""
        self._load(batch)
        n = batch.num_rows
        if not n:
            return self._output()
        begin, end = self.starts[:-1], self.starts[1:]
        lo, hi = self.lo0[begin].tolist(), self.hi0[begin].tolist()
        settled, folded = [True] * len(begin), [0] * len(begin)
        first = (int(self.account[0]), int(self.part[0]))
        if first == self.key:
            lo[0], hi[0], settled[0], folded[0] = self.lo, self.hi, self.settled, self.folded
        else:
            self.close()
        at = np.arange(n)
        bucket = np.repeat(np.arange(len(begin)), end - begin)
        # a verdict of the batch before on the first row's twin: that row is walked
        walk_first = bool(self.open[0] and not self.debit[0] and self.verdict[0] == self.ids[0])
        if self.safe:
            after = np.array(lo, np.int64)[bucket] + self.sum_lo[1:] - self.sum_lo[begin][bucket]
            stop = np.minimum(np.minimum.reduceat(np.where(self.open & self.debit & (after < 0), at, n), begin), end)
            if walk_first:
                stop[0] = 0
        else:
            stop = begin.copy()
        loosened = np.where(settled, np.minimum(np.minimum.reduceat(np.where(self.loose, at, n), begin), stop), begin)
        done = at < stop[bucket]
        self._accept(np.flatnonzero(done & self.open & self.debit))
        self._keep(np.flatnonzero(done & (at >= loosened[bucket])))
        fold_to = np.minimum(loosened, stop)
        bulk = (self.sum_hi[fold_to] - self.sum_hi[begin]).tolist(), (self.sum_lo[stop] - self.sum_lo[begin]).tolist(), (self.sum_hi[stop] - self.sum_hi[begin]).tolist()
        accounts, parts = self.account[begin].tolist(), self.part[begin].tolist()
        for i, (s, e, u) in enumerate(zip(stop.tolist(), end.tolist(), loosened.tolist())):
            if i:
                self.close()
            self.key, self.settled = (accounts[i], parts[i]), settled[i] and u >= s
            if self.safe:
                self.folded, self.lo, self.hi = folded[i] + bulk[0][i], lo[i] + bulk[1][i], hi[i] + bulk[2][i]
            else:
                self.folded, self.lo, self.hi = folded[i], lo[i], hi[i]
            if s < e:
                self._walk(s, e)
            elif self.open[e - 1] and self.debit[e - 1]:
                self.verdict = (int(self.ids[e - 1]), "A")
        return self._output()

    def _walk(self, at: int, end: int) -> None:
        """The rows of one bucket from the first that is in doubt: ``STEP`` one by one, then as many as are accepted at once."""
        size = self.STEP
        while at < end:
            to = min(at + self.STEP, end) if self.safe else end
            if to < end and self.twin[to]:
                to += 1
            self._step(at, to)
            at, to = to, min(to + size, end)
            if at == to:
                continue
            after = self.lo + self.sum_lo[at + 1:to + 1] - self.sum_lo[at]
            short = np.flatnonzero(self.open[at:to] & self.debit[at:to] & (after < 0))
            size = self.STEP if len(short) else size * 4
            to = at + int(short[0]) if len(short) else to
            if at == to:
                continue
            self._accept(at + np.flatnonzero(self.open[at:to] & self.debit[at:to]))
            loose = np.flatnonzero(self.loose[at:to])
            kept = at if not self.settled else at + int(loose[0]) if len(loose) else to
            self.folded += int(self.sum_hi[kept] - self.sum_hi[at])
            self._keep(np.arange(kept, to))
            self.settled = self.settled and not len(loose)
            self.lo += int(self.sum_lo[to] - self.sum_lo[at])
            self.hi += int(self.sum_hi[to] - self.sum_hi[at])
            if self.open[to - 1] and self.debit[to - 1]:
                self.verdict = (int(self.ids[to - 1]), "A")
            at = to

    def _step(self, at: int, end: int) -> None:
        kept, states, accepted, rejected = [], [], [], []
        rows = zip(range(at, end), *(c[at:end].tolist() for c in (self.ids, self.cents, self.open, self.debit)))
        for row, id_, cents, is_open, debit in rows:
            if is_open and not debit and self.verdict[0] == id_:
                if self.verdict[1] == "R":
                    continue
                is_open = False
            if not is_open:
                self.lo, self.hi = self.lo + cents, self.hi + cents
            elif not debit:
                self.hi, self.settled = self.hi + cents, False
            elif self.lo >= -cents:
                self.lo, self.hi, is_open = self.lo + cents, self.hi + cents, False
                self.verdict = (id_, "A")
                accepted.append(row)
            elif self.hi < -cents:
                self.verdict = (id_, "R")
                rejected.append(row)
                continue
            else:
                self.lo, self.settled = self.lo + cents, False
            if self.settled:
                self.folded += cents
            else:
                kept.append(row)
                states.append("U" if is_open else "A")
        self.kept.append((kept, states))
        self.decided += [(accepted, "A"), (rejected, "R")]

    def _accept(self, rows: np.ndarray) -> None:
        self.decided.append((rows, "A"))

    def _keep(self, rows: np.ndarray) -> None:
        """Rows of an accepted stretch that stand behind an undecided one."""
        self.kept.append((rows, np.where(self.loose[rows], "U", "A")))

    def close(self) -> None:
        """The bucket is over: its decided prefix goes on as one leg."""
        if self.key and self.folded:
            self.folds.append((*self.key, self.folded))
        self.key, self.folded = None, 0

    def _output(self) -> pa.RecordBatch:
        kept = pa.array(np.concatenate([np.asarray(r, np.int64) for r, _ in self.kept] or [[]]).astype(np.int64))
        states = pa.array([s for _, states in self.kept for s in states], pa.string())
        decided = pa.array(np.concatenate([np.asarray(r, np.int64) for r, _ in self.decided] or [[]]).astype(np.int64))
        verdicts = pa.array([v for rows, v in self.decided for _ in range(len(rows))], pa.string())
        account, part, cents = zip(*self.folds) if self.folds else ((), (), ())
        schema = pa.schema([("id", pa.int64()), ("leg", pa.int32()), ("account_id", pa.int64()), ("cents", pa.int64()), ("state", pa.string()),
                            ("is_debit", pa.bool_()), ("bucket", pa.int32()), ("kind", pa.string())])
        own = {"id": [-1] * len(account), "leg": [0] * len(account), "account_id": account, "cents": cents, "state": ["A"] * len(account),
               "is_debit": [False] * len(account), "bucket": part, "kind": ["work"] * len(account)}

        def column(f: pa.Field) -> pa.Array:
            fold = pa.array(own[f.name], f.type)
            if f.name == "kind":
                return pa.concat_arrays([pa.repeat(pa.scalar("work"), len(kept)), pa.repeat(pa.scalar("decided"), len(decided)), fold])
            if f.name == "state":
                return pa.concat_arrays([states, verdicts, fold])
            found = self.batch.column(self.batch.schema.get_field_index(f.name))
            of_verdict = found.take(decided) if f.name == "id" else pa.nulls(len(decided), f.type)
            return pa.concat_arrays([found.take(kept).cast(f.type), of_verdict.cast(f.type), fold])

        return pa.RecordBatch.from_arrays([column(f) for f in schema], schema=schema)


def _settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Settle runs of buckets, sorted by account, bucket and id: see ``_Settler``, whose buckets are these runs."""
    settler = _Settler()
    seen = None
    for seen in batches:
        yield settler.take(seen)
    if seen is not None:
        settler._load(seen.slice(0, 0))
        settler.close()
        yield settler._output()


def _round(legs: DataFrame, verdicts: DataFrame | None) -> DataFrame:
    """One round: apply the last verdicts (a transfer's incoming leg lives on another account, hence a join by id),
    bound the balance at the start of each bucket, settle the buckets of accounts with open legs, run by run. A run has the number of
    its first bucket, whose bounds it starts from and to which its decided prefix goes; how many a hot account has follows its legs
    that are still worked on, not the range partitions."""
    if verdicts is not None:
        legs = (legs.join(verdicts, "id", "left")
                .select(*[F.coalesce("new_state", "state").alias("state") if c == "state" else F.col(c)
                          for c in LEG_COLS])
                .where(F.col("state") != "R"))
    accepted, debit = F.col("state") == "A", F.col("cents") < 0
    total = lambda cond: F.sum(F.when(cond, F.col("cents")).otherwise(0))
    totals = legs.groupBy("account_id", "bucket").agg(
        total(accepted | debit).alias("lo"), total(accepted | ~debit).alias("hi"),
        F.sum(F.when(accepted, 0).otherwise(1)).alias("open"), F.count(F.lit(1)).alias("legs"))
    per = Window.partitionBy("account_id")
    before = per.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select("account_id", "bucket", F.coalesce(F.sum("lo").over(before), F.lit(0)).alias("lo"),
                           F.coalesce(F.sum("hi").over(before), F.lit(0)).alias("hi"),
                           F.floor(F.coalesce(F.sum("legs").over(before), F.lit(0)) / LEGS_PER_RUN).alias("run"),
                           F.sum("open").over(per).alias("open")).where("open > 0").drop("open")
    starts = starts.withColumn("run", F.min("bucket").over(Window.partitionBy("account_id", "run")))
    rows = legs.join(starts, ["account_id", "bucket"]).select(*LEG_COLS, "lo", "hi", "run")
    rows = rows.repartition("account_id", "run").sortWithinPartitions("account_id", "run", "bucket", "id", "leg")
    return rows.mapInArrow(_settle, LEG_SCHEMA)


def _store_round(rows: DataFrame, root: str, number: int) -> tuple[DataFrame, int, DataFrame]:
    """Write one round (open legs + verdicts, tagged by ``kind``) as ONE folder.

    The number of still-undecided debits is observed during that same write,
    so a round costs a single job. Returns (work legs, open count, verdicts).
    """
    spark = rows.sparkSession
    path = f"{root}/round={number}"
    obs = Observation()
    is_open = (F.col("kind") == "work") & F.col("is_debit") & (F.col("state") == "U")
    rows.observe(obs, F.sum(F.when(is_open, 1).otherwise(0)).alias("open")).write.partitionBy("kind").parquet(path)
    open_count = obs.get.get("open") or 0
    stored = spark.read.schema(LEG_SCHEMA).parquet(path)
    work = stored.where(F.col("kind") == "work").select(*LEG_COLS)
    verdicts = stored.where(F.col("kind") == "decided").select("id", F.col("state").alias("new_state"))
    return work, open_count, verdicts


def post_batch(opening: DataFrame, requests: DataFrame, partitions: int | None = None) -> Posting:
    """Post id-ordered requests against opening balances; equal to the sequential fold.

    opening: (account_id, balance decimal?) ; requests: (id, account_id,
    related_account_id, txn_type, amount, created_at). ``partitions``: range
    partitions of the legs, by default as many as keep a bucket at ``LEGS_PER_BUCKET``.
    Raises if a debit is left without a verdict.
    """
    spark = opening.sparkSession
    checked = cut_lineage(validate_requests(requests, opening))
    valid = checked.where(F.col("reject_reason").isNull())
    legs = movements(valid).select(
        "id", "leg", F.col("account_id").cast("bigint"), _cents("delta").alias("cents"),
        F.when(F.col("txn_type") == "DEPOSIT", F.lit("A")).otherwise(F.lit("U")).alias("state"),
        ((F.col("leg") == 0) & F.col("txn_type").isin(*DEBIT_TYPES)).alias("is_debit"))
    legs = bucketed(_opening_legs(opening).unionByName(legs), "account_id", "id", partitions).select(*LEG_COLS)
    root = work_dir(spark, "posting")
    work, open_count, verdicts, rounds = legs, legs.where("is_debit").count(), None, 0
    while open_count:
        rounds += 1
        work, still_open, verdicts = _store_round(_round(work, verdicts), root, rounds)
        if still_open >= open_count:
            raise RuntimeError(f"round {rounds} decided nothing: {still_open} debits are open")
        open_count = still_open

    base = checked.select("id", "account_id", "related_account_id", "txn_type", "amount", "created_at",
                          "reject_reason")
    if rounds:
        decided = spark.read.schema(LEG_SCHEMA + ", round int").parquet(root).where("kind = 'decided'")
        base = base.join(decided.select("id", F.col("state").alias("new_state")), "id", "left")
    else:
        base = base.withColumn("new_state", F.lit(None).cast("string"))
    undecided = F.col("reject_reason").isNull() & F.col("txn_type").isin(*DEBIT_TYPES) & F.col("new_state").isNull()
    reason = F.coalesce(F.col("reject_reason"),
                        F.when(undecided, F.raise_error(F.lit("a debit has no verdict")).cast("string")),
                        F.when(F.col("new_state") == "R", F.lit(INSUFFICIENT_FUNDS)))
    outcome = cut_lineage(base.select("id", "account_id", "related_account_id", "txn_type", "amount",
                                      "created_at", reason.alias("reject_reason")))
    outcome = outcome.withColumn("accepted", F.col("reject_reason").isNull())
    accepted = outcome.where(F.col("accepted"))

    nulls = opening.where(F.col("balance").isNull()).select(F.col("account_id").cast("bigint"), F.lit(1).alias("nulls"))
    after = legs.join(accepted.select("id"), "id", "left_semi").unionByName(legs.where("id = -1"))
    after = prefix_sums(after.select("id", "leg", "account_id", "bucket", "cents"), "account_id", ["cents"], inclusive_same_id=True)
    after = after.where((F.col("leg") == 0) & (F.col("id") >= 0)).join(nulls, "account_id", "left")
    balance_after = after.select("id", F.when(F.col("nulls").isNull(), (F.col("cents_before").cast("decimal(20,0)") / 100).cast(MONEY))
                                 .alias("balance_after"))
    decisions = outcome.join(balance_after, "id", "left").select(
        "id", "account_id", "txn_type", "amount", "accepted", "reject_reason", "balance_after")
    ledger = ledger_legs(accepted)
    closing = closing_balances(opening, movements(accepted))
    return Posting(decisions, ledger, closing, rounds)


# ------------------------------------------------------------------ posting in micro-batches
BALANCES, DECISIONS, LEDGER = "balances", "decisions", "ledger"
BALANCE_SCHEMA = "account_id bigint, balance decimal(38,2)"
DECISION_SCHEMA = ("id bigint, account_id bigint, txn_type string, amount decimal(18,2), accepted boolean, reject_reason string, "
                   "balance_after decimal(18,2)")
LEDGER_SCHEMA = "id bigint, transaction_id bigint, account_id bigint, entry_type string, amount decimal(18,2), created_at timestamp_ntz"


def _books(spark: SparkSession, root: str) -> tuple[Published, Keyed, State]:
    """Published balances per account, decisions and ledger entries."""
    table = Published(spark, root)
    state = table.state()
    return table, Keyed(table, BALANCES, "account_id", BALANCE_SCHEMA), state


@drops_own_work
def open_accounts(spark: SparkSession, root: str, accounts: DataFrame) -> None:
    """Add accounts (account_id, balance; one row each) to the books at ``root``; those that are there keep their balance."""
    table, balances, state = _books(spark, root)
    new = accounts.select(F.col("account_id").cast("bigint"), F.col("balance").cast(SUM_MONEY))
    new = cut_lineage(new.join(balances.read(state).select("account_id"), "account_id", "left_anti"), "accounts")
    table.publish(state, balances.write(state, new, new.count()))


@drops_own_work
def post_stream_batch(spark: SparkSession, root: str, requests: DataFrame, batch: tuple[str, int], before_publish=None) -> None:
    """Post one micro-batch of requests against the published balances; its decisions, ledger entries and the balances it leaves are
    published at once, with the batch's name (stream id, batch id). A batch that has been published is not posted again.

    Batches post in the order in which they come, requests of one batch by id, so requests that come in order of their ids get the
    decisions of one batch with all of them, wherever they are cut. Only the buckets of the accounts concerned are read."""
    table, balances, state = _books(spark, root)
    if state.batch_done(*batch):
        return
    requests = cut_lineage(requests, "requests")
    ids = requests.select(F.explode(F.array(F.col("account_id").cast("bigint"), F.col("related_account_id").cast("bigint"))).alias("account_id"))
    ids = ids.where("account_id is not null").distinct()
    ids = cut_lineage(ids, "accounts")
    opening = cut_lineage(balances.read(state, balances.buckets_of(state, ids)).join(ids, "account_id", "left_semi"), "opening")
    posted = post_batch(opening, requests)
    closing = cut_lineage(posted.closing, "closing")
    n = requests.count()
    added = {**table.write(posted.decisions, DECISIONS, rows=n), **table.write(posted.ledger, LEDGER, rows=2 * n), **balances.write(state, closing, closing.count())}
    if before_publish is not None:
        before_publish()
    state = table.publish(state, added, streams={batch[0]: batch[1]})
    state = balances.compact(state)
    table.compact(table.compact(state, DECISIONS, DECISION_SCHEMA), LEDGER, LEDGER_SCHEMA)


def read_books(spark: SparkSession, root: str) -> Posting | None:
    """What has been posted so far; None before the first batch. ``closing`` has the balances of all accounts."""
    table, balances, state = _books(spark, root)
    decisions = table.read(state, DECISIONS, DECISION_SCHEMA)
    if decisions is None:
        return None
    return Posting(decisions, table.read(state, LEDGER, LEDGER_SCHEMA), balances.read(state), 0)


# ------------------------------------------------------------------ L6, L8, L9, L10
def closing_balances(opening: DataFrame, moves: DataFrame) -> DataFrame:
    """Opening + sum of accepted movements per account (a NULL balance stays NULL)."""
    net = moves.groupBy(F.col("account_id").cast("bigint").alias("account_id")).agg(
        F.sum("delta").alias("net"))
    return opening.select(F.col("account_id").cast("bigint"), F.col("balance").cast(MONEY)).join(
        net, "account_id", "left").select(
        "account_id", (F.col("balance") + F.coalesce(F.col("net"), F.lit(0))).cast(SUM_MONEY).alias("balance"))


def ledger_imbalances(ledger: DataFrame) -> DataFrame:
    """Transactions whose entries are not one DEBIT and one CREDIT of equal amount."""
    debit = F.when(F.col("entry_type") == "DEBIT", F.col("amount")).otherwise(F.lit(0))
    credit = F.when(F.col("entry_type") == "CREDIT", F.col("amount")).otherwise(F.lit(0))
    per_txn = ledger.groupBy("transaction_id").agg(
        F.count(F.lit(1)).alias("entries"),
        F.sum(debit).cast(SUM_MONEY).alias("debits"),
        F.sum(credit).cast(SUM_MONEY).alias("credits"))
    return per_txn.where((F.col("entries") != 2) | (F.col("debits") != F.col("credits")))


def reconcile(opening: DataFrame, ledger: DataFrame, closing: DataFrame) -> DataFrame:
    """Accounts where opening + sum(DEBIT - CREDIT) differs from closing (DEBIT = increase)."""
    signed = F.when(F.col("entry_type") == "DEBIT", F.col("amount")).otherwise(-F.col("amount"))
    net = (ledger.where(F.col("account_id").isNotNull())
           .groupBy(F.col("account_id").cast("bigint").alias("account_id")).agg(F.sum(signed).alias("net")))
    exp = opening.select(F.col("account_id").cast("bigint"), F.col("balance").cast(MONEY).alias("opening")).join(
        net, "account_id", "full")
    exp = exp.select("account_id", (F.col("opening") + F.coalesce("net", F.lit(0))).cast(SUM_MONEY)
                     .alias("expected"), F.col("opening").isNull().alias("_no_opening"))
    cmp = exp.join(closing.select(F.col("account_id").cast("bigint"), F.col("balance").alias("closing")),
                   "account_id", "full")
    return cmp.where(~F.col("expected").eqNullSafe(F.col("closing"))).select("account_id", "expected", "closing")


def reject_report(decisions: DataFrame) -> DataFrame:
    return (decisions.where(~F.col("accepted")).groupBy("reject_reason")
            .agg(F.count(F.lit(1)).alias("requests"), F.sum("amount").cast(SUM_MONEY).alias("amount")))
