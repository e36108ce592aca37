"""Posting: the Spark fixpoint equals a plain sequential fold (brute force), plus invariants."""
import datetime as dt
import random
from decimal import Decimal

import pyarrow as pa
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from bankflow.operators import posting

TYPES = ["DEPOSIT", "WITHDRAWAL", "TRANSFER"]


def sequential_fold(opening: dict, requests: list):
    """The reference's row-at-a-time semantics, in id order."""
    bal = dict(opening)
    out = {}
    for rid, acct, rel, typ, amt in sorted(requests):
        if amt is None or amt <= 0:
            out[rid] = (False, posting.AMOUNT_NOT_POSITIVE, None)
            continue
        if typ == "TRANSFER" and rel is None:
            out[rid] = (False, posting.MISSING_DESTINATION, None)
            continue
        if acct not in bal:
            out[rid] = (False, posting.UNKNOWN_ACCOUNT, None)
            continue
        if rel is not None and rel not in bal:
            out[rid] = (False, posting.UNKNOWN_DESTINATION, None)
            continue
        if typ in ("WITHDRAWAL", "TRANSFER") and bal[acct] is None:
            out[rid] = (False, posting.NULL_BALANCE, None)
            continue
        if typ == "DEPOSIT":
            bal[acct] = None if bal[acct] is None else bal[acct] + amt
        else:
            if bal[acct] < amt:
                out[rid] = (False, posting.INSUFFICIENT_FUNDS, None)
                continue
            bal[acct] -= amt
            if typ == "TRANSFER" and bal[rel] is not None:
                bal[rel] += amt
        out[rid] = (True, None, bal[acct])
    return out, bal


def run_spark(spark, opening, requests, partitions=None):
    op = spark.createDataFrame([(a, b) for a, b in opening.items()], "account_id long, balance decimal(18,2)")
    t0 = dt.datetime(2024, 1, 1)
    rq = spark.createDataFrame([(i, a, r, t, m, t0) for i, a, r, t, m in requests],
                               "id long, account_id long, related_account_id long, txn_type string, "
                               "amount decimal(18,2), created_at timestamp_ntz")
    return posting.post_batch(op, rq, partitions)


def check(spark, opening, requests, partitions=None):
    expected, closing = sequential_fold(opening, requests)
    p = run_spark(spark, opening, requests, partitions)
    got = {r["id"]: (r["accepted"], r["reject_reason"], r["balance_after"]) for r in p.decisions.collect()}
    assert got == expected
    assert {r["account_id"]: r["balance"] for r in p.closing.collect()} == closing
    assert posting.ledger_imbalances(p.ledger).count() == 0
    return p


def test_edge_rows(spark):
    d = Decimal
    opening = {1: d("10.00"), 2: d("0.00"), 3: None}
    requests = [
        (1, 1, None, "WITHDRAWAL", d("10.00")),    # balance == amount: accepted
        (2, 1, None, "WITHDRAWAL", d("0.01")),     # now empty: insufficient
        (3, 2, 2, "TRANSFER", d("0.00")),          # amount 0
        (4, 1, 1, "TRANSFER", d("0.00")),          # amount 0 again
        (5, 2, None, "DEPOSIT", d("5.00")),
        (6, 2, 2, "TRANSFER", d("5.00")),          # self-transfer nets to zero, two legs
        (7, 3, None, "DEPOSIT", d("1.00")),        # into a NULL balance: accepted, stays NULL
        (8, 3, None, "WITHDRAWAL", d("1.00")),     # from a NULL balance: rejected
        (9, 2, 3, "TRANSFER", d("1.00")),          # into a NULL balance account
        (10, 9, None, "DEPOSIT", d("1.00")),       # unknown account
        (11, 2, 9, "TRANSFER", d("1.00")),         # unknown destination
        (12, 2, None, "TRANSFER", d("1.00")),      # missing destination
    ]
    p = check(spark, opening, requests)
    assert p.ledger.where("transaction_id = 6").count() == 2


money = st.integers(min_value=0, max_value=3000).map(lambda c: Decimal(c) / 100)


@st.composite
def batches(draw):
    n_acc = draw(st.integers(min_value=1, max_value=5))
    opening = {a: (None if draw(st.integers(0, 9)) == 0 else draw(money)) for a in range(n_acc)}
    reqs = []
    for i in range(draw(st.integers(min_value=1, max_value=25))):
        typ = draw(st.sampled_from(TYPES))
        acct = draw(st.integers(0, n_acc))           # n_acc = unknown account
        rel = draw(st.integers(0, n_acc - 1)) if typ == "TRANSFER" else None
        reqs.append((i + 1, acct, rel, typ, draw(money)))
    return opening, reqs


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(batches())
def test_fixpoint_equals_sequential_fold(spark, batch):
    opening, requests = batch
    check(spark, opening, requests, partitions=7)  # few legs per bucket: accounts span several


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(batches())
def test_fixpoint_default_buckets_equal_sequential_fold(spark, batch):
    opening, requests = batch
    check(spark, opening, requests)


def hovering(n):
    d = Decimal
    return {1: d("10.00"), 2: d("0.00")}, [(i, 1, None, "WITHDRAWAL" if i % 2 else "DEPOSIT", d("10.00") if i % 2 else d("5.00"))
                                          for i in range(1, n + 1)]


def test_rounds_follow_buckets_not_debits(spark):
    """An account that hovers near zero: one round however many debits, and one per bucket at most when it is split."""
    assert check(spark, *hovering(20_000), partitions=1).rounds == 1
    assert check(spark, *hovering(2_000), partitions=6).rounds <= 6


def test_transfers_between_hovering_accounts(spark):
    opening, requests = hovering(300)
    requests = [(i, a, 2, "TRANSFER", m) if i % 7 == 1 else (i, 2, 1, "TRANSFER", m) if i % 11 == 2 else (i, a, 1, "TRANSFER", m)
                if i % 13 == 5 else (i, a, r, t, m) for i, a, r, t, m in requests]
    for partitions in (1, 4):
        check(spark, opening, requests, partitions)


def test_a_missing_verdict_raises(spark, monkeypatch):
    import pytest

    real = posting._store_round
    monkeypatch.setattr(posting, "_store_round", lambda rows, root, n: real(rows.where("kind <> 'decided' or id <> 3"), root, n))
    with pytest.raises(Exception, match="verdict"):
        run_spark(spark, *hovering(6), partitions=1).decisions.collect()


def settle_row_by_row(rows):
    """The rule of one pass, a row at a time: verdicts, and what is left of each bucket (open and kept rows, sum of the folded prefix)."""
    verdicts, left, now = {}, {}, None
    for id_, leg, account, cents, state, debit, bucket, lo0, hi0 in rows:
        if (account, bucket) != now:
            now, lo, hi, settled = (account, bucket), lo0, hi0, True
            left[now] = [0, []]
            last = None
        if state == "U" and not debit and last == id_ and id_ in verdicts:
            state = verdicts[id_]
            if state == "R":
                continue
        if state == "A":
            lo, hi = lo + cents, hi + cents
        elif not debit:
            hi, settled = hi + cents, False
        elif lo + cents >= 0:
            lo, hi, state = lo + cents, hi + cents, "A"
            verdicts[id_], last = "A", id_
        elif hi + cents < 0:
            verdicts[id_], last = "R", id_
            continue
        else:
            lo, settled, last = lo + cents, False, id_
        if settled:
            left[now][0] += cents
        else:
            left[now][1].append((id_, leg, cents, state))
    return verdicts, {k: v for k, v in left.items() if v != [0, []]}


def settle_in_batches(rows, cuts):
    names = [*posting.LEG_COLS[:6], "bucket", "lo", "hi"]
    types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.string(), pa.bool_(), pa.int32(), pa.int64(), pa.int64()]
    edges = [0, *sorted(cuts), len(rows)]
    batches = [pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows[a:b]], t) for i, t in enumerate(types)], names=names) for a, b in zip(edges, edges[1:])]
    verdicts, left = {}, {}
    for out in posting._settle(iter(batches)):
        for r in out.to_pylist():
            if r["kind"] == "decided":
                assert r["id"] not in verdicts
                verdicts[r["id"]] = r["state"]
                continue
            found = left.setdefault((r["account_id"], r["bucket"]), [0, []])
            if r["id"] == -1:
                assert found[0] == 0
                found[0] = r["cents"]
            else:
                found[1].append((r["id"], r["leg"], r["cents"], r["state"]))
    return verdicts, {k: [s, sorted(rows, key=lambda r: r[:2])] for k, (s, rows) in left.items()}


def random_legs(rng, buckets, size, spare, wait):
    rows, id_ = [], 0
    for b in range(buckets):
        start = rng.randrange(0, spare)
        lo, hi = start - (rng.randrange(0, 20) if rng.random() < wait else 0), start
        for _ in range(rng.randrange(1, size)):
            id_ += 1
            kind, cents = rng.random(), rng.randrange(1, 30)
            if kind < 0.35:
                rows.append((id_, 0, b // 2, cents, "A", False, b, lo, hi))
            elif kind < 0.35 + wait:
                rows.append((id_, 1, b // 2, cents, "U", False, b, lo, hi))
            elif kind < 0.5:                           # within the account: both legs
                rows += [(id_, 0, b // 2, -cents, "U", True, b, lo, hi), (id_, 1, b // 2, cents, "U", False, b, lo, hi)]
            else:
                rows.append((id_, 0, b // 2, -cents, "U", True, b, lo, hi))
    return rows


def test_settling_in_stretches_equals_row_by_row(monkeypatch):
    rng = random.Random(17)
    for n in range(400):
        monkeypatch.setattr(posting._Settler, "STEP", rng.choice([1, 2, 5, 64]))
        monkeypatch.setattr(posting._Settler, "SAFE", rng.choice([2.0 ** 62] * 5 + [0.0]))
        rows = random_legs(rng, rng.choice([1, 3, 9]), rng.choice([3, 30, 200]), rng.choice([2, 60, 3000]), rng.choice([0, 0.02, 0.3]))
        cuts = [rng.randrange(0, len(rows) + 1) for _ in range(rng.randrange(0, 6))]
        want_verdicts, want_left = settle_row_by_row(rows)
        got_verdicts, got_left = settle_in_batches(rows, cuts)
        assert got_verdicts == want_verdicts
        assert {k: v for k, v in got_left.items() if v != [0, []]} == want_left
    assert list(posting._settle(iter([]))) == []


def test_settling_sums_beyond_64_bits():
    big = 2 ** 62
    rows = [(1, 0, 0, big, "A", False, 0, big, big), (2, 0, 0, big, "A", False, 0, big, big), (3, 0, 0, -big, "U", True, 0, big, big),
            (4, 0, 0, -big, "U", True, 0, big, big), (5, 0, 0, -1, "U", True, 0, big, big)]
    verdicts, left = settle_in_batches(rows, [2])
    assert verdicts == {3: "A", 4: "A", 5: "A"} and left == {(0, 0): [-1, []]}
