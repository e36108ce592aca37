"""Edge cases with inline rows."""
import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from bankflow import schemas as S
from bankflow.functions.variant import flatten
from bankflow.operators.published import Published
from bankflow.operators import marts, snapshots, staging
from bankflow.session import work_dir
from bankflow.sources import cdc

TOPIC = "banking_server.public.customers"


def events(spark, values, topic=TOPIC):
    return spark.createDataFrame([(topic, v if isinstance(v, str) else json.dumps(v)) for v in values],
                                 "topic string, value string")


def test_envelope_forms_and_deletes(spark):
    row = {"id": 1, "first_name": "A"}
    ev = events(spark, [
        {"payload": {"before": None, "after": row, "op": "c", "ts_ms": 1, "seq": 1}},
        {"payload": None, "after": {**row, "id": 2}, "op": "c", "ts_ms": 2, "seq": 2},   # null payload: use event
        {"payload": {}, "after": {**row, "id": 3}, "op": "c", "ts_ms": 3, "seq": 3},     # empty payload is falsy
        {"before": row, "after": None, "op": "d", "ts_ms": 4, "seq": 4},                 # delete
        {"after": {}, "op": "u", "ts_ms": 5, "seq": 5},                                  # empty after: dropped
        "{not json",                                                                      # malformed: dropped
    ])
    dec = cdc.decode(ev)
    assert dec.count() == 6
    ids = sorted(r[0] for r in cdc.keep_upserts(dec).select(F.try_variant_get("after", "$.id", "int")).collect())
    assert ids == [1, 2, 3]
    assert {r[0] for r in dec.select("table_name").collect()} == {"customers"}


def test_flatten_bad_cast_lenient_and_strict(spark):
    raw = spark.createDataFrame([('{"id": 7, "amount": "x", "created_at": "2024-01-01T00:00:00.5"}',)], "j string") \
        .select(F.parse_json("j").alias("v"))
    spec = [("id", "$.id", "string"), ("amount", "$.amount", "double"), ("t", "$.created_at", "timestamp_ntz"),
            ("missing", "$.nope", "string")]
    row = flatten(raw, spec).first()
    assert row["id"] == "7" and row["amount"] is None and row["missing"] is None
    assert row["t"] == dt.datetime(2024, 1, 1, 0, 0, 0, 500000)
    with pytest.raises(Exception):
        flatten(raw, spec, strict=True).collect()


def test_date_as_epoch_days_or_text(spark):
    raw = spark.createDataFrame([('{"d": 10957}',), ('{"d": "2000-01-01"}',), ('{"d": null}',)], "j string") \
        .select(F.parse_json("j").alias("v"))
    got = [r[0] for r in flatten(raw, [("d", "$.d", "date")]).collect()]
    assert got == [dt.date(2000, 1, 1), dt.date(2000, 1, 1), None]


def _stg_rows(spark, rows):
    """Raw customer rows (dicts with _ts_ms/_seq) -> stg_customers."""
    data = [(json.dumps({k: v for k, v in r.items() if not k.startswith("_")}), r["_ts_ms"], r["_seq"])
            for r in rows]
    raw = spark.createDataFrame(data, "j string, _ts_ms long, _seq long").select(
        F.parse_json("j").alias("v"), "_ts_ms", "_seq")
    return staging.stg_customers(raw, "2024-01-03 00:00:00")


def test_latest_null_first_and_ties(spark):
    base = {"first_name": "A", "last_name": "B", "email": "e", "status": "ACTIVE"}
    rows = [
        {**base, "id": 1, "address": "old", "created_at": "2024-01-01T00:00:00", "_ts_ms": 1, "_seq": 1},
        {**base, "id": 1, "address": "new", "created_at": "2024-01-01T00:00:00", "_ts_ms": 2, "_seq": 2},  # tie
        {**base, "id": 2, "address": "dated", "created_at": "2024-01-01T00:00:00", "_ts_ms": 9, "_seq": 9},
        {**base, "id": 2, "address": "undated", "created_at": None, "_ts_ms": 1, "_seq": 1},  # NULL sorts first
    ]
    got = {r["customer_id"]: r["cust_address"] for r in _stg_rows(spark, rows).collect()}
    assert got == {"1": "new", "2": "undated"}


def _snap_source(spark, rows):
    return spark.createDataFrame(rows, "customer_id string, phone string, dob string, load_timestamp timestamp_ntz")


def test_scd2_change_detection(spark):
    root = work_dir(spark, "t-scd2")
    t1, t2, t3 = dt.datetime(2024, 1, 2), dt.datetime(2024, 1, 3), dt.datetime(2024, 1, 4)
    day1 = _snap_source(spark, [("1", None, "x", t1), ("2", "p", "x", t1), ("3", "q", "x", t1)])
    snapshots.run_snapshot(spark, root, day1, "customer_id", ["phone"], t1)
    # 1: NULL -> value (tracked change); 2: untracked column only; 3: gone from source
    day2 = _snap_source(spark, [("1", "p1", "x", t2), ("2", "p", "y", t2), ("4", "r", "x", t2)])
    snap = snapshots.run_snapshot(spark, root, day2, "customer_id", ["phone"], t2)
    key = lambda t: tuple("" if x is None else str(x) for x in t)
    rows = sorted(((r["customer_id"], r["phone"], r["dob"], r["dbt_valid_to"]) for r in snap.collect()), key=key)
    assert rows == sorted([("1", None, "x", t2), ("1", "p1", "x", None), ("2", "p", "x", None),
                           ("3", "q", "x", None), ("4", "r", "x", None)], key=key)
    again = snapshots.run_snapshot(spark, root, day2, "customer_id", ["phone"], t3)  # rerun: no change
    assert sorted((tuple(r) for r in again.drop("load_timestamp").collect()), key=key) == \
        sorted((tuple(r) for r in snap.drop("load_timestamp").collect()), key=key)


def _fact_rows(spark, rows):
    cols = [c for c in S.STG_TRANSACTIONS_COLS if c != "load_timestamp"]
    full = []
    for tid, t, status in rows:
        full.append((tid, "1", None, "DEPOSIT", "CREDIT", 1.0, None, status, None, None, t))
    schema = ", ".join(f"{c} {'double' if c == 'amount' else 'timestamp_ntz' if c == 'txn_time' else 'string'}"
                       for c in cols)
    return spark.createDataFrame(full, schema)


def test_incremental_strict_high_water(spark):
    target = work_dir(spark, "t-facts")
    d = dt.datetime
    run1 = _fact_rows(spark, [("1", d(2024, 1, 5), "COMPLETED"), ("2", d(2024, 1, 6), "COMPLETED")])
    marts.facts_transactions(spark, run1, target, d(2024, 1, 7))
    run2 = _fact_rows(spark, [("1", d(2024, 1, 5), "REVERSED"), ("3", d(2024, 1, 6), "COMPLETED"),  # equal time: lost
                              ("4", d(2024, 1, 4), "COMPLETED"), ("5", d(2024, 1, 8), "COMPLETED")])  # late: lost
    out = marts.facts_transactions(spark, run2, target, d(2024, 1, 9))
    got = sorted((r["transaction_id"], r["txn_status"]) for r in out.collect())
    assert got == [("1", "COMPLETED"), ("2", "COMPLETED"), ("5", "COMPLETED")]


def test_incremental_upsert_and_lateness(spark):
    target = work_dir(spark, "t-facts-up")
    d = dt.datetime
    run1 = _fact_rows(spark, [("1", d(2024, 1, 5), "COMPLETED"), ("2", d(2024, 1, 6), "COMPLETED")])
    marts.facts_transactions(spark, run1, target, d(2024, 1, 7), mode="upsert")
    run2 = _fact_rows(spark, [("1", d(2024, 1, 5), "REVERSED"), ("3", d(2024, 1, 6), "COMPLETED")])
    out = marts.facts_transactions(spark, run2, target, d(2024, 1, 9), mode="upsert",
                                   allowed_lateness=dt.timedelta(days=2))
    got = sorted((r["transaction_id"], r["txn_status"]) for r in out.collect())
    assert got == [("1", "REVERSED"), ("2", "COMPLETED"), ("3", "COMPLETED")]


def test_empty_target_is_a_first_run(spark):
    target = work_dir(spark, "t-facts-empty")
    d = dt.datetime
    empty = _fact_rows(spark, [("0", d(2024, 1, 1), "COMPLETED")]).limit(0)
    marts.facts_transactions(spark, empty, target, d(2024, 1, 2))
    out = marts.facts_transactions(spark, _fact_rows(spark, [("1", d(2024, 1, 5), "COMPLETED")]), target,
                                   d(2024, 1, 7))
    assert [r["transaction_id"] for r in out.collect()] == ["1"]


def test_null_time_rows_are_loaded_once(spark):
    target = work_dir(spark, "t-null")
    d = dt.datetime
    for _ in range(2):
        out = marts.facts_transactions(spark, _fact_rows(spark, [("1", None, "COMPLETED")]), target, d(2024, 1, 2))
    assert out.count() == 1
    out = marts.facts_transactions(spark, _fact_rows(spark, [("1", None, "COMPLETED"), ("2", None, "X"), ("3", d(2024, 1, 1), "X")]), target, d(2024, 1, 3))
    assert sorted(r[0] for r in out.select("transaction_id").collect()) == ["1", "2", "3"]


def test_upsert_updates_old_rows_without_lateness_and_moves_days(spark):
    target = work_dir(spark, "t-up")
    d = dt.datetime
    marts.facts_transactions(spark, _fact_rows(spark, [("1", d(2024, 1, 5), "COMPLETED"), ("2", d(2024, 1, 9), "COMPLETED")]), target, d(2024, 1, 10))
    out = marts.facts_transactions(spark, _fact_rows(spark, [("1", d(2024, 1, 6), "REVERSED"), ("2", d(2024, 1, 9), "REVERSED"), ("9", d(2024, 1, 1), "LATE")]),
                                   target, d(2024, 1, 11), mode="upsert")
    assert sorted((r["transaction_id"], r["txn_status"], r["txn_time"].day) for r in out.collect()) == [("1", "REVERSED", 6), ("2", "REVERSED", 9)]


def test_unreadable_fact_raises_and_changes_nothing(spark):
    import glob

    target = work_dir(spark, "t-broken")
    marts.facts_transactions(spark, _fact_rows(spark, [("1", dt.datetime(2024, 1, 5), "C")]), target, "2024-01-06")
    files = glob.glob(f"{target}/facts/c=*/txn_date=*/*.parquet")
    for f in files:
        with open(f, "wb") as out:
            out.write(b"not parquet at all")
    with pytest.raises(Exception):
        marts.facts_transactions(spark, _fact_rows(spark, [("2", dt.datetime(2024, 1, 7), "C")]), target, "2024-01-08")
    assert glob.glob(f"{target}/facts/c=*/txn_date=*/*.parquet") == files


def _snap(spark, root, rows, at):
    return snapshots.run_snapshot(spark, root, _snap_source(spark, [(k, p, "x", at) for k, p in rows]), "customer_id", ["phone"], at)


def test_snapshot_input_checks(spark):
    root, t = work_dir(spark, "t-in"), dt.datetime(2024, 1, 2)
    with pytest.raises(ValueError, match="unique"):
        _snap(spark, root, [("1", "a"), ("1", "b")], t)
    assert snapshots.read_snapshot(spark, root) is None
    assert _snap(spark, root, [], t).count() == 0
    assert _snap(spark, root, [("1", "a")], t + dt.timedelta(1)).count() == 1
    with pytest.raises(ValueError, match="later"):
        _snap(spark, root, [("1", "b")], t + dt.timedelta(1))


def test_a_run_that_dies_before_its_marker_is_not_seen(spark):
    root, t = work_dir(spark, "t-crash"), dt.datetime(2024, 1, 2)
    rows = [(str(i), "a") for i in range(40)]
    _snap(spark, root, rows, t)
    before = sorted(map(str, snapshots.read_snapshot(spark, root).collect()))
    changed = [(k, "b" if int(k) < 10 else p) for k, p in rows]
    _snap(spark, root, changed, t + dt.timedelta(1))
    from bankflow.session import drop_path, list_names

    drop_path(spark, f"{root}/log/000000000002.json")                  # its rows are written, its version is not
    drop_path(spark, f"{root}/closed/{list_names(spark, f'{root}/closed')[0]}")     # nor all of its folders
    assert sorted(map(str, snapshots.read_snapshot(spark, root).collect())) == before
    again = _snap(spark, root, changed, t + dt.timedelta(1))
    assert again.count() == 50 and again.where("dbt_valid_to is null").count() == 40


def test_damaged_snapshot_raises_and_stays(spark):
    import glob

    root, t = work_dir(spark, "t-damaged"), dt.datetime(2024, 1, 2)
    _snap(spark, root, [("1", "a")], t)
    for f in glob.glob(f"{root}/open/c=*/bucket=*/*.parquet"):
        with open(f, "wb") as out:
            out.write(b"damaged beyond reading")
    with pytest.raises(Exception):
        _snap(spark, root, [("1", "b")], t + dt.timedelta(1))
    assert snapshots.last_run(spark, root)[0] == 1


def test_runs_write_what_has_changed(spark):
    """A step with one change adds one open row and one closed row, one without changes nothing."""
    root, t = work_dir(spark, "t-deltas"), dt.datetime(2024, 1, 2)
    rows = [(str(i), "a") for i in range(200)]
    _snap(spark, root, rows, t)
    _snap(spark, root, rows, t + dt.timedelta(1))
    _snap(spark, root, [("7", "b"), *[r for r in rows if r[0] != "7"]], t + dt.timedelta(2))
    state = Published(spark, root).state()
    written = {kind: sorted(spark.read.parquet(f"{root}/{p}").count() for p in state.of(kind)) for kind in ("open", "closed")}
    assert written == {"open": [1, 200], "closed": [1]} and snapshots.last_run(spark, root) == (3, t + dt.timedelta(2))
    snap = snapshots.read_snapshot(spark, root)
    assert snap.count() == 201 and snap.select("dbt_scd_id").distinct().count() == 201


def test_many_runs_keep_few_files(spark, monkeypatch):
    """Segments, log files and folders stay few over many steps, and the history is that of a plain fold."""
    from bankflow.operators import published
    from bankflow.session import list_names

    for name, value in (("FAN", 3), ("FULL", 5), ("KEEP", 2)):
        monkeypatch.setattr(published, name, value)
    monkeypatch.setattr(published, "BUCKET_ROWS", 2)
    root, t, want, now = work_dir(spark, "t-many"), dt.datetime(2024, 1, 2), [], {}
    for n in range(30):
        at = t + dt.timedelta(n)
        rows = [(str((n * 7 + i) % 5), f"v{(n + i) % 4}") for i in range(2)]
        _snap(spark, root, rows, at)
        for k, v in rows:
            if k not in now or now[k][0] != v:
                if k in now:
                    want.append((k, *now[k], at))
                now[k] = (v, at)
    got = sorted((r["customer_id"], r["phone"], r["dbt_valid_from"], r["dbt_valid_to"]) for r in snapshots.read_snapshot(spark, root).collect() if r["dbt_valid_to"])
    assert got == sorted(want) and len(want) > 20
    current = {r["customer_id"]: (r["phone"], r["dbt_valid_from"]) for r in snapshots.read_snapshot(spark, root).where("dbt_valid_to is null").collect()}
    assert current == now
    state = Published(spark, root).state()
    assert len(state.segments) <= 14 and len(state.dead) <= 12
    assert len(Published(spark, root).versions()) <= 11 and sum(len(list_names(spark, f"{root}/{k}")) for k in ("open", "closed")) <= 32
    assert Published(spark, root).drop_unpublished() == []


def test_interrupted_upsert_and_its_remains(spark):
    """A reader sees the old fact while an upsert has written all but its version; the repeated one is seen whole; what the dead
    one left is found."""
    target, d = work_dir(spark, "t-dead"), dt.datetime

    def die():
        raise KeyboardInterrupt

    def seen(df):
        return sorted((r["transaction_id"], r["txn_status"], r["txn_time"].day) for r in df.collect())

    marts.facts_transactions(spark, _fact_rows(spark, [(str(i), d(2024, 1, 1 + i), "A") for i in range(6)]), target, d(2024, 1, 10))
    pinned, old = marts.read_target(spark, target), [(str(i), "A", 1 + i) for i in range(6)]
    batch = _fact_rows(spark, [("1", d(2024, 1, 5), "B"), ("4", d(2024, 1, 5), "B"), ("9", d(2024, 1, 9), "B")])
    with pytest.raises(KeyboardInterrupt):
        marts.facts_transactions(spark, batch, target, d(2024, 1, 11), "upsert", before_publish=die)
    assert seen(marts.read_target(spark, target)) == old
    new = [("0", "A", 1), ("1", "B", 5), ("2", "A", 3), ("3", "A", 4), ("4", "B", 5), ("5", "A", 6), ("9", "B", 9)]
    assert seen(marts.facts_transactions(spark, batch, target, d(2024, 1, 11), "upsert")) == new
    assert seen(pinned) == old                                          # a reader keeps the version that it began with
    assert len(Published(spark, target).drop_unpublished()) == 2       # rows and index entries of the writer that died
    assert seen(marts.read_target(spark, target)) == new
    with pytest.raises(FileExistsError):                               # a second writer that starts from an old version
        table = Published(spark, target)
        table.publish(table.state(table.state().version - 1))


def test_upsert_opens_the_buckets_of_its_ids_only(spark, monkeypatch):
    """Index files of other buckets are damaged and the upsert does not notice, nor does it read other days."""
    import glob

    from bankflow.operators import published
    from bankflow.operators.published import Keyed

    monkeypatch.setattr(published, "BUCKET_ROWS", 10)
    target, d = work_dir(spark, "t-index"), dt.datetime
    rows = [(str(i), d(2024, 1, 1 + i % 20), "A") for i in range(300)]
    marts.facts_transactions(spark, _fact_rows(spark, rows), target, d(2024, 2, 1))
    marts.facts_transactions(spark, _fact_rows(spark, [("7", d(2024, 1, 8), "B")]), target, d(2024, 2, 2), "upsert")     # builds the index
    state = Published(spark, target).state()
    keys = Keyed(Published(spark, target), marts.KEYS, "transaction_id", marts.KEY_SCHEMA)
    [own] = keys.buckets_of(state, spark.createDataFrame([("7",)], "transaction_id string"))
    assert "PartitionFilters: [isnotnull(bucket" in keys.read(state, [own])._jdf.queryExecution().toString()
    sizes = {p: s["buckets"] for p, s in state.of(marts.KEYS).items()}
    assert max(sizes.values()) == 32
    for f in glob.glob(f"{target}/keys/c=*/bucket=*/*.parquet"):
        segment, bucket = f[len(target) + 1:].split("/bucket=")
        if int(bucket.split("/")[0]) != own % sizes[segment]:
            open(f, "wb").write(b"damaged")
    for f in glob.glob(f"{target}/facts/c=*/txn_date=*/*.parquet"):
        if "txn_date=2024-01-08" not in f and "txn_date=2024-01-09" not in f:
            open(f, "wb").write(b"damaged")
    marts.facts_transactions(spark, _fact_rows(spark, [("7", d(2024, 1, 9), "C")]), target, d(2024, 2, 3), "upsert")
    state = Published(spark, target).state()
    days = [p for p, s in state.of(marts.FACTS).items() if s["day"] in ("2024-01-08", "2024-01-09")]
    got = Published(spark, target).read(state, marts.FACTS, marts.FACT_SCHEMA, days).where("transaction_id = '7'").collect()
    assert [(r["txn_status"], r["txn_time"].day) for r in got] == [("C", 9)]
    assert [(r["transaction_id"], r["txn_date"].day) for r in keys.read(state, [own]).where("transaction_id = '7'").collect()] == [("7", 9)]


def test_null_ids_in_an_upsert(spark):
    target, d = work_dir(spark, "t-null-ids"), dt.datetime
    marts.facts_transactions(spark, _fact_rows(spark, [(None, d(2024, 1, 5), "A")]), target, d(2024, 2, 1))
    out = marts.facts_transactions(spark, _fact_rows(spark, [(None, d(2024, 1, 6), "B"), ("1", d(2024, 1, 6), "B")]), target, d(2024, 2, 1), "upsert")
    assert sorted(r["txn_status"] for r in out.collect()) == ["A", "B", "B"]
