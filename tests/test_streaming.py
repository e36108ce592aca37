"""Streaming jobs: drain equals batch, and a restart from the checkpoint adds no duplicates."""
import json

from pyspark.sql import functions as F

from bankflow.session import checkpoint_root, list_names, work_dir
from bankflow.sources import cdc, landing
from bankflow.streaming import jobs


def _write_events(spark, path, rows):
    df = spark.createDataFrame([("banking_server.public.accounts", json.dumps(r)) for r in rows],
                               "topic string, value string")
    df.coalesce(1).write.mode("append").json(path)


def _env(i):
    return {"payload": {"before": None, "after": {"id": i, "balance": 1.5}, "op": "c", "ts_ms": 1704067200000 + i,
                        "seq": i}}


def test_landing_stream_restart_is_exactly_once(spark):
    src = work_dir(spark, "t-src")
    base = work_dir(spark, "t-landing")
    ckpt = work_dir(spark, "t-ckpt")
    _write_events(spark, src, [_env(i) for i in range(5)])
    jobs.run_landing(spark, src, base, ckpt)
    jobs.run_landing(spark, src, base, ckpt)            # restart, nothing new
    assert landing.upserts(landing.landed(spark, base)).count() == 5
    _write_events(spark, src, [_env(i) for i in range(5, 8)])
    jobs.run_landing(spark, src, base, ckpt)            # only the new file
    got = landing.upserts(landing.landed(spark, base))
    assert got.count() == 8
    batch = landing.upserts(landing.landing_rows(cdc.read_cdc_batch(spark, src)))
    assert sorted(r[0] for r in got.select("_seq").collect()) == sorted(r[0] for r in batch.select("_seq").collect())


def test_raw_load_loads_each_file_once(spark):
    src = work_dir(spark, "t-src2")
    base = work_dir(spark, "t-landing2")
    raw = work_dir(spark, "t-raw2")
    ckpt = work_dir(spark, "t-raw-ckpt2")
    _write_events(spark, src, [_env(i) for i in range(4)])
    landing.write_landing(cdc.read_cdc_batch(spark, src), base)
    landing.load_raw(spark, base, raw, ckpt)
    landing.load_raw(spark, base, raw, ckpt)
    report = landing.load_report(spark, raw).collect()
    assert [(r["table_name"], r["rows"]) for r in report] == [("accounts", 4)]
    assert landing.raw(spark, raw, "accounts").select(F.try_variant_get("v", "$.id", "int")).count() == 4


def test_a_day_loads_only_that_day_and_once(spark):
    src, base, raw, ckpt = (work_dir(spark, f"t-day-{n}") for n in ("src", "landing", "raw", "ckpt"))
    day = 86_400_000
    _write_events(spark, src, [{**_env(i), "payload": {**_env(i)["payload"], "ts_ms": 1704067200000 + (i % 2) * day}} for i in range(6)])
    landing.write_landing(cdc.read_cdc_batch(spark, src), base)
    for d in ("2024-01-01", "2024-01-01", "2024-01-02"):
        landing.load_raw(spark, base, raw, ckpt, day=d)
    got = landing.raw_rows(spark, raw).groupBy("date").count().orderBy("date").collect()
    assert [r["count"] for r in got] == [3, 3]
    assert [r["rows"] for r in landing.load_report(spark, raw, "2024-01-02").collect()] == [3]


def test_unreadable_landing_file_is_set_aside_and_loaded_once_mended(spark):
    import glob

    src, base, raw, ckpt = (work_dir(spark, f"t-bad-{n}") for n in ("src", "landing", "raw", "ckpt"))
    for i in range(0, 8, 2):
        _write_events(spark, src, [_env(i), _env(i + 1)])
        landing.write_landing(cdc.read_cdc_batch(spark, src).where(F.col("_seq") >= i), base)
    files = sorted(glob.glob(f"{base}/table_name=accounts/date=*/kind=upsert/*.parquet"))
    assert len(files) == 4
    good = {f: open(f, "rb").read() for f in files}
    open(files[0], "wb").write(b"damaged" * 20)                        # no footer
    open(files[2], "wb").write(good[files[2]][:4] + b"x" * (len(good[files[2]]) - 400) + good[files[2]][-396:])      # a footer, but no rows
    landing.load_raw(spark, base, raw, ckpt, run="one")
    assert landing.raw_rows(spark, raw).count() == 4 and landing.loads(spark, raw) == ["one.0"]
    aside = landing.rejects(spark, raw).collect()
    assert sorted(r["file"].split("/")[-1] for r in aside) == sorted(f.split("/")[-1] for f in (files[0], files[2]))
    assert {(r["load"], r["table_name"]) for r in aside} == {("one.0", "accounts")} and all(r["error"] for r in aside)
    open(files[0], "wb").write(good[files[0]])
    landing.reload_rejected(spark, base, raw, "two")
    assert landing.raw_rows(spark, raw).count() == 6 and landing.loads(spark, raw) == ["one.0", "two.retry"]
    assert [(r["load"], r["file"].split("/")[-1]) for r in landing.rejects(spark, raw).collect()] == [("two.retry", files[2].split("/")[-1])]
    open(files[2], "wb").write(good[files[2]])
    landing.reload_rejected(spark, base, raw, "three")
    landing.reload_rejected(spark, base, raw, "four")                  # nothing is left
    assert sorted(r[0] for r in landing.raw_rows(spark, raw).select("_seq").collect()) == list(range(8)) and landing.rejects(spark, raw).count() == 0


def test_the_fact_reads_new_loads_only(spark):
    """Ten loads in raw, then an eleventh: the second run scans that one partition. A writer that dies takes the same loads again."""
    import pytest

    from bankflow.operators import marts
    from bankflow.operators.published import Published

    raw, target = work_dir(spark, "t-loads-raw"), work_dir(spark, "t-loads-fact")

    def load(n, *rows):
        df = spark.createDataFrame([(json.dumps({"id": i, "created_at": at}), i, i) for i, at in rows], "j string, _ts_ms long, _seq long")
        landing._store_load(df.select(F.lit("transactions").alias("table_name"), F.to_date(F.lit("2024-01-01")).alias("date"), F.parse_json("j").alias("v"),
                                      "_ts_ms", "_seq", F.lit("f").alias("_file")), raw, f"run {n}/{n}.0")

    def ids(df):
        return sorted(int(r[0]) for r in df.select("transaction_id").collect())

    for n in range(10):
        load(n, (n, f"2024-01-{n + 1:02d}T00:00:00"))
    assert len(landing.loads(spark, raw)) == 10
    assert ids(marts.facts_from_raw(spark, raw, target, "2024-02-01")) == list(range(10))
    load(10, (10, "2024-01-20T00:00:00"), (11, None), (12, "2024-01-02T00:00:00"))
    seen, read = [], landing.raw

    def watched(spark, base, table, only=None):
        seen.append(only)
        rows = read(spark, base, table, only)
        assert "PartitionFilters: [" in (plan := rows._jdf.queryExecution().toString())
        assert "(load#" in plan.split("PartitionFilters: [")[1].split("]")[0] and "run 10/10.0" in plan
        return rows

    patch = pytest.MonkeyPatch()
    patch.setattr(marts.landing, "raw", watched)
    try:
        before = Published(spark, target).state().version
        with pytest.raises(ZeroDivisionError):                          # dies before its version is written
            patch.setattr(marts.Published, "publish", lambda *a, **k: 1 / 0)
            marts.facts_from_raw(spark, raw, target, "2024-02-02")
        patch.undo()
        patch.setattr(marts.landing, "raw", watched)
        assert Published(spark, target).state().version == before
        for _ in range(2):                                              # the late row of the strict rule stays out, the untimed one comes in
            assert ids(marts.facts_from_raw(spark, raw, target, "2024-02-02")) == [*range(10), 10, 11]
    finally:
        patch.undo()
    assert seen == [["run 10/10.0"], ["run 10/10.0"]]


def test_fact_batch_replay_takes_its_own_mark(spark):
    """A batch that died is loaded from the mark that it began with, whatever another writer has loaded since; a stream of its own
    begins with the fact's mark, and a batch that is in is not loaded again."""
    import datetime as dt

    from bankflow.operators import marts

    target = work_dir(spark, "t-replay")
    rows = [(f'{{"id": {i}, "created_at": "2024-01-{i:02d}T00:00:00"}}', i, i) for i in range(1, 9)]
    raw = spark.createDataFrame(rows, "j string, _ts_ms long, _seq long").select(F.parse_json("j").alias("v"), "_ts_ms", "_seq")
    marts.facts_from_raw(spark, raw.where("_seq <= 3"), target, "2024-01-04", batch=("s", 0))
    mark = marts.batch_mark(spark, target, ("s", 1))                                       # the batch begins ...
    marts.facts_from_raw(spark, raw.where("_seq = 8"), target, "2024-01-09")               # ... and another writer is faster
    assert mark == dt.datetime(2024, 1, 3)
    out = marts.facts_from_raw(spark, raw.where("_seq > 3"), target, "2024-01-09", batch=("s", 1))
    assert sorted(r[0] for r in out.select("transaction_id").collect()) == [str(i) for i in range(1, 9)]
    more = spark.createDataFrame([('{"id": 20, "created_at": "2024-01-02T00:00:00"}', 20, 20)], "j string, _ts_ms long, _seq long")
    more = more.select(F.parse_json("j").alias("v"), "_ts_ms", "_seq")
    for batch in (("s", 1), ("other", 0)):                             # replayed; late, by another stream
        assert marts.facts_from_raw(spark, more, target, "2024-01-09", batch=batch).count() == 8


def test_repeated_images_are_dropped_by_bounded_state(spark):
    """Seven days, each delivered twice, and one once more much later: the fact of the stream without repeats, by state of some days only. Images
    without an id or a time, with equal ids, or with other content are not taken for repeats."""
    import datetime as dt

    from bankflow.operators import marts

    src, shape = work_dir(spark, "t-rep-src"), "j string, _ts_ms long, _seq long"

    def put(*rows):
        spark.createDataFrame([(json.dumps(r), n, n) for n, r in rows], shape).select(F.parse_json("j").alias("v"), "_ts_ms", "_seq").coalesce(1) \
            .write.mode("append").parquet(src)

    def day(d):
        at = f"2024-01-{d:02d}T00:00:00"
        return [*((10 * d + i, {"id": 10 * d + i, "created_at": at, "status": "PENDING"}) for i in range(5)),
                (10 * d + 7, {"id": 10 * d, "created_at": at, "status": "COMPLETED"})]

    odd = [(1, {"id": 1, "created_at": None}), (2, {"id": None, "created_at": "2024-01-05T00:00:00"}), (None, None), (None, {"id": 3})]
    for d in range(1, 8):
        for _ in range(2):
            put(*day(d), *(odd if d == 1 else []))
    put(*day(2), *odd[:1])
    shape_of = spark.read.parquet(src).schema
    facts, queries = [], []
    for drop, files in ((False, "2"), (True, "1")):        # both images of a day's delivery fall into one batch, or into two
        target, ckpt = work_dir(spark, "t-rep"), work_dir(spark, "t-rep-ckpt")
        stream = spark.readStream.schema(shape_of).option("maxFilesPerTrigger", files).parquet(src)
        queries.append(jobs.run_facts(spark, stream, target, ckpt, "2024-03-01", dt.timedelta(days=1), drop_repeats=drop))
        facts.append(marts.read_target(spark, target).collect())
    ids = [sorted(i for r in f if (i := r["transaction_id"]) is not None) for f in facts]
    assert ids[0] == ids[1] and len(set(ids[0])) == len(ids[0]) == 7 * 5 + 2
    assert [sum(r["txn_status"] == "COMPLETED" for r in f) for f in facts] == [7, 7]
    state = [p["stateOperators"][0] for p in queries[1].recentProgress if p["stateOperators"]]
    assert max(s["numRowsTotal"] for s in state) <= 4 * 6 + len(odd) < 7 * 6
    assert sum(s["customMetrics"]["numDroppedDuplicateRows"] for s in state) >= 7 * 6
    assert sum(s["numRowsDroppedByWatermark"] for s in state) == 6       # the delivery that comes much later


def test_scd2_stream_skips_its_own_batches_only(spark):
    """Steps of other writers and a new checkpoint lose no batch; a batch that was published is not repeated."""
    import datetime as dt

    from bankflow.operators import snapshots
    from bankflow.session import drop_path

    before = [n for n in list_names(spark, f"{checkpoint_root(spark)}/bankflow") if n.startswith("snapshot-")]
    src, snap, ckpt = (work_dir(spark, n) for n in ("t-scd2-src", "t-scd2", "t-scd2-ckpt"))
    shape = "customer_id string, name string, _ts_ms bigint"

    def put(*rows):
        spark.createDataFrame(rows, shape).coalesce(1).write.mode("append").parquet(src)

    def drain(checkpoint):
        jobs.run_scd2(spark, spark.readStream.schema(shape).parquet(src), snap, checkpoint, check_cols=["name"],
                      model=lambda batch, as_of: batch.select("customer_id", "name"))

    def names():
        return sorted(r[0] for r in snapshots.read_snapshot(spark, snap).where("dbt_valid_to is null").select("name").collect())

    for i in (1, 2, 3):
        snapshots.run_snapshot(spark, snap, spark.createDataFrame([("0", f"v{i}")], "customer_id string, name string"), "customer_id", ["name"], dt.datetime(2024, 1, i))
    put(("1", "a", 1704067200000))
    drain(ckpt)
    assert names() == ["a", "v3"]
    put(("2", "b", 1704067200001))
    drain(ckpt)
    assert names() == ["a", "b", "v3"] and snapshots.last_run(spark, snap)[0] == 5
    drop_path(spark, f"{ckpt}/commits/1")                 # published, but not yet done when the stream stopped
    drain(ckpt)
    assert snapshots.last_run(spark, snap)[0] == 5
    drop_path(spark, src)
    put(("3", "c", 1704067200002))
    drain(work_dir(spark, "t-scd2-ckpt2"))
    assert names() == ["a", "b", "c", "v3"]
    left = [n for n in list_names(spark, f"{checkpoint_root(spark)}/bankflow") if n.startswith("snapshot-")]
    assert left == before                                 # no step leaves work folders behind


def test_untimed_transaction_of_an_old_capture_day_is_loaded(spark):
    """Raw with capture dates: a row without a time that arrives after the mark has moved on comes in, once; an old timed one does not."""
    from bankflow.operators import marts

    target = work_dir(spark, "t-untimed")

    def raw(*rows):
        rows = [(json.dumps({"id": i, "created_at": at}), i, i, day) for i, at, day in rows]
        df = spark.createDataFrame(rows, "j string, _ts_ms long, _seq long, date string")
        return df.select(F.parse_json("j").alias("v"), "_ts_ms", "_seq", F.to_date("date").alias("date"))

    first = [(1, "2024-01-01T00:00:00", "2024-01-01"), (2, "2024-01-20T00:00:00", "2024-01-20")]
    marts.facts_from_raw(spark, raw(*first), target, "2024-01-21")
    for _ in range(2):
        out = marts.facts_from_raw(spark, raw(*first, (3, None, "2024-01-02"), (4, "2024-01-02T00:00:00", "2024-01-02")), target, "2024-01-22")
        assert sorted(r[0] for r in out.select("transaction_id").collect()) == ["1", "2", "3"]


def test_posting_stream_equals_one_batch(spark):
    """Requests cut anywhere, a replayed batch and one that died: decisions and balances of one batch with all of them."""
    import random

    import pytest

    from bankflow.operators import posting

    rng = random.Random(5)
    accounts = [(i, 20.0 if i % 3 else 0.0) for i in range(6)] + [(6, None)]
    rows = []
    for i in range(60):
        kind, own = rng.choice(["DEPOSIT", "WITHDRAWAL", "TRANSFER", "TRANSFER"]), rng.choice([*range(7), 99])
        rows.append((i, own, rng.choice([*range(6), 98, None]) if kind == "TRANSFER" else None, kind, float(rng.randint(-1, 30))))
    acc = spark.createDataFrame(accounts, "account_id bigint, balance double").withColumn("balance", F.col("balance").cast("decimal(18,2)"))
    req = spark.createDataFrame(rows, "id bigint, account_id bigint, related_account_id bigint, txn_type string, amount double").select(
        "id", "account_id", "related_account_id", "txn_type", F.col("amount").cast("decimal(18,2)").alias("amount"),
        F.lit("2024-01-01").cast("timestamp_ntz").alias("created_at"))
    key = lambda df: sorted(map(str, df.collect()))
    whole = posting.post_batch(acc, req)
    root = work_dir(spark, "t-books")
    posting.open_accounts(spark, root, acc)
    posting.open_accounts(spark, root, acc)                             # known accounts keep their balance

    def die():
        raise ZeroDivisionError

    for n, (a, b) in enumerate(((0, 1), (1, 25), (25, 44), (44, 60))):
        part = req.where((F.col("id") >= a) & (F.col("id") < b))
        if n == 2:
            with pytest.raises(ZeroDivisionError):
                posting.post_stream_batch(spark, root, part, ("s", n), before_publish=die)
        for _ in range(2):
            posting.post_stream_batch(spark, root, part, ("s", n))
    books = posting.read_books(spark, root)
    assert key(books.decisions.select(*whole.decisions.columns)) == key(whole.decisions)
    assert key(books.ledger.select(*whole.ledger.columns)) == key(whole.ledger) and key(books.closing) == key(whole.closing)
    assert books.decisions.where("accepted").count() > 10 and books.decisions.where("reject_reason = 'INSUFFICIENT_FUNDS'").count() > 3


def test_repeats_are_known_by_their_change_event(spark):
    """An event that comes again in another spelling is a repeat; other events of the same row are not, and without a sequence number the content tells."""
    src, out = work_dir(spark, "t-event-src"), work_dir(spark, "t-event-out")
    at = '"created_at": "2024-01-01T00:00:00"'
    rows = [('{"id": 1, %s, "amount": 1.5}' % at, 5, 1), ('{"id": 1, %s, "amount": "1.5"}' % at, 5, 1), ('{"id": 1, %s, "amount": 1.5}' % at, 5, 2),
            ('{"id": 1, "created_at": "2024-01-01T00:00:01", "amount": 1.5}', 5, 1), ('{"id": 2, %s, "amount": 1.5}' % at, 5, 1),
            ('{"id": 3, %s, "amount": 1.5}' % at, 5, None), ('{"id": 3, %s, "amount": 2.5}' % at, 5, None), ('{"id": 3, %s, "amount": 2.5}' % at, 5, None)]
    spark.createDataFrame(rows, "j string, _ts_ms long, _seq long").select(F.parse_json("j").alias("v"), "_ts_ms", "_seq").coalesce(1).write.parquet(src)
    stream = spark.readStream.schema(spark.read.parquet(src).schema).parquet(src)
    jobs.without_repeats(stream).writeStream.option("checkpointLocation", work_dir(spark, "t-event-ckpt")).trigger(availableNow=True) \
        .start(out).awaitTermination()
    kept = spark.read.parquet(out).select(F.try_variant_get("v", "$.id", "int"), F.try_variant_get("v", "$.created_at", "string"), "_seq").collect()
    assert sorted((i, at[-2:], seq or 0) for i, at, seq in kept) == [(1, "00", 1), (1, "00", 2), (1, "01", 1), (2, "00", 1), (3, "00", 0), (3, "00", 0)]
