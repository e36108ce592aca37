"""Steps whose cost has to follow the input: what they do, counted, and that their results stay the same."""

from pyspark.sql import functions as F

from bankflow.operators import posting
from bankflow.plans import fixtures as fx, queries
from bankflow.session import work_dir, write_text
from bankflow.sources import cdc, landing
from bankflow.streaming import jobs
from tests.conftest import SF_SMALL
from tests.test_posting import check, hovering


def test_hot_account_takes_one_round(spark, monkeypatch):
    assert check(spark, *hovering(2_000), partitions=6).rounds == 1             # however many range partitions its legs lie in
    monkeypatch.setattr(posting, "LEGS_PER_RUN", 700)
    assert 1 < check(spark, *hovering(2_000), partitions=12).rounds <= 6        # a run ends with the bucket that fills it


ENVELOPES = [('banking_server.public.accounts', '{"payload":{"before":null,"after":{"id":1},"op":"c","ts_ms":5,"seq":1}}'),
             ('banking_server.public.accounts', '{"payload":null,"before":{"id":2},"after":null,"op":"d","ts_ms":6,"seq":2}'),
             ('customers', '{"before":null,"after":{"name":"x"},"op":"u","ts_ms":7,"seq":3}'),
             ('a.customers', '{"before":null,"after":{},"op":"u","ts_ms":8,"seq":4}'), ('a.customers', 'no json'), (None, None)]


def _plan(df, capsys) -> str:
    capsys.readouterr()
    df.explain()
    return capsys.readouterr().out


def test_upserts_parse_each_envelope_once(spark, tmp_path, capsys):
    spark.createDataFrame(ENVELOPES, cdc.EVENT_SCHEMA).write.parquet(str(tmp_path / "log"))
    kept = cdc.keep_upserts(cdc.decode(spark.read.parquet(str(tmp_path / "log")))).select("table_name", "op", "_seq")
    assert sorted(map(tuple, kept.collect())) == [("accounts", "c", 1), ("customers", "u", 3)]
    assert _plan(kept, capsys).count("parseJson") == 1


def test_raw_is_stored_without_what_it_drops(spark):
    raw = cdc.materialize_raw(spark.createDataFrame(ENVELOPES, cdc.EVENT_SCHEMA))
    assert sorted(r["_seq"] for r in raw.collect()) == [1, 3]
    assert set(spark.read.parquet(*raw.inputFiles()).columns) == {"table_name", "v", "_ts_ms", "_seq", "_file"}


def test_small_files_are_written_by_many_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(landing, "FILES_PER_TASK", 2)
    value = F.concat(F.lit('{"before":null,"after":{"id":1},"op":"c","ts_ms":5,"seq":'), F.col("id").cast("string"), F.lit("}"))
    topic = F.when(F.col("id") < 200, "x.customers").when(F.col("id") < 320, "x.others")      # and 30 without a topic
    base = str(tmp_path / "landing")
    landing.write_landing(cdc.decode(spark.range(350).coalesce(1).select(topic.alias("topic"), value.alias("value"))), base, {"customers": 10})
    landed = landing.landed(spark, base)
    assert sorted(r[0] for r in landed.select("_seq").collect()) == list(range(350))
    sizes = {r["table_name"]: r["most"] for r in landing.file_rows(spark, base).groupBy("table_name").agg(F.max("rows").alias("most")).collect()}
    assert sizes["customers"] <= 10 and sizes["others"] <= 50 and sizes[None] <= 50
    writers = {f.split("/part-")[1][:5] for f in landed.where("table_name = 'customers'").inputFiles()}
    assert len(writers) > 1        # 20 files of one day, in ten cells


def test_days_are_cut_without_parsing(spark, capsys):
    days = queries._two_days(spark, SF_SMALL)
    ts_ms = F.regexp_extract("value", '"ts_ms":([0-9]+)', 1).cast("bigint")
    first, second = (d.agg(F.count(F.lit(1)), F.min(ts_ms), F.max(ts_ms)).first() for d in days)
    assert first[2] < fx.DAY2_MS <= second[1]
    assert first[0] + second[0] == fx.change_log(spark, SF_SMALL).count()
    assert "get_json_object" not in _plan(days[0], capsys)


def test_event_files_may_be_parquet(spark, tmp_path):
    spark.createDataFrame(ENVELOPES, cdc.EVENT_SCHEMA).write.parquet(str(tmp_path / "events"))
    jobs.run_landing(spark, str(tmp_path / "events"), str(tmp_path / "landing"), str(tmp_path / "ckpt"), {"format": "parquet"})
    landed = landing.upserts(spark.read.parquet(str(tmp_path / "landing")))
    assert sorted(map(tuple, landed.select("table_name", "_seq").collect())) == [("accounts", 1), ("customers", 3)]


def test_row_images_are_stored_whole(spark):
    import pyarrow.parquet as pq

    raw = cdc.materialize_raw(spark.createDataFrame(ENVELOPES, cdc.EVENT_SCHEMA))
    stored = [str(pq.ParquetFile(f.removeprefix("file:")).schema) for f in raw.inputFiles()]
    assert stored and all("metadata" in s and "typed_value" not in s for s in stored)


def test_a_file_without_footer_costs_no_second_write(spark, monkeypatch):
    base, raw, ckpt = (work_dir(spark, f"t-foot-{n}") for n in ("landing", "raw", "ckpt"))
    landing.write_landing(cdc.decode(spark.createDataFrame(ENVELOPES[:3], cdc.EVENT_SCHEMA)), base)
    write_text(spark, f"{base}/table_name=accounts/date=1970-01-01/kind=upsert/part-bad.parquet", "this is no parquet file")
    written, write = [], landing._write_load
    monkeypatch.setattr(landing, "_write_load", lambda rows, *to: (written.append(to), write(rows, *to)))
    landing.load_raw(spark, base, raw, ckpt)
    assert len(written) == 1
    assert sorted(r["_seq"] for r in landing.raw_rows(spark, raw).collect()) == [1, 3]
    assert [r["file"].split("/")[-1] for r in landing.rejects(spark, raw).collect()] == ["part-bad.parquet"]


def test_models_read_once_are_not_stored(spark, monkeypatch):
    twice = lambda c: spark.createDataFrame([("1",), ("1",), ("2",), (None,)], f"{c} string")

    class Inp:
        log_raw = staticmethod(lambda tables: None)
        stg_customers = staticmethod(lambda: twice("customer_id"))
        stg_accounts = staticmethod(lambda: twice("account_id"))
        stg_transactions = staticmethod(lambda mode: twice("transaction_id"))
        stg_ledger = staticmethod(lambda: twice("id"))

    stored, cut = [], queries.cut_lineage
    monkeypatch.setattr(queries, "cut_lineage", lambda df, name: (stored.append(name), cut(df, name))[1])
    assert sorted((r["model"], r["failures"]) for r in queries._by_test(Inp, "unique").collect()) == [
        ("stg_accounts", 1), ("stg_customers", 1), ("stg_ledger_entries", 1), ("stg_transactions", 1)]
    assert stored == []


def test_rows_of_one_small_file_are_built_by_many_tasks(spark, tmp_path):
    sf, key = str(tmp_path), F.col("id")
    spark.range(200_000).coalesce(1).select(
        key.alias("c_custkey"), F.concat(F.lit("Customer#"), key.cast("string")).alias("c_name"), (key % 2).cast("int").alias("c_nationkey"),
        (key / 7).alias("c_acctbal"), F.lit("BUILDING").alias("c_mktsegment")).write.parquet(f"{sf}/customer.parquet")
    spark.sql("select 0 n_nationkey, 'N' n_name, 0 n_regionkey").write.parquet(f"{sf}/nation.parquet")
    spark.sql("select 0 r_regionkey, 'R' r_name").write.parquet(f"{sf}/region.parquet")
    for rows, n in ((fx.customer_rows(spark, sf), 200_000), (fx.account_rows(spark, sf), 400_000)):
        tasks = rows.groupBy(F.spark_partition_id().alias("task")).count().collect()
        assert sum(r["count"] for r in tasks) == n
        assert len(tasks) > 1
