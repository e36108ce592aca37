"""Files of a few rows, created and counted by the tasks themselves, against Spark's own writer and reader."""

import os

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from bankflow.plans import queries
from bankflow.sources import cdc, landing, small_files

ROWS = "cast(v as string) v", "_ts_ms", "_seq", "op", "table_name", "date", "kind"


def _events(spark):
    """Three tables (one with a name that folders escape), events without a table, deletes, bad events, two days, one of them far off."""
    n = F.col("id")
    after = F.when(n % 11 == 3, F.lit("null")).otherwise(F.concat(F.lit('{"id":'), n.cast("string"), F.lit("}")))
    ms = F.when(n % 13 == 4, F.lit(10 ** 15)).otherwise(n)
    value = F.concat(F.lit('{"before":null,"after":'), after, F.lit(',"op":"c","ts_ms":'), ms.cast("string"), F.lit(',"seq":'), n.cast("string"), F.lit("}"))
    topic = F.when(n < 200, "x.customers").when(n < 320, "x.o=t/h e%r's").when(n < 330, "x.")
    return cdc.decode(spark.range(350).select(topic.alias("topic"), F.when(n % 7 == 0, "oops").otherwise(value).alias("value")))


def _names(base: str) -> list[str]:
    return sorted(os.path.join(at, n) for at, _, names in os.walk(base) for n in names)


def _rows(df) -> list[str]:
    return sorted(map(str, df.selectExpr(*ROWS).collect()))


def test_same_rows_folders_and_counts_as_spark(spark, tmp_path, monkeypatch):
    ours, theirs = f"{tmp_path}/own x%41ü", f"{tmp_path}/spark"
    sizes = {"customers": 10}
    assert small_files.mounted(spark, ours) == ours
    landing.write_landing(_events(spark), ours, sizes, as_of="2024-03-05")
    counted = sorted(map(str, landing.file_rows(spark, ours).collect()))
    monkeypatch.setattr(small_files, "mounted", lambda *_: None)
    landing.write_landing(_events(spark), theirs, sizes, as_of="2024-03-05")
    near = "date < '2100-01-01'"
    assert _rows(landing.landed(spark, ours).where(near)) == _rows(landing.landed(spark, theirs).where(near))
    assert {os.path.dirname(n)[len(ours):] for n in _names(ours)} == {os.path.dirname(n)[len(theirs):] for n in _names(theirs)}
    assert any("date=+33658" in n for n in _names(ours))                                  # a day that Python has no date for
    assert counted == sorted(map(str, landing.file_rows(spark, ours).collect()))          # with the names that Spark gives them
    assert counted and all(r["rows"] <= (10 if r["table_name"] == "customers" else 50) for r in landing.file_rows(spark, ours).collect())
    inferred = spark.read.parquet(ours).schema
    assert inferred["v"].dataType.simpleString() == "variant" and [f.dataType for f in inferred] == [f.dataType for f in spark.read.parquet(theirs).schema]


def test_spark_writes_no_small_file_itself(spark, tmp_path, monkeypatch):
    written, rows = [], landing.cut_lineage(_events(spark).where("table_name = 'customers'"), "t-small")
    monkeypatch.setattr(landing, "cut_lineage", lambda df, name: df)
    monkeypatch.setattr(type(rows), "write", property(lambda df: written.append(df)))       # any use of Spark's writer fails
    landing.write_landing(rows, str(tmp_path / "landing"), {"customers": 10})
    assert written == [] and len(_names(str(tmp_path / "landing"))) > 40
    assert "Scan parquet" not in landing.file_rows(spark, str(tmp_path / "landing"))._jdf.queryExecution().toString()


def test_checksums_are_those_of_hadoop(spark, tmp_path, monkeypatch):
    base = str(tmp_path / "landing")
    landing.write_landing(_events(spark), base, {"customers": 10})
    bad = next(n for n in _names(base) if n.endswith(".parquet") and "table_name=customers/date=1970-01-01/kind=upsert" in n)
    with monkeypatch.context() as m:
        m.setattr(small_files, "mounted", lambda *_: None)
        landing.write_landing(_events(spark), base, {"customers": 10})
    files = [n for n in _names(base) if n.endswith(".parquet")]
    for name in files:
        with open(name, "rb") as f, open(f"{os.path.dirname(name)}/.{os.path.basename(name)}.crc", "rb") as sums:
            assert small_files._checksums(f.read()) == sums.read()
    with open(bad, "r+b") as f:
        f.seek(30)
        byte = f.read(1)
        f.seek(30)
        f.write(bytes([byte[0] ^ 1]))
    with pytest.raises(Exception, match="FAILED_READ_FILE"):
        spark.read.schema("v variant, _seq bigint").parquet(bad).selectExpr("max(cast(v as string))", "max(_seq)").collect()


def test_files_larger_than_small_are_left_to_spark(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(small_files, "write", None)
    base = str(tmp_path / "landing")
    landing.write_landing(_events(spark).where("table_name = 'customers'"), base, {"customers": small_files.MOST_ROWS + 1})
    assert landing.landed(spark, base).count() == 200


def test_a_failed_write_leaves_nothing(spark, tmp_path):
    base, codec = str(tmp_path / "landing"), "spark.sql.parquet.compression.codec"
    rows = landing.landing_rows(_events(spark))
    before = spark.conf.get(codec)
    try:
        spark.conf.set(codec, "lzo")          # not to be had
        with pytest.raises(Exception, match="(?i)lzo"):
            small_files.write(rows, landing.PARTITIONS, 10, base)
    finally:
        spark.conf.set(codec, before)
    assert _names(base) == []


def test_moves_may_run_again_and_miss_no_folder(tmp_path):
    own, base = tmp_path / "staged" / "attempt", tmp_path / "base"
    (own / "kind=upsert").mkdir(parents=True)
    for name in ("a.parquet", ".a.parquet.crc"):
        (own / "kind=upsert" / name).write_text(name)
    batch = pa.RecordBatch.from_pydict({"folder": [str(own)]})
    for _ in range(2):
        assert list(small_files._mover(str(base))(iter([batch]))) == [batch]
        assert [os.path.basename(n) for n in _names(str(base))] == [".a.parquet.crc", "a.parquet"]
    with pytest.raises(FileNotFoundError):
        list(small_files._mover(str(base))(iter([pa.RecordBatch.from_pydict({"folder": [str(own) + "x"]})])))


def test_counts_follow_the_log_of_a_stream(spark, tmp_path, monkeypatch):
    base = str(tmp_path / "landing")
    landing.write_landing(_events(spark), base, {"customers": 10})
    os.makedirs(f"{base}/_spark_metadata")
    monkeypatch.setattr(small_files, "row_counts", None)
    landing.file_rows(spark, base)


@pytest.mark.parametrize("name", ["cdc_flush_batches", "landing_unlisted_table"])
def test_queries_count_names_in_several_tasks(spark, name, monkeypatch):
    made, counts = [], small_files.row_counts
    monkeypatch.setattr(small_files, "row_counts", lambda *a: made.append(counts(*a)) or made[-1])
    rows = queries.QUERIES[name](spark, "/root/testdata/sf0.001").collect()
    assert len(rows) == 4 and all(r["oversize_files"] == 0 for r in rows)
    assert made[0].rdd.getNumPartitions() > 1
