"""Landing files, raw tables and the load report.

Landing: decoded events as Parquet, partitioned by table, capture day and kind
(``<base>/table_name=<t>/date=<YYYY-MM-DD>/kind=upsert|delete|bad/``). The row image
is kept as a VARIANT column ``v``, not as inferred columns, so files never drift
in schema. Deletes and events that are no JSON are kept apart by the ``kind``
partition instead of a filter: Spark pushes a filter on a decoded column below
the decode and would parse every envelope again, while a partition column costs
nothing to write and is pruned on read. Readers take ``kind=upsert`` only; a bad
event keeps its text in ``v``. An event without a capture time lands on the
landing run's own day.
Raw: the same rows, loaded exactly once per file by a file stream with a
checkpoint (``availableNow``): each micro-batch owns a partition ``load=<run>.<batch>``,
which a repeated batch overwrites, and which counts as complete once its name stands
under ``_loads`` (written last). A file that cannot be read does not keep the others
out: it is set aside under ``_rejects`` with its error, nothing of it is loaded, and
``reload_rejected`` takes it in once it has been mended.
"""

from __future__ import annotations

import datetime as dt
import json
import re
from urllib.parse import quote, unquote

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bankflow.schemas import DEFAULT_FLUSH_SIZE
from bankflow.session import cut_lineage, drop_path, list_names, path_exists, read_text, write_text
from bankflow.sources import small_files

EPOCH_NTZ = "1970-01-01 00:00:00"
PARTITIONS = ["table_name", "date", "kind"]
LANDING_SCHEMA = "v variant, _ts_ms bigint, _seq bigint, op string, table_name string, date date, kind string"
RAW_SCHEMA = "v variant, _ts_ms bigint, _seq bigint, _file string, load string, table_name string, date date"
FILES_PER_TASK = 500     # small files that one task writes, where a flush size makes many of them
MOST_REJECTS = 20        # unreadable files of a load; each costs another try, and with more of them the load as a whole is at fault


def capture_day(as_of: dt.date | str | None = None, ts_ms_col: str = "_ts_ms"):
    """Day of capture; ``as_of`` (default: today) for an event that does not say."""
    own = F.to_date(F.timestamp_add("MILLISECOND", F.col(ts_ms_col), F.lit(EPOCH_NTZ).cast("timestamp_ntz")))
    return F.coalesce(own, F.current_date() if as_of is None else F.lit(as_of).cast("date"))


def landing_rows(decoded: DataFrame, as_of: dt.date | str | None = None) -> DataFrame:
    """Decoded events with their capture day and kind, ready to land (no row is filtered)."""
    bad = F.col("_bad").isNotNull()
    kind = F.when(bad, F.lit("bad")).when(F.col("_upsert"), F.lit("upsert")).otherwise(F.lit("delete"))
    return decoded.select("table_name", capture_day(as_of).alias("date"), kind.alias("kind"),
                          F.when(bad, F.col("_bad").cast("variant")).otherwise(F.col("after")).alias("v"),
                          "_ts_ms", "_seq", "op")


def upserts(df: DataFrame) -> DataFrame:
    """The upsert part of landed rows (partition pruning on ``kind``)."""
    return df.where(F.col("kind") == "upsert").drop("kind")


def write_landing(decoded: DataFrame, base: str, flush_sizes: dict[str, int] | None = None,
                  as_of: dt.date | str | None = None) -> None:
    """Land decoded events. Rows are clustered by (table, day) with a REBALANCE,
    which AQE splits when one table-day is skewed, so files stay few but no
    task has to hold a hot day alone.

    ``flush_sizes`` caps rows per file per table (the reference flushes 10
    customers or 50 other rows per file; tables it does not name get
    ``DEFAULT_FLUSH_SIZE``); at scale leave it unset or large. The work then follows
    the files, not the bytes, so a table-day is cut into cells of ``FILES_PER_TASK`` files, and on a mounted file
    system tasks create them without Hadoop (``small_files``).
    """
    rows = landing_rows(decoded, as_of)
    if not flush_sizes:
        (rows.hint("rebalance", *PARTITIONS).write.mode("append").partitionBy(*PARTITIONS).parquet(base))
        return
    rows = cut_lineage(rows, "landing-stage")
    by_size: dict[int, list[str]] = {}
    for table, size in flush_sizes.items():
        by_size.setdefault(int(size), []).append(table)
    named = F.coalesce(F.col("table_name").isin(*flush_sizes), F.lit(False))
    parts = [(size, F.col("table_name").isin(*tables)) for size, tables in by_size.items()]
    counts = cut_lineage(rows.groupBy(*PARTITIONS).agg(F.count(F.lit(1)).alias("_rows")), "landing-counts")   # a row per table, day and kind
    least, root = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), small_files.mounted(rows.sparkSession, base)
    for size, mine in [*parts, (DEFAULT_FLUSH_SIZE, ~named)]:
        of = counts.where(mine).select(*[F.col(c).alias(f"_{c}") for c in PARTITIONS], F.ceil(F.col("_rows") / (size * FILES_PER_TASK)).alias("_cells"), "_rows")
        files = of.agg(F.sum(F.ceil(F.col("_rows") / size))).first()[0]
        if not files:
            continue
        same = [rows[c].eqNullSafe(of[f"_{c}"]) for c in PARTITIONS]
        cell = F.pmod(F.monotonically_increasing_id(), F.col("_cells"))
        dealt = (rows.where(mine).join(F.broadcast(of), same).withColumn("_cell", cell)
                 .repartition(max(least, files // FILES_PER_TASK + 1), *PARTITIONS, "_cell").select(*rows.columns))
        if root is not None and size <= small_files.MOST_ROWS:
            small_files.write(dealt, PARTITIONS, size, root)
        else:
            dealt.write.mode("append").option("maxRecordsPerFile", size).partitionBy(*PARTITIONS).parquet(base)


def landed(spark: SparkSession, base: str) -> DataFrame:
    """Everything that has landed; no file is opened for its schema."""
    return spark.read.schema(LANDING_SCHEMA).parquet(base)


def scan_landing(spark: SparkSession, base: str, table: str, day: str) -> DataFrame:
    """One table's upserts of one capture day; all three predicates prune directories."""
    return upserts(landed(spark, base)
                   .where((F.col("table_name") == table) & (F.col("date") == F.lit(day).cast("date"))))


def file_rows(spark: SparkSession, base: str) -> DataFrame:
    """Rows per landed upsert file (for flush-size checks)."""
    root = small_files.mounted(spark, base)
    if root is not None and path_exists(spark, base) and not path_exists(spark, f"{base}/_spark_metadata"):       # a stream's log says which files count
        return small_files.row_counts(spark, root, "table_name=*/date=*/kind=upsert").withColumnRenamed("value", "table_name")
    df = upserts(landed(spark, base))
    return df.groupBy("table_name", F.col("_metadata.file_path").alias("file")).agg(
        F.count(F.lit(1)).alias("rows"))


def load_raw(spark: SparkSession, landing: str, raw: str, checkpoint: str, day: str | None = None,
             run: str | None = None) -> None:
    """Copy landed files into the raw table, each once: the checkpoint remembers which.

    ``day`` loads that capture day only (a partition filter on the landing root,
    whose commit log is honoured) and keeps its progress in a checkpoint of its
    own, so the files of other days stay unloaded. ``run`` labels this load in
    the report (default: the day, else "all")."""
    rows = spark.readStream.schema(LANDING_SCHEMA).parquet(landing).where(F.col("kind") == "upsert")
    if day is not None:
        rows, checkpoint = rows.where(F.col("date") == F.lit(day).cast("date")), f"{checkpoint}/day={day}"
    rows = _raw_columns(rows)

    def store(batch: DataFrame, batch_id: int) -> None:
        _store_load(batch, raw, f"{run or day or 'all'}.{batch_id}", lambda: _batch_files(spark, checkpoint, batch_id), landing, day)

    q = rows.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()


def _raw_columns(rows: DataFrame) -> DataFrame:
    return rows.select("table_name", "date", "v", "_ts_ms", "_seq", F.col("_metadata.file_path").alias("_file"))


def _unreadable(error: Exception) -> str | None:
    """The file that an error is about, if it is about reading one."""
    found = re.search(r"FAILED_READ_FILE\S* Encountered error while reading file ([a-z][a-z0-9+.-]*:/\S*?)[.]?\s", f"{error} ")
    return found and found[1]


def _batch_files(spark: SparkSession, checkpoint: str, batch_id: int) -> list[str]:
    """The files of a micro-batch, from the stream's own log of the files it has taken."""
    folder = f"{checkpoint}/sources/0"
    names = [n for n in list_names(spark, folder) if re.fullmatch(r"\d+([.]compact)?", n) and int(n.split(".")[0]) >= batch_id]
    entries = [json.loads(line) for n in names for line in read_text(spark, f"{folder}/{n}").split("\n")[1:] if line]
    return sorted({e["path"] for e in entries if e["batchId"] == batch_id})


def _landing_files(spark: SparkSession, landing: str, files: list[str], day: str | None = None) -> DataFrame:
    """The raw rows of some landed files."""
    if not files:
        return spark.createDataFrame([], RAW_SCHEMA).select("table_name", "date", "v", "_ts_ms", "_seq", "_file")
    rows = spark.read.schema(LANDING_SCHEMA).option("basePath", landing).parquet(*map(unquote, files)).where(F.col("kind") == "upsert")
    return _raw_columns(rows if day is None else rows.where(F.col("date") == F.lit(day).cast("date")))


def _write_load(rows: DataFrame, raw: str, name: str) -> None:
    (rows.withColumn("load", F.lit(name)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("load", "table_name", "date").parquet(raw))


def _store_load(rows: DataFrame, raw: str, name: str, files_of=None, landing: str = "", day: str | None = None) -> None:
    """Write one load, without the files that cannot be read, which are noted; then mark it as complete. After an error the load's
    other files (``files_of`` names all) are read by name. Damaged footers show when the rows are counted, before any row is written; a
    file that turns out to be damaged further in costs another write."""
    spark, bad, good = rows.sparkSession, {}, rows
    while True:
        try:
            good.count()          # from the footers
            _write_load(good, raw, name)
            break
        except (PySparkException, Py4JJavaError) as error:              # inside a stream's callback it is the latter
            file = _unreadable(error)
            if file is None or file in bad or len(bad) == MOST_REJECTS or files_of is None:
                raise
            bad[file] = re.search(r"\[FAILED_READ_FILE.*", str(error))[0][:500]
            aside = {unquote(f) for f in bad}
            good = _landing_files(spark, landing, [f for f in files_of() if unquote(f) not in aside], day)
    _note_rejects(spark, raw, name, bad)
    write_text(spark, f"{raw}/_loads/{quote(name, safe='')}", "")


def _note_rejects(spark: SparkSession, raw: str, name: str, bad: dict[str, str]) -> None:
    path = f"{raw}/_rejects/{quote(name, safe='')}.json"
    if bad:
        write_text(spark, path, json.dumps(bad))
    else:
        drop_path(spark, path)


def _rejected(spark: SparkSession, raw: str) -> dict[str, dict[str, str]]:
    """Per load the files that are set aside, with their errors."""
    return {unquote(n[:-5]): json.loads(read_text(spark, f"{raw}/_rejects/{n}")) for n in list_names(spark, f"{raw}/_rejects") if n.endswith(".json")}


def rejects(spark: SparkSession, raw: str) -> DataFrame:
    """(load, table_name, file, error) of the files that are set aside."""
    rows = [(load, unquote(m[1]) if (m := re.search(r"/table_name=([^/]*)/", file)) else None, file, error)
            for load, files in _rejected(spark, raw).items() for file, error in files.items()]
    return spark.createDataFrame(rows, "load string, table_name string, file string, error string")


def reload_rejected(spark: SparkSession, landing: str, raw: str, run: str) -> None:
    """Load the files that are set aside, as a load of ``run``, as far as they can be read by now."""
    before = _rejected(spark, raw)
    files = sorted({f for files in before.values() for f in files})
    if not files:
        return
    name = f"{run}.retry"
    if name in loads(spark, raw):
        raise ValueError(f"run {run} has reloaded files already")
    _store_load(_landing_files(spark, landing, files), raw, name, lambda: files, landing)
    for load in before:                              # those that are still unreadable stand under the new load
        _note_rejects(spark, raw, load, {})


def loads(spark: SparkSession, raw_base: str) -> list[str]:
    """Names of the loads that are complete in raw (``load`` partitions), sorted."""
    if path_exists(spark, f"{raw_base}/_loads"):
        return sorted(unquote(n) for n in list_names(spark, f"{raw_base}/_loads") if not n.startswith("."))
    return sorted(unquote(n[5:]) for n in list_names(spark, raw_base) if n.startswith("load="))     # raw from before the marks


def raw_rows(spark: SparkSession, raw_base: str) -> DataFrame:
    """The raw rows of all tables."""
    return spark.read.schema(RAW_SCHEMA).parquet(raw_base)


def raw(spark: SparkSession, raw_base: str, table: str, only: list[str] | None = None) -> DataFrame:
    """``source('raw', table)``: the raw rows of one table, of some loads if they are named, with their capture ``date`` as a partition."""
    rows = raw_rows(spark, raw_base).where(F.col("table_name") == table)
    if only is not None:
        rows = rows.where(F.col("load").isin(only) if only else F.lit(False))
    return rows.drop("table_name", "load")


def load_report(spark: SparkSession, raw_base: str, run: str | None = None) -> DataFrame:
    """Files and rows loaded per table, by one run (its label) or by all."""
    rows = raw_rows(spark, raw_base)
    if run is not None:
        rows = rows.where(F.col("load").startswith(f"{run}."))
    return rows.groupBy("table_name").agg(F.count_distinct("_file").alias("files"), F.count(F.lit(1)).alias("rows"))


def report_text(report: DataFrame) -> str:
    """A short message on one load: a line per table (the report has one row per table)."""
    lines = [f"{r['table_name']}: {r['rows']} rows from {r['files']} files"
             for r in report.orderBy("table_name").collect()]
    return "\n".join(["This load brought", *lines]) if lines else "This load brought nothing new."
