"""SCD2 snapshots with the "check" strategy.

A snapshot is a published table (``operators.published``) of two kinds: ``closed`` versions, only ever added to, and ``open`` ones, keyed:
a run adds the versions it opened, and of a key's rows the latest counts. So a run writes what has changed, however large the
snapshot is; small segments are merged by levels; a run shows with the log file that it publishes last. One that dies leaves nothing that
anybody reads, and one without changes adds no rows.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bankflow.operators.published import Keyed, Published
from bankflow.schemas import SNAPSHOT_META
from bankflow.session import cut_lineage, drops_own_work

STAMP = "yyyy-MM-dd HH:mm:ss.SSSSSS"
OPEN, CLOSED = "open", "closed"


def scd_id(key: Column, valid_from: Column) -> Column:
    """Version id: md5 of key and validity start (to the microsecond)."""
    return F.md5(F.concat_ws("|", key.cast("string"), F.date_format(valid_from, STAMP)))


def changed(a_cols: list[Column], b_cols: list[Column]) -> Column:
    """Any check column differs, NULL-safe (NULL -> value is a change)."""
    diff = F.lit(False)
    for a, b in zip(a_cols, b_cols):
        diff = diff | ~a.eqNullSafe(b)
    return diff


def _open_version(source: DataFrame, key: str, as_of: Column) -> DataFrame:
    return source.select(
        "*",
        scd_id(F.col(key), as_of).alias("dbt_scd_id"),
        as_of.alias("dbt_updated_at"),
        as_of.alias("dbt_valid_from"),
        F.lit(None).cast("timestamp_ntz").alias("dbt_valid_to"),
    )


def scd2_changes(open_rows: DataFrame | None, source: DataFrame, key: str, check_cols: list[str], as_of) -> DataFrame:
    """What one snapshot step changes: closed versions and new open ones, told apart by ``is_open``.

    open_rows: the snapshot's open rows (source columns + meta), or None on the
    first run. source: the model to snapshot, unique on ``key``.
    * new key -> open row; changed check column -> close old (valid_to = as_of)
      and open a new version; unchanged check columns -> old row kept as is,
      even if other columns moved; key gone from source -> stays open.
    """
    as_of_col = F.lit(as_of).cast("timestamp_ntz")
    cols = source.columns
    if open_rows is None:
        return _open_version(source, key, as_of_col).withColumn("is_open", F.lit(True))
    old = open_rows.select(*[F.col(c).alias("o_" + c) for c in cols + SNAPSHOT_META])
    new = source.select(*[F.col(c).alias("n_" + c) for c in cols])
    j = new.join(old, F.col("o_" + key) == F.col("n_" + key), "left")
    is_new = F.col("o_" + key).isNull()
    diff = changed([F.col("o_" + c) for c in check_cols], [F.col("n_" + c) for c in check_cols])
    j = j.where(is_new | diff)
    closed = j.where(~is_new).select(*[F.col("o_" + c).alias(c) for c in cols + SNAPSHOT_META]).withColumn("dbt_valid_to", as_of_col)
    opened = _open_version(j.select(*[F.col("n_" + c).alias(c) for c in cols]), key, as_of_col)
    return closed.withColumn("is_open", F.lit(False)).unionByName(opened.withColumn("is_open", F.lit(True)))


def check_source(source: DataFrame, key: str) -> None:
    """Raise unless every row has a key of its own."""
    bad = source.groupBy(key).count().where((F.col("count") > 1) | F.col(key).isNull()).limit(1).collect()
    if bad:
        raise ValueError(f"snapshot source is not unique on {key}: {bad[0][0]!r} in {bad[0][1]} rows")


# ------------------------------------------------------------------ storage
def last_run(spark: SparkSession, root: str) -> tuple[int, dt.datetime] | None:
    """(number, as_of) of the last published run."""
    info = Published(spark, root).state().info
    return (info["runs"], dt.datetime.fromisoformat(info["as_of"])) if info.get("runs") else None


def taken(spark: SparkSession, root: str) -> dict:
    """What the last published run has noted besides its rows."""
    return Published(spark, root).state().info


def batch_published(spark: SparkSession, root: str, stream: str, batch: int) -> bool:
    """Whether a micro-batch of a stream has published its run; runs of other writers and streams do not count."""
    return Published(spark, root).state().batch_done(stream, batch)


def _schema(root_schema) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in root_schema)


def read_snapshot(spark: SparkSession, root: str) -> DataFrame | None:
    """All versions of the published runs; None before the first."""
    table = Published(spark, root)
    state = table.state()
    if not state.info.get("runs"):
        return None
    closed, opened = table.read(state, CLOSED, state.info["schema"]), Keyed(table, OPEN, state.info["key"], state.info["schema"]).read(state)
    return opened if closed is None else closed.unionByName(opened)


@drops_own_work
def run_snapshot(spark: SparkSession, root: str, source: DataFrame, key: str, check_cols: list[str], as_of,
                 batch_of: tuple[str, int] | None = None, **taken) -> DataFrame:
    """Apply one snapshot step to the table at ``root`` and return the whole snapshot. ``as_of`` must be later than that of
    the run before; the source must be unique on ``key`` (both are checked). An empty source is a run without changes.
    ``batch_of`` (stream id, batch id) is published with a step that a micro-batch makes, as is ``taken``. Only the buckets of the source's keys are read."""
    as_of = as_of if isinstance(as_of, dt.datetime) else dt.datetime.fromisoformat(str(as_of))
    table = Published(spark, root)
    state = table.state()
    before = state.info.get("as_of")
    if before is not None and as_of <= dt.datetime.fromisoformat(before):
        raise ValueError(f"as_of {as_of} is not later than that of the last run, {before}")
    source = cut_lineage(source, "snapshot-source")
    check_source(source, key)
    shape = _schema(_open_version(source.limit(0), key, F.lit(as_of).cast("timestamp_ntz")).schema)
    news = {"runs": state.info.get("runs", 0) + 1, "as_of": as_of.isoformat(), "key": key, "schema": shape, **taken}
    if batch_of is not None:
        news["streams"] = {batch_of[0]: batch_of[1]}
    opened = Keyed(table, OPEN, key, shape)
    known = opened.read(state, opened.buckets_of(state, source)) if state.of(OPEN) else None
    changes = cut_lineage(scd2_changes(known, source, key, check_cols, as_of), "snapshot-changes")
    counts = {r["is_open"]: r["count"] for r in changes.groupBy("is_open").count().collect()}       # two rows
    added = {}
    if counts.get(True):
        added |= opened.write(state, changes.where("is_open").drop("is_open"), counts[True])
    if counts.get(False):
        added |= table.write(changes.where("not is_open").drop("is_open"), CLOSED, rows=counts[False])
    state = table.publish(state, added, **news)
    table.compact(opened.compact(state), CLOSED, shape)
    return read_snapshot(spark, root)
