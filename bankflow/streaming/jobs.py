"""Structured Streaming jobs.

R1 events -> landing, R2 landing -> raw (see ``sources.landing.load_raw``),
R3 raw transactions -> incremental fact, R5 customer images -> SCD2 snapshot,
L7 posting requests -> decisions, ledger and balances.
Each keeps its progress in a checkpoint under the shared checkpoint folder and
runs until its input is drained (``available_now``) or goes on (a trigger
interval). ``foreachBatch`` sinks are safe on replay: what a micro-batch changes is
published at once with its stream (the query id of the checkpoint) and batch id,
and a batch that has been published is not repeated. Other writers and streams do
not count, so several may feed one table.
"""

from __future__ import annotations

import datetime as dt
import json
import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bankflow.functions.variant import vget
from bankflow.operators.marts import facts_from_raw
from bankflow.operators.posting import post_stream_batch
from bankflow.operators.snapshots import batch_published, last_run, run_snapshot
from bankflow.operators.staging import stg_customers
from bankflow.schemas import CUSTOMER_CHECK_COLS, STG_TRANSACTIONS_SPEC
from bankflow.sources.cdc import read_cdc_stream
from bankflow.session import read_text
from bankflow.sources.landing import PARTITIONS, landing_rows


def _start(writer, checkpoint: str, available_now: bool, processing_time: str | None, path: str | None = None):
    writer = writer.option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=processing_time or "10 seconds")
    q = writer.start() if path is None else writer.start(path)
    if available_now:
        q.awaitTermination()
    return q


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id of the query that a checkpoint belongs to."""
    return json.loads(read_text(spark, f"{checkpoint}/metadata"))["id"]


def run_landing(spark: SparkSession, source: str, base: str, checkpoint: str, opts: dict | None = None,
                max_records_per_file: int | None = None, available_now: bool = True,
                processing_time: str | None = None):
    """R1: change events -> landing Parquet (exactly once through the file sink's log). Rows are clustered by their
    partition per micro-batch, with a spread that keeps a hot table-day on several tasks, so a batch writes few files."""
    rows = landing_rows(read_cdc_stream(spark, source, opts))
    rows = rows.repartition(*PARTITIONS, F.pmod(F.xxhash64("_seq"), F.lit(4)))
    w = rows.writeStream.format("parquet").partitionBy(*PARTITIONS)
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", int(max_records_per_file))
    return _start(w, checkpoint, available_now, processing_time, base)


def without_repeats(stream: DataFrame, allowed_lateness: dt.timedelta | None = None) -> DataFrame:
    """A stream of raw transactions without the images that have come before, as far as the late-data rule could still admit them.

    An image is known by its id and its change event: time, capture time and sequence number, on which the load orders the images of a
    transaction (between images that are equal in all of them it takes any). Only an image without a capture time or sequence number is
    known by its content, as writing that out takes longer than all else here. Its state is kept until the watermark (the latest transaction
    time of the batches before, less the lateness) has passed its time by the lateness once more, so the state follows the
    rows of twice the lateness, not of the stream. The watermark also takes out rows that are too late. All images of a
    transaction must have the same time: then each time that moves the watermark is in the fact, whose high-water mark is as
    late, so nothing is taken out that the rule would let in. Rows without an id, of which a load keeps one, neither move the
    watermark nor fall out; without a time, repeats fall out within a batch. The load decides on those."""
    spec = {name: (path, typ) for name, path, typ in STG_TRANSACTIONS_SPEC}
    v = F.col("v")
    txn_id, at = vget(v, *spec["transaction_id"]), vget(v, *spec["txn_time"]).cast("timestamp")
    content = F.when(F.col("_ts_ms").isNull() | F.col("_seq").isNull(), F.to_json("v"))
    image = [F.coalesce(c.cast("string"), F.lit("-")) for c in (F.col("_ts_ms"), F.col("_seq"), at, content)]
    own = {"_txn_at": F.when(txn_id.isNotNull(), at), "_txn_key": F.coalesce(txn_id, F.concat(F.lit("none "), F.uuid())),
           "_txn_image": F.md5(F.concat_ws(" ", *image))}
    delay = math.ceil((allowed_lateness or dt.timedelta(0)).total_seconds())
    return (stream.withColumns(own).withWatermark("_txn_at", f"{delay} seconds")
            .dropDuplicatesWithinWatermark(["_txn_key", "_txn_image"]).drop(*own))


def run_facts(spark: SparkSession, stream: DataFrame, target: str, checkpoint: str, as_of,
              allowed_lateness: dt.timedelta | None = None, available_now: bool = True,
              processing_time: str | None = None, drop_repeats: bool = False):
    """R3: each micro-batch of raw transactions -> staging (latest image) -> fact load. ``drop_repeats``: images that come again (a source
    that delivers at least once) are taken out ahead of the load, by state that the lateness bounds; the fact is the same. A checkpoint
    belongs to one of the two ways."""
    if drop_repeats:
        stream = without_repeats(stream, allowed_lateness)

    def load(batch: DataFrame, batch_id: int) -> None:
        facts_from_raw(batch.sparkSession, batch, target, as_of, allowed_lateness, batch=(stream_id(batch.sparkSession, checkpoint), batch_id))

    return _start(stream.writeStream.foreachBatch(load), checkpoint, available_now, processing_time)


def batch_as_of(batch: DataFrame):
    """A batch's as_of: just after its latest change event (from the data, not the clock)."""
    latest = batch.agg(F.max("_ts_ms")).first()[0]
    return None if latest is None else dt.datetime(1970, 1, 1) + dt.timedelta(milliseconds=int(latest), microseconds=1)


def run_scd2(spark: SparkSession, stream: DataFrame, snapshot: str, checkpoint: str, key: str = "customer_id",
             check_cols: list[str] | None = None, model=stg_customers, available_now: bool = True,
             processing_time: str | None = None):
    """R5: each micro-batch of raw row images -> staging -> one snapshot step. A batch whose events are no later than the
    last step gets the next microsecond after it; one that was published before a restart is skipped. It is known by its own
    marker (the query id of the checkpoint and the batch id), whoever else steps the snapshot."""
    cols = check_cols or CUSTOMER_CHECK_COLS

    def step(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        as_of, own = batch_as_of(batch), (stream_id(session, checkpoint), batch_id)
        if as_of is None or batch_published(session, snapshot, *own):
            return
        last = last_run(session, snapshot)
        if last and as_of <= last[1]:
            as_of = last[1] + dt.timedelta(microseconds=1)
        run_snapshot(session, snapshot, model(batch, as_of), key, cols, as_of, batch_of=own)

    return _start(stream.writeStream.foreachBatch(step), checkpoint, available_now, processing_time)


def run_posting(spark: SparkSession, stream: DataFrame, root: str, checkpoint: str, available_now: bool = True,
                processing_time: str | None = None):
    """L7: each micro-batch of posting requests is posted against the balances that the batches before it left (``operators.posting``)."""
    def post(batch: DataFrame, batch_id: int) -> None:
        post_stream_batch(batch.sparkSession, root, batch, (stream_id(batch.sparkSession, checkpoint), batch_id))

    return _start(stream.writeStream.foreachBatch(post), checkpoint, available_now, processing_time)
