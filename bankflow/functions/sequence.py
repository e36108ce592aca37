"""Dense sequence numbers without a single-task global window (P13)."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bankflow.schemas import ACCOUNT_NUMBER_PREFIX, ACCOUNT_NUMBER_START
from bankflow.session import cut_lineage, path_exists


def dense_sequence(df: DataFrame, order_cols: list[str], start: int = 1, col: str = "seq") -> DataFrame:
    """Number rows start, start+1, ... in ``order_cols`` order, without gaps.

    Range-partition and sort, tag each row with (partition, position) and store
    that once; then per-partition counts (one row per partition, so their size
    is bounded by the partition count) give each partition's offset.
    """
    ranged = df.repartitionByRange(*order_cols).sortWithinPartitions(*order_cols)
    tagged = cut_lineage(ranged.select("*", F.spark_partition_id().alias("_pid"),
                                       F.monotonically_increasing_id().alias("_mid")), "sequence")
    counts = tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"), F.min("_mid").alias("_first"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_pid", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    return tagged.join(F.broadcast(offsets), "_pid").select(
        *df.columns, (F.lit(start) + F.col("_offset") + F.col("_mid") - F.col("_first")).cast("bigint").alias(col))


def account_numbers(df: DataFrame, order_cols: list[str], start: int = ACCOUNT_NUMBER_START,
                    state: str | None = None) -> DataFrame:
    """'AC' + 10-digit sequence number, in insertion order.

    ``state`` is a folder that keeps the high mark over batches: a batch goes on after the last number given out, so
    numbers neither repeat nor leave a gap. The batch's rows are stored before the mark moves, and the mark is one
    small file per batch, written last."""
    spark = df.sparkSession
    taken = 0
    if state is not None and path_exists(spark, f"{state}/marks"):
        taken = spark.read.schema("n bigint").parquet(f"{state}/marks").agg(F.max("n")).first()[0] or 0
    seq = dense_sequence(df, order_cols, start + taken, "_seq_no")
    numbered = seq.select(*df.columns, F.concat(F.lit(ACCOUNT_NUMBER_PREFIX),
                                                F.lpad(F.col("_seq_no").cast("string"), 10, "0")).alias("account_number"))
    if state is None:
        return numbered
    path = f"{state}/batches/{uuid.uuid4().hex}"      # of this try; only marks count
    numbered.write.mode("overwrite").parquet(path)
    stored = spark.read.parquet(path)
    new = stored.count()
    if new:
        spark.createDataFrame([(taken + new,)], "n bigint").coalesce(1).write.mode("overwrite").parquet(f"{state}/marks/after={taken}")
    return stored
