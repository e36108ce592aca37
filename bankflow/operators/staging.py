"""Staging models: flatten raw variant rows, stamp load time, keep the latest image per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bankflow import schemas as S
from bankflow.functions.variant import flatten

LINEAGE = ["_ts_ms", "_seq"]


def with_load_ts(df: DataFrame, as_of) -> DataFrame:
    """Audit column: the load time, passed in (not the clock) so reruns agree."""
    return df.withColumn("load_timestamp", F.lit(as_of).cast("timestamp_ntz"))


def latest_per_key(df: DataFrame, key, order: list[Column], tiebreak: list[Column] | None = None) -> DataFrame:
    """Top-1 row per key by ``order`` then ``tiebreak`` (``ROW_NUMBER() ... = 1``).

    Catalyst plans this as a per-key ``WindowGroupLimit`` on both sides of the
    shuffle, so only one candidate per key and map task crosses the network.
    """
    keys = [key] if isinstance(key, str) else list(key)
    w = Window.partitionBy(*keys).orderBy(*(order + (tiebreak or [])))
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def cdc_tiebreak() -> list[Column]:
    """Versions with equal business time: the later change event wins."""
    return [F.col("_ts_ms").desc_nulls_last(), F.col("_seq").desc_nulls_last()]


def stg_customers(raw: DataFrame, as_of, strict: bool = False) -> DataFrame:
    flat = flatten(raw, S.STG_CUSTOMERS_SPEC, strict=strict, keep=LINEAGE)
    latest = latest_per_key(flat, "customer_id", [F.col("created_at").desc_nulls_first()], cdc_tiebreak())
    return with_load_ts(latest, as_of).select(*S.STG_CUSTOMERS_COLS)


def stg_accounts(raw: DataFrame, as_of, strict: bool = False) -> DataFrame:
    # Ordered by the cast timestamp: a variant cannot be sorted, and text order
    # of ISO stamps with varying fraction digits is not time order.
    flat = flatten(raw, S.STG_ACCOUNTS_SPEC, strict=strict, keep=LINEAGE)
    latest = latest_per_key(flat, "account_id", [F.col("created_at").desc_nulls_first()], cdc_tiebreak())
    return with_load_ts(latest, as_of).select(*S.STG_ACCOUNTS_COLS)


def stg_transactions(raw: DataFrame, as_of, mode: str = "latest", strict: bool = False,
                     newer_than=None) -> DataFrame:
    """``mode="latest"``: one row per transaction (the posting update wins over the
    insert image); ``mode="as_written"``: every image, as the reference model does.
    ``newer_than`` keeps later transactions (and those without a time) only; all images of one
    have the same time, so it is applied before the shuffle."""
    flat = flatten(raw, S.STG_TRANSACTIONS_SPEC, strict=strict, keep=LINEAGE)
    if newer_than is not None:
        flat = flat.where(F.col("txn_time").isNull() | (F.col("txn_time") > F.lit(newer_than).cast("timestamp_ntz")))
    if mode == "latest":
        flat = latest_per_key(flat, "transaction_id", [F.col("txn_time").desc_nulls_first()], cdc_tiebreak())
    elif mode != "as_written":
        raise ValueError(f"unknown mode {mode!r}")
    return with_load_ts(flat, as_of).select(*S.STG_TRANSACTIONS_COLS)


def stg_ledger_entries(raw: DataFrame, as_of, strict: bool = False) -> DataFrame:
    flat = flatten(raw, S.STG_LEDGER_SPEC, strict=strict, keep=LINEAGE)
    return with_load_ts(flat, as_of).select(*S.STG_LEDGER_COLS)
