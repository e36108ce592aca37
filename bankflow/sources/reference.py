"""Inline reference data (S10)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from bankflow.schemas import CURRENCIES


def currencies(spark: SparkSession) -> DataFrame:
    """The currency list (code, name): three rows, so it is always safe to broadcast."""
    return spark.createDataFrame(CURRENCIES, "code string, name string")
