"""Dashboard KPIs over the current dimension rows and the transaction fact.

Sums are exact (DECIMAL); an average is one division of two exact integers
(cents and count) done in double, so any engine gets the same bits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MONEY = "decimal(38,2)"


def _money_sum(c: Column) -> Column:
    return F.sum(c.cast("decimal(18,2)")).cast(MONEY)


def _money_avg(c: Column) -> Column:
    cents = F.sum(c.cast("decimal(18,2)") * 100).cast("double")
    return cents / (F.count(c) * 100).cast("double")


def current(dim: DataFrame) -> DataFrame:
    return dim.where(F.col("is_current"))


def total_balance(dim_accounts: DataFrame) -> DataFrame:
    return current(dim_accounts).agg(_money_sum(F.col("balance")).alias("total_balance"))


def total_transactions(facts: DataFrame) -> DataFrame:
    return facts.agg(F.count(F.lit(1)).alias("total_transactions"))


def avg_balance(dim_accounts: DataFrame) -> DataFrame:
    return current(dim_accounts).agg(_money_avg(F.col("balance")).alias("avg_balance"))


def total_accounts(dim_accounts: DataFrame) -> DataFrame:
    return current(dim_accounts).agg(F.count_distinct("account_id").alias("total_accounts"))


def total_customers(dim_customers: DataFrame) -> DataFrame:
    return current(dim_customers).agg(F.count_distinct("customer_id").alias("total_customers"))


def amount_over_time(facts: DataFrame, grain: str = "day") -> DataFrame:
    period = F.date_trunc(grain, F.col("txn_time")).cast("timestamp_ntz")
    return (facts.groupBy(period.alias("period"))
            .agg(_money_sum(F.col("amount")).alias("total_amount"), F.count(F.lit(1)).alias("txn_count")))


def avg_balance_by_type(dim_accounts: DataFrame) -> DataFrame:
    return (current(dim_accounts).groupBy("account_type")
            .agg(_money_avg(F.col("balance")).alias("avg_balance"), F.count(F.lit(1)).alias("accounts")))


def amount_by_txn_type(facts: DataFrame) -> DataFrame:
    return (facts.groupBy("txn_type")
            .agg(_money_sum(F.col("amount")).alias("total_amount"), F.count(F.lit(1)).alias("txn_count")))


def customer_balance(dim_customers: DataFrame, dim_accounts: DataFrame) -> DataFrame:
    """Balance per current customer over their current accounts.

    Accounts are summed per customer first (partial aggregation before the
    shuffle), then matched to current customers on the same key.
    """
    per_customer = (current(dim_accounts).groupBy("customer_id")
                    .agg(_money_sum(F.col("balance")).alias("total_balance"),
                         F.count(F.lit(1)).alias("accounts")))
    customers = current(dim_customers).select("customer_id").distinct()
    return per_customer.join(customers, "customer_id", "inner")
