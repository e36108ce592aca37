"""Scalar column rules: direction, descriptions, money rounding, text cleanup, defaults."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from bankflow.functions.variant import field_state


def direction_of(txn_type: Column) -> Column:
    """DEPOSIT credits the account; WITHDRAWAL and TRANSFER debit it."""
    return (F.when(txn_type == "DEPOSIT", F.lit("CREDIT"))
            .when(txn_type.isin("WITHDRAWAL", "TRANSFER"), F.lit("DEBIT")))


def capitalize(text: Column) -> Column:
    """First character upper case, the rest lower case."""
    return F.concat(F.upper(F.substring(text, 1, 1)), F.lower(F.substring(text, 2, 1 << 30)))


def money_text(amount: Column) -> Column:
    """Two-decimal text of a money amount ("12.50")."""
    return amount.cast("decimal(18,2)").cast("string")


def describe_txn(txn_type: Column, amount: Column, currency: Column) -> Column:
    """'Deposit of 12.50 USD'."""
    return F.concat(capitalize(txn_type), F.lit(" of "), money_text(amount), F.lit(" "), currency)


def round_down_cents(x: Column) -> Column:
    """Quantize to 0.01 toward zero, on the shortest decimal text of the double.

    A cast to decimal rounds half-up, and ``floor(x*100)`` on the double can
    drop a cent (0.29*100 = 28.999...), so go through the decimal text.
    """
    exact = x.cast("string").cast("decimal(38,20)")
    cents = F.floor(F.abs(exact) * 100)
    return (F.signum(exact).cast("decimal(1,0)") * cents / 100).cast("decimal(18,2)")


def clean_address(text: Column) -> Column:
    """Multi-line postal text on one line."""
    return F.regexp_replace(text, "\n", ", ")


def cut(text: Column, n: int) -> Column:
    """First ``n`` characters."""
    return F.substring(text, 1, n)


def with_default(v: Column, path: str, value: Column, typ: str) -> Column:
    """Column default: applied only when the field is absent, not when it is JSON null."""
    got = F.try_variant_get(v, path, typ)
    return F.when(field_state(v, path) == "absent", value).otherwise(got)


def apply_defaults(df, spec, col: str = "v"):
    """Column defaults for a raw variant table: ``spec`` maps output column ->
    (JSON path, type, default Column); a default fills only an absent field."""
    from pyspark.sql import functions as F

    v = F.col(col)
    return df.select("*", *[with_default(v, path, default, typ).alias(name)
                            for name, (path, typ, default) in spec.items()])
