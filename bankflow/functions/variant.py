"""Schema-on-read helpers over a VARIANT column (``v:path::type``)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_INT_SCHEMAS = ("TINYINT", "SMALLINT", "INT", "BIGINT")


def vget(v: Column, path: str, typ: str, strict: bool = False) -> Column:
    """``v:path::typ``. Missing field or JSON null gives NULL.

    ``strict=False`` turns a bad cast into NULL; ``strict=True`` raises, as a
    warehouse cast does. Dates arrive as days since the epoch (an integer) or
    as ISO text; both are decoded.
    """
    get = F.variant_get if strict else F.try_variant_get
    if typ == "date":
        field = F.variant_get(v, path, "variant")
        as_days = F.date_from_unix_date(get(v, path, "int"))
        is_int = F.schema_of_variant(field).isin(*_INT_SCHEMAS)
        return F.when(field.isNull(), F.lit(None).cast("date")).when(is_int, as_days).otherwise(get(v, path, "date"))
    return get(v, path, typ)


def flatten(df: DataFrame, spec, col: str = "v", strict: bool = False, keep: list[str] | None = None) -> DataFrame:
    """Extract every spec field in ONE projection so the variant is read once per row.

    ``spec`` is a list of (output column, JSON path, type); ``keep`` names
    pass-through columns (CDC lineage) to carry along.
    """
    v = F.col(col)
    fields = [vget(v, path, typ, strict).alias(name) for name, path, typ in spec]
    return df.select(*fields, *[F.col(c) for c in (keep or [])])


def field_state(v: Column, path: str) -> Column:
    """'absent', 'null' or 'value' for a field: a default applies only when absent."""
    field = F.variant_get(v, path, "variant")
    return (F.when(field.isNull(), F.lit("absent"))
            .when(F.is_variant_null(field), F.lit("null"))
            .otherwise(F.lit("value")))
