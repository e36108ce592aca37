"""Change events: read (batch / stream), decode, unwrap, drop deletes, route by topic.

An event is ``(topic string, value string)`` where ``value`` is a JSON envelope
``{"before":..,"after":..,"op":..,"ts_ms":..,"seq":..}``, either bare or inside
``{"payload": ...}``. Decoding happens on executors (``try_parse_json``:
malformed JSON becomes NULL instead of failing the job).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bankflow.schemas import TABLES, TOPIC_PREFIX

EVENT_SCHEMA = T.StructType([
    T.StructField("topic", T.StringType()),
    T.StructField("value", T.StringType()),
])


def topics(tables=TABLES) -> list[str]:
    return [TOPIC_PREFIX + t for t in tables]


def read_cdc_batch(spark: SparkSession, path: str) -> DataFrame:
    """Bounded event files (JSON lines ``{"topic":..,"value":..}``) → decoded events."""
    return decode(spark.read.schema(EVENT_SCHEMA).json(path))


def read_cdc_stream(spark: SparkSession, source: str, opts: dict | None = None,
                    tables=TABLES) -> DataFrame:
    """Unbounded events from Kafka (``source="kafka"``) or from a folder of event files: JSON lines, or with the
    option ``format`` the same (topic, value) records as e.g. Parquet, which is compressed and can still be read in parts.

    Kafka: subscribe to the four table topics from the earliest offset; the
    Kafka connector jar must be on the cluster's classpath.
    """
    opts = dict(opts or {})
    if source == "kafka":
        reader = (spark.readStream.format("kafka")
                  .option("subscribe", ",".join(topics(tables)))
                  .option("startingOffsets", "earliest"))
        for key, value in opts.items():
            reader = reader.option(key, value)
        raw = reader.load().select(F.col("topic"), F.col("value").cast("string").alias("value"))
    else:
        reader = spark.readStream.schema(EVENT_SCHEMA).format(opts.pop("format", "json"))
        for key, value in opts.items():
            reader = reader.option(key, value)
        raw = reader.load(source)
    return decode(raw)


def route_topic(topic: Column) -> Column:
    """Table name = last dot-separated part of the topic."""
    return F.substring_index(topic, ".", -1)


def _present(x: Column, field: str | None = None, path: str = "$") -> Column:
    """Truthy envelope part at ``path``: a non-empty JSON object (SQL NULL, JSON null and ``{}`` are not).

    A named field that has a value settles it without building a map or copying the part; else the
    object's keys are counted (NULL for anything that is not an object).
    """
    count = F.coalesce(F.size(F.try_variant_get(x, path, "map<string,variant>")) > 0, F.lit(False))
    if field is None:
        return count
    return F.when(F.try_variant_get(x, f"{path}.{field}", "string").isNotNull(), F.lit(True)).otherwise(count)


ENVELOPE_FIELDS = [("op", "string"), ("before", "variant"), ("after", "variant"),
                   ("ts_ms", "bigint"), ("seq", "bigint")]


def decode(events: DataFrame) -> DataFrame:
    """Parse each envelope once and unwrap it (``payload`` if truthy, else the event).

    Output: table_name, op, before, after (variants), _ts_ms, _seq,
    ``_upsert`` (``after`` is truthy) and ``_bad`` (the text of an event that
    is no JSON). No row is filtered here: a filter on a derived column is
    pushed below the projection and would parse again.
    """
    parsed = events.select(route_topic(F.col("topic")).alias("table_name"),
                           F.try_parse_json(F.col("value")).alias("_event"), F.col("value").alias("_text"))
    ev = F.col("_event")
    wrapped = _present(ev, "op", "$.payload")
    picked = parsed.select("table_name", ev.alias("_event"), wrapped.alias("_wrapped"),
                           F.when(ev.isNull(), F.col("_text")).alias("_bad"))
    out = [F.when(F.col("_wrapped"), F.try_variant_get(ev, f"$.payload.{name}", typ))
           .otherwise(F.try_variant_get(ev, f"$.{name}", typ))
           .alias(name if name in ("op", "before", "after") else f"_{name}")
           for name, typ in ENVELOPE_FIELDS]
    fields = picked.select("table_name", *out, "_bad")
    return fields.select("*", _present(F.col("after"), "id").alias("_upsert"))


def keep_upserts(decoded: DataFrame) -> DataFrame:
    """Drop deletes and tombstones: keep rows whose ``after`` is truthy.

    Of an upsert a one-element array is exploded, of anything else none. A filter on the flag would be pushed below
    the decode, whose expressions it would hold in full, and parse each envelope once for every part of the condition."""
    upsert = F.col("_upsert") if "_upsert" in decoded.columns else _present(F.col("after"))
    kept = F.explode(F.when(upsert, F.array(F.lit(True)))).alias("_kept")
    return decoded.select("*", kept).drop("_kept")


def to_raw(decoded: DataFrame, file_col: Column | None = None) -> DataFrame:
    """Upserts as raw rows: ``v`` = the row image, plus CDC lineage."""
    up = keep_upserts(decoded)
    return up.select(
        "table_name",
        F.col("after").alias("v"),
        "_ts_ms",
        "_seq",
        (file_col if file_col is not None else F.lit(None).cast("string")).alias("_file"),
    )


def materialize_raw(events: DataFrame) -> DataFrame:
    """Decode an event log once and keep its upserts as a stored raw table (all topics).

    The raw rows alone are written out (reliable, in the shared checkpoint folder):
    ``keep_upserts`` parses every envelope exactly once, and later extractions read
    a stored variant.
    """
    from bankflow.session import cut_lineage

    return cut_lineage(to_raw(decode(events)), "decoded")
