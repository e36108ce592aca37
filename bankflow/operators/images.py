"""Staging models that are kept up to date load by load instead of being rebuilt from all of raw.

A model is a published table (``operators.published``). A run flattens the loads that the model has not taken yet and nothing else. Of a
model with a key, the stored rows of the loads' buckets are compared with the new images, and only those that win are written, as a
keyed segment; a model of every image just gets another segment, and the results of its data tests are kept with it
(``operators.kept_checks``). Rows and the names of the loads taken are published together, so a
run that dies takes the same loads again and one without loads writes nothing.

The result is that of the whole rebuild (``operators.staging``): same rows, and the load time of the last run on all of them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from bankflow import schemas as S
from bankflow.functions.variant import flatten
from bankflow.operators import kept_checks
from bankflow.operators.published import Keyed, Published, level_of
from bankflow.operators.staging import LINEAGE, cdc_tiebreak, latest_per_key, with_load_ts
from bankflow.session import cut_lineage, drops_own_work
from bankflow.sources import landing

ROWS = "rows"      # the kind of segments


@dataclass(frozen=True)
class Model:
    """How a staging model comes from raw. ``key``: keep the latest image per key, by ``created_at``; None keeps every image."""

    table: str
    spec: list
    key: str | None = None

    @property
    def columns(self) -> list[str]:
        return [name for name, _, _ in self.spec]

    def images(self, raw: DataFrame) -> DataFrame:
        flat = flatten(raw, self.spec, keep=LINEAGE if self.key else None)
        return latest_per_key(flat, self.key, self.order(), cdc_tiebreak()) if self.key else flat

    @staticmethod
    def order() -> list:
        return [F.col("created_at").desc_nulls_first()]


MODELS = {
    "stg_customers": Model("customers", S.STG_CUSTOMERS_SPEC, "customer_id"),
    "stg_accounts": Model("accounts", S.STG_ACCOUNTS_SPEC, "account_id"),
    "stg_transactions": Model("transactions", S.STG_TRANSACTIONS_SPEC),
    "stg_ledger_entries": Model("ledger_entries", S.STG_LEDGER_SPEC),
}


def winners(stored: DataFrame, images: DataFrame, model: Model) -> DataFrame:
    """The new images (one per key) that come later than the stored row of their key; of equal ones the stored row stays."""
    both = stored.withColumn("_new", F.lit(False)).unionByName(images.withColumn("_new", F.lit(True)))
    w = Window.partitionBy(model.key).orderBy(*model.order(), *cdc_tiebreak(), F.col("_new"))
    return both.withColumn("_rn", F.row_number().over(w)).where((F.col("_rn") == 1) & F.col("_new")).drop("_rn", "_new")


@drops_own_work
def take_loads(spark: SparkSession, raw: str, path: str, name: str, as_of, before_publish=None) -> int:
    """Bring the model at ``path`` up to date with the complete loads of raw; returns its version. ``before_publish`` is called
    just before the run shows (for tests of a writer that dies there)."""
    model, table = MODELS[name], Published(spark, path)
    state = table.state()
    have = set(state.info.get("loads", []))
    loads = [n for n in landing.loads(spark, raw) if n not in have]
    if not loads and "schema" in state.info:
        return table.publish(state, as_of=str(as_of)).version if state.info.get("as_of") != str(as_of) else state.version
    images = model.images(landing.raw(spark, raw, model.table, loads))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in images.schema)
    news = {"loads": loads, "schema": schema, "as_of": str(as_of)}
    added: dict[str, dict] = {}
    if model.key:
        keyed = Keyed(table, ROWS, model.key, schema)
        images = cut_lineage(images, "images")
        if state.of(ROWS):
            images = cut_lineage(winners(keyed.read(state, keyed.buckets_of(state, images)), images, model), "images-new")
        if rows := images.count():
            added = keyed.write(state, images, rows)
        compact = keyed.compact
    else:
        [(segment, about)] = table.write(images, ROWS).items()
        stored = spark.read.schema(schema).parquet(f"{path}/{segment}")
        rows = stored.count()          # from the footers
        checks, news["repeated"] = kept_checks.of_load(table, state, stored, name)
        added = {segment: {**about, "rows": rows, "level": level_of(rows)}, **checks}
        compact = lambda after: kept_checks.compact(table, table.compact(after, ROWS, schema), name)
    if before_publish is not None:
        before_publish()
    return compact(table.publish(state, added, **news)).version


def read_model(spark: SparkSession, path: str, name: str, since: int = 0) -> DataFrame:
    """The model's rows. ``since``: of a model with a key, only those that came after that version; segments without any are not opened."""
    model, table = MODELS[name], Published(spark, path)
    state = table.state()
    if "schema" not in state.info:
        raise ValueError(f"{path} has not been run yet")
    schema = state.info["schema"]
    if model.key:
        rows = Keyed(table, ROWS, model.key, schema).read(state, since=since)
    else:
        rows = table.read(state, ROWS, schema)
    return with_load_ts(rows, state.info["as_of"]).select(*model.columns, "load_timestamp")


def kept(spark: SparkSession, path: str, name: str) -> tuple[int, DataFrame]:
    """Of a model of every image: the number of its rows and the results of its data tests, from what is kept of each load."""
    table = Published(spark, path)
    state = table.state()
    return sum(about["rows"] for about in state.of(ROWS).values()), kept_checks.results(table, state, name)
