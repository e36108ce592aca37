"""Corpus pipeline: documents go through five stages, each written and read again before the next one.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of documents.
Toxic documents go; of each group of near copies the one with the least id stays; documents with benchmark passages go; secrets are
replaced by a mark; what is left is encoded. A document without id or text, or with an empty one, is clean and stays. Of rows
that repeat id and text one stays, as of any copies (rows without an id repeat each other if their texts are equal); rows without a text stay.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bankflow.llm import bpe, decontaminate, near_dup, secrets, toxicity
from bankflow.llm.registry import BYTE_RANKS, table
from bankflow.session import cut_lineage


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted toxic."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model, keep=docs.columns).where("predicted = 0").select(*docs.columns)


def _marked(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with a hash of the text under a name it has not yet."""
    name = "text_hash"
    while name in docs.columns:
        name += "_"
    return docs.withColumn(name, F.xxhash64("text")), name


def _without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose id and text (hash) are not in ``gone``, nulls being equal."""
    marked, name = _marked(docs)
    left, right = marked.alias("left"), gone.select("doc_id", name).distinct().alias("right")
    same = (F.col(f"left.{name}") == F.col(f"right.{name}")) & F.col("left.doc_id").eqNullSafe(F.col("right.doc_id"))
    return left.join(right, same, "left_anti").select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies on five-word shingles at 0.8."""
    marked, name = _marked(docs)
    own = f"{name}_own"                              # tells rows without a text apart
    rows = marked.withColumn(own, F.when(F.coalesce(F.length("text"), F.lit(0)) == 0, F.monotonically_increasing_id()))
    once = rows.dropDuplicates(["doc_id", name, own]).select(*docs.columns)
    return _without(once, near_dup.near_duplicates(marked, k=5, keep=[name]).where("not kept"))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of a benchmark item."""
    marked, name = _marked(docs)
    found = decontaminate.contamination(marked, table(spark, sf_dir, "benchmark"), keep=[name])
    return _without(docs, found.where("contaminated"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets replaced by a mark."""
    clean = secrets.redact(secrets.scan(docs))
    return clean.withColumn("n_chars", F.when(F.size("spans") > 0, F.length("text").cast("bigint")).otherwise(F.col("n_chars"))).select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with the offsets by which they decode."""
    return bpe.encode(docs, BYTE_RANKS).select("doc_id", "lang", "source", "n_chars", "n_tokens", "bpe_ids", "bpe_starts")


STAGES = [("toxicity", drop_toxic), ("near_copies", drop_near_copies), ("decontamination", drop_contaminated),
          ("secrets", redact_secrets), ("encoding", encode)]

#: SQL cannot express toxicity and encoding; the pipeline is tested against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = cut_lineage(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
