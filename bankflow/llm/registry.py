"""Queries of the training-data operators, each over whole tables with production parameters, and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bankflow.llm import bpe, decontaminate, fim, hard_negatives, imatch, language, near_dup, quality, secrets, token_files, toxicity, url_lists, warc
from bankflow.llm.sql import ORACLE  # noqa: F401
from bankflow.session import work_dir

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
BYTE_RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
END_ID = 2


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document inside passages of benchmark items, and the items found."""
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the token files of all documents, read them back: place, count and checksum of each."""
    folder = work_dir(spark, "tokens")
    token_files.write(table(spark, sf_dir, "documents"), folder, WORD_BPE, END_ID)
    sums = token_files.checksums(token_files.read_tokens(spark, folder), ["row"])
    return token_files.read_index(spark, folder).join(sums, "row").select("doc_id", "start", "n_tokens", "ids_crc32")


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document: counts of the base kinds, their digest, and all spans."""
    found = secrets.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    count = lambda kind: F.size(F.filter("base_spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")
    return found.select("doc_id", count("assign"), count("access"), count("hex"),
                        F.sha2(secrets.digest(F.col("base_spans")), 256).alias("base_sha256"), secrets.digest(F.col("spans")).alias("spans"))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archive all pages and read the archives back."""
    folder = work_dir(spark, "warc")
    warc.write(table(spark, sf_dir, "pages"), folder)
    return warc.read(spark, folder).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op5_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repetition measures and verdict of every document."""
    return quality.repetition(table(spark, sf_dir, "documents"), keep=["doc_id"])


def url_captures(pages: DataFrame) -> DataFrame:
    """Captures with a fetch time that follows from the page id: one of the 366 days of 2024, some hour."""
    day = F.pmod(F.col("page_id") * 7919 + 13, F.lit(366)).cast("int")
    hour = F.pmod(F.col("page_id") * 31, F.lit(24)).cast("int")
    at = F.timestamp_seconds(F.lit(1704067200) + day.cast("bigint") * 86400 + hour.cast("bigint") * 3600)
    return pages.select("page_id", "url", at.cast("timestamp_ntz").alias("fetched"))


# Lists: name, whether of whole hosts or of the first path segments below them, and of how many keys one is on it.
LISTS = [("block", "host", 3), ("allow", "path", 5), ("block", "path", 7)]


def url_entries(pages: DataFrame) -> DataFrame:
    """Dated list entries that follow from the hosts of all pages and the first path segment below each."""
    host, path = url_lists.host_of(F.col("url")), F.array_remove(F.split(url_lists.path_of(F.col("url")), r"[/\\]"), "")
    below = F.when(F.size(path) > 0, F.concat_ws("/", host, F.get(path, F.lit(0))))
    keys = pages.where(F.length(host) > 0).select(F.explode(F.array(
        F.struct(F.lit("host").alias("kind"), host.alias("key")), F.struct(F.lit("path").alias("kind"), below.alias("key")))).alias("k"))
    keys = keys.select("k.kind", "k.key").where("key is not null").distinct()
    number = lambda a: F.conv(F.substring(F.md5("key"), a, 4), 16, 10).cast("int")
    date = lambda d: F.date_add(F.lit("2024-01-01").cast("date"), d.cast("int"))
    h, gap, first = number(1), F.pmod(number(5), F.lit(90)) + 1, F.pmod(number(9), F.lit(300))
    events = [("add", first, F.lit(True)), ("remove", first + gap, F.pmod(h, F.lit(2)) == 0), ("add", first + gap + 20, F.pmod(h, F.lit(4)) == 0)]
    present = lambda columns: F.filter(F.array(*columns), lambda e: e.isNotNull())
    lists = present([F.when((F.col("kind") == kind) & (F.pmod(h, F.lit(every)) == 0), F.lit(name)) for name, kind, every in LISTS])
    dated = present([F.when(cond, F.struct(F.lit(action).alias("action"), date(day).alias("day"))) for action, day, cond in events])
    return keys.select("key", F.explode(lists).alias("list"), dated.alias("e")).select("list", "key", F.explode("e").alias("e")).select("list", "key", "e.action", "e.day")


def op6_url_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page judged by the list entries active when it was fetched."""
    pages = table(spark, sf_dir, "pages")
    return url_lists.evaluate(url_captures(pages), url_entries(pages)).select(
        "page_id", "matched_key", "matched_list", F.col("listed_from").cast("string").alias("listed_from"), "blocked")


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the ids of every document and of what they decode to."""
    coded = bpe.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), BYTE_RANKS).drop("text")
    decoded = bpe.decode(coded, BYTE_RANKS)
    return decoded.select("doc_id", "n_tokens", F.sha2("bpe_ids", 256).alias("ids_sha256"),
                          F.sha2("decoded", 256).alias("decoded_sha256"))


def op8_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of near copies on two-word shingles at 0.8."""
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"), k=2)


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document."""
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model, keep=["doc_id"]).select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document."""
    docs = table(spark, sf_dir, "documents")
    found = language.predict(docs, language.learn(docs), keep=["doc_id"])
    return found.select("doc_id", language.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of the anchors among all embeddings; a seventh of the labels are moved on by one."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(table(spark, sf_dir, "embeddings").withColumn("label", label), F.col("vec_id") % 100 == 0)


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every document's transformed text and of what it restores to."""
    out = fim.fill_in_middle(table(spark, sf_dir, "documents").select("doc_id", "text"), keep=["doc_id"])
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                      F.sha2(fim.restore(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


def op13_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text."""
    return imatch.edited_fingerprints(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_decontaminate, op2_token_files, op3_secrets, op4_warc, op5_repetition, op6_url_lists,
                                   op7_byte_bpe, op8_near_dup, op9_toxicity, op10_language, op11_hard_negatives, op12_fill_in_middle, op13_imatch)}
