"""Token-id files: Parquet list columns that can be read selectively (operator 2).

``write`` encodes every text, appends an end id and writes Parquet in ascending id order: ``tokens/`` holds
(id, n_tokens, ids list<int>), ``index/`` holds (id, start, n_tokens). Token ids are dictionary encoded
while the dictionary fits its page, else the version-2 writer falls back to delta encoding; row groups and pages have
fixed sizes and carry column and offset indexes, so that a read by id range or of the metadata alone skips the
pages and columns it does not need (``read_tokens``, ``read_index``).

The encoder gives the library each distinct run of non-white characters once and keeps the result: the tokenizers
used here drop white space before splitting, so the ids of a text are those of its runs in order. Likewise a run of
Latin letters with punctuation behind it is two words, the first without regard to case. ``check_tokenizer``
refuses a tokenizer for which that does not hold.

Defined cases: a null or empty text has the end id only; rows with equal ids lie side by side in the order in which they
are read; a null id sorts first; an empty table gives files without rows; columns other than id and text are not
written.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from bankflow.llm.arrow_text import append_columns, gather

# Fixed file layout.
ROW_GROUP_BYTES = 32 << 20
PAGE_BYTES = 256 << 10
PAGE_ROWS = 2000
DICTIONARY_BYTES = 1 << 20

CACHE_RUNS = 3 << 18     # distinct runs remembered by a worker; beyond it the cache starts anew
RUN_BYTES = 1 << 20      # bytes of text that a worker encodes at a time
RUN = re.compile(r"[^ \t\n\r\x0b\x0c]+")


def split_runs(text: str | None) -> list[str]:
    """Runs of non-white characters. ``str.split`` knows the tokenizer's white space and four control characters more."""
    if not text:
        return []
    if "\x1c" in text or "\x1d" in text or "\x1e" in text or "\x1f" in text:
        return RUN.findall(text)
    return text.split()


def check_tokenizer(path: str) -> None:
    """Raise unless white space separates tokens and is dropped, and letters are lowered (on which ``Encoder`` relies)."""
    with open(path) as f:
        spec = json.load(f)
    split = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [{}])[0]
    kinds = {n["type"] for n in (spec.get("normalizer") or {}).get("normalizers", [])}
    if split.get("type") != "Split" or split.get("behavior") != "Removed" or not split.get("invert") \
            or kinds - {"NFC", "Replace", "Lowercase"} or "Lowercase" not in kinds:
        raise ValueError("this tokenizer keeps white space or capitals; its texts cannot be encoded run by run")


# A run of Latin letters and of punctuation behind them is split there by the tokenizer, whatever the case of the letters.
PUNCTUATION = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
LATIN = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]+")
JOINED = 1000            # words that the library gets in one text
EMPTY, END = 0, 1        # the first two words: no ids, and the end id
END_RUN = ""             # the run that stands for the end of a text


class Runs(dict):
    """Slot of each run; runs met for the first time get the next one and are listed."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, run: str) -> int:
        slot = self[run] = len(self)
        self.new.append(run)
        return slot


class Encoder:
    """The library's encoder with a cache: a run is one or two words; words and runs are places in flat arrays of ids."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        check_tokenizer(path)
        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = True   # such strings in a text are ordinary text
        vocabulary = self.library.get_vocab(with_added_tokens=False)
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends_word[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.reset()

    def reset(self) -> None:
        self.runs = Runs()
        self.words: dict[str, int] = {}
        self.flat, self.start, self.length = array("i", [0]), array("q", [0, 0]), array("i", [0, 1])     # of words
        self.run_flat, self.run_start, self.run_length = array("i"), array("q"), array("i")              # of runs
        self.runs[END_RUN] = 0
        self._runs_of([END, EMPTY])

    def _runs_of(self, parts: list[int]) -> None:
        """Ids of new runs, given two words each."""
        words = np.array(parts, np.int64)
        lengths = np.frombuffer(self.length, np.int32)[words].astype(np.int64)
        ids = gather(np.frombuffer(self.flat, np.int32), np.frombuffer(self.start, np.int64)[words], lengths)
        per_run = lengths.reshape(-1, 2).sum(axis=1)
        self.run_start.frombytes((len(self.run_flat) + np.cumsum(per_run) - per_run).astype(np.int64).tobytes())
        self.run_length.frombytes(per_run.astype(np.int32).tobytes())
        self.run_flat.frombytes(ids.tobytes())

    def _place(self, words: list[str], ids: np.ndarray, lengths: np.ndarray) -> None:
        """Append the ids of numbered words and note their places."""
        at = np.array([self.words[w] for w in words], np.int64)
        np.frombuffer(self.start, np.int64)[at] = len(self.flat) + np.cumsum(lengths) - lengths
        np.frombuffer(self.length, np.int32)[at] = lengths
        self.flat.frombytes(ids.astype(np.int32).tobytes())

    def _learn(self, new: list[str]) -> None:
        """Words of new runs; unknown ones go to the library. Words of letters only go many to a text: each is one piece of the
        split, so the ids that end words tell them apart."""
        known, letters, other = self.words, [], []
        parts: list[int] = []
        get, part = known.get, parts.append

        def number(word: str, group: list[str]) -> int:
            known[word] = n = len(known) + 2
            group.append(word)
            return n

        for run in new:
            core = run.rstrip(PUNCTUATION)
            if core.isascii() and core.isalpha() or not core or LATIN.fullmatch(core):
                word, tail = core if core.islower() else core.lower(), run[len(core):]
                part((get(word) or number(word, letters)) if word else EMPTY)
                part((get(tail) or number(tail, other)) if tail else EMPTY)
            else:
                part(get(run) or number(run, other))
                part(EMPTY)
        fresh = len(known) + 2 - len(self.start)
        self.start.frombytes(bytes(8 * fresh))
        self.length.frombytes(bytes(4 * fresh))
        texts = [" ".join(letters[i:i + JOINED]) for i in range(0, len(letters), JOINED)]
        ids = np.array([i for e in self.library.encode_batch_fast(texts, add_special_tokens=False) for i in e.ids], np.int64)
        ends = np.flatnonzero(self.ends_word[ids]) + 1
        if len(ends) != len(letters):
            raise ValueError("the tokenizer splits words of letters")
        self._place(letters, ids, np.diff(ends, prepend=0))
        found = [e.ids for e in self.library.encode_batch_fast(other, add_special_tokens=False)]
        self._place(other, np.array([i for x in found for i in x], np.int64), np.array([len(x) for x in found], np.int64))
        self._runs_of(parts)

    def encode(self, texts: list[str | None], end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, each followed by the end id, and ids per text."""
        if len(self.runs) > CACHE_RUNS:
            self.reset()
        get, placed, ends = self.runs.__getitem__, [], []
        for text in texts:
            placed += map(get, split_runs(text))
            placed.append(0)
            ends.append(len(placed))
        if self.runs.new:
            self._learn(self.runs.new)
            self.runs.new = []
        self.run_flat[0] = end_id
        slots = np.array(placed, np.int64)
        lengths = np.frombuffer(self.run_length, np.int32)[slots].astype(np.int64)
        upto = np.concatenate([[0], np.cumsum(lengths)])
        ids = gather(np.frombuffer(self.run_flat, np.int32), np.frombuffer(self.run_start, np.int64)[slots], lengths)
        return ids, np.diff(upto[np.array(ends, np.int64)], prepend=0)


@lru_cache(2)
def encoder(path: str) -> Encoder:
    """One encoder per worker and file."""
    return Encoder(path)


def tokenize(df: DataFrame, path: str, end_id: int, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Add ``n_tokens`` and ``ids`` (list<int>): the text's ids and the end id."""
    def fn(batch: pa.RecordBatch) -> list[pa.Array]:
        ids, counts = encoder(path).encode(batch.column(batch.schema.get_field_index(text)).to_pylist(), end_id)
        offsets = pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32))
        return [pa.array(counts, pa.int64()), pa.ListArray.from_arrays(offsets, pa.array(ids, pa.int32()))]

    return append_columns(df, text, "n_tokens bigint, ids array<int>", fn, keep=keep, run_bytes=RUN_BYTES)


def _sized(writer):
    """The controlled layout: encodings, row groups, pages and their indexes."""
    return (writer.option("compression", "snappy").option("parquet.writer.version", "PARQUET_2_0")
            .option("parquet.enable.dictionary", "true").option("parquet.dictionary.page.size", DICTIONARY_BYTES)
            .option("parquet.block.size", ROW_GROUP_BYTES).option("parquet.page.size", PAGE_BYTES)
            .option("parquet.page.row.count.limit", PAGE_ROWS))


def write(df: DataFrame, folder: str, path: str, end_id: int, key: str = "doc_id", text: str = "text") -> None:
    """Encode ``df`` and write ``tokens`` and ``index`` under ``folder`` in ascending key order.

    A range partition is a run of keys. The start of a run comes from the token counts of the runs before it (one
    row per run), the start within it from a window over the run's metadata.
    """
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # the place in the input breaks ties, so that the sample for the ranges reads the key column only
    by = [F.col(key).asc_nulls_first(), F.col("place")]
    rows = df.select(F.col(key), F.col(text), F.monotonically_increasing_id().alias("place"))
    rows = rows.repartitionByRange(n, *by).sortWithinPartitions(*by)
    tokens = tokenize(rows, path, end_id, text, keep=[key]).withColumn("run", F.spark_partition_id())
    tokens = tokens.withColumn("row", F.monotonically_increasing_id())
    _sized(tokens.write.mode("overwrite")).parquet(f"{folder}/tokens")
    meta = spark.read.parquet(f"{folder}/tokens").select(key, "n_tokens", "run", "row")
    per_run = meta.groupBy("run").agg(F.sum("n_tokens").alias("in_run"))
    before = Window.orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    per_run = per_run.select("run", F.coalesce(F.sum("in_run").over(before), F.lit(0)).alias("run_start"))
    inside = Window.partitionBy("run").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    index = (meta.withColumn("inside", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
             .join(F.broadcast(per_run), "run")     # one row per written partition
             .select(key, (F.col("run_start") + F.col("inside")).alias("start"), "n_tokens", "row"))
    _sized(index.write.mode("overwrite")).parquet(f"{folder}/index")


def read_index(spark: SparkSession, folder: str) -> DataFrame:
    """(key, start, n_tokens, row) of every document; no token page is read."""
    return spark.read.parquet(f"{folder}/index")


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """(key, n_tokens, ids, run, row); a filter on the key skips row groups and pages."""
    return spark.read.parquet(f"{folder}/tokens")


def checksums(tokens: DataFrame, keep: list[str]) -> DataFrame:
    """Add ``ids_crc32``: unsigned crc32 of the ids as little-endian unsigned 32-bit integers."""
    from pyspark.sql.types import LongType, StructField, StructType

    schema = StructType([*tokens.select(*keep).schema, StructField("ids_crc32", LongType())])

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(batch.schema.get_field_index("ids"))
            raw = memoryview(np.ascontiguousarray(lists.flatten().to_numpy(zero_copy_only=False), "<i4")).cast("B")
            ends = np.concatenate([[0], np.cumsum(lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))]) * 4
            sums = [zlib.crc32(raw[a:b]) for a, b in zip(ends.tolist(), ends[1:].tolist())]
            yield pa.RecordBatch.from_arrays([*(batch.column(batch.schema.get_field_index(c)) for c in keep),
                                              pa.array(sums, pa.int64())], names=[*keep, "ids_crc32"])

    return tokens.select(*keep, "ids").mapInArrow(mapped, schema)
