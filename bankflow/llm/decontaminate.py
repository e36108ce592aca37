"""Benchmark decontamination as a prefix-filtered set join (operator 1). DataFrame functions only.

A window is ``width`` consecutive words of a benchmark item (all of them for a shorter item). The tokens of the join are
shingles of ``SHINGLE`` words, of windows with fewer words the whole window.

1. Rarity: how often each benchmark shingle occurs in all documents. The places found are stored, so documents are split into
   words once here and once in the end, and the counts are partial before they are shuffled.
2. Prefix: a text contains a window only if it contains all its shingles, so the prefix that must be joined is one
   shingle, the rarest of the window. A window with a shingle that no document has is out.
3. Candidates: the stored places of prefix shingles are the only ones a window can start at; the place must lie in the document
   (position and length bounds). A document has as many candidates as it has places of a shingle times the windows whose rarest
   shingle that is.
4. Each document gets its candidates and compares the window with its words at that place.

The benchmark side is joined without hints: Spark broadcasts it if its size is below the session's limit and shuffles narrow
(hash, position) rows otherwise.

Defined cases: a null text has no words and no items; an item without words has no window; repeated items and items
with equal texts are each counted by id, an item without an id hits words but is not listed; rows equal in id and
text get the same result each; empty tables give empty or clean results; extra columns are not read.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bankflow.session import cut_lineage

WIDTH = 10
SHINGLE = 3
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """Words of a text, A-Z lower-cased; null for a null text."""
    lowered = F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    return F.array_remove(F.split(lowered, SEPARATORS), "")


def shingles(of: Column, size: int) -> Column:
    """Hash of each run of ``size`` words, in order; empty for fewer words."""
    at = lambda i, j: F.element_at(of, (i + j).cast("int"))
    return F.when(F.size(of) >= size, F.transform(
        F.sequence(F.lit(1), F.size(of) - size + 1),
        lambda i: F.xxhash64(*[at(i, F.lit(j)) for j in range(size)]))).otherwise(F.array().cast("array<bigint>"))


def item_windows(items: DataFrame, item: str, text: str, width: int) -> DataFrame:
    """(item, window array) of every item, distinct."""
    of = items.select(F.col(item).alias("item"), words(F.col(text)).alias("w")).where(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - width + 1, F.lit(1)))
    return of.select("item", F.explode(F.transform(starts, lambda i: F.slice("w", i, width))).alias("window")).distinct()


def occurrences(docs: DataFrame, sizes: list[int]) -> DataFrame:
    """(row, n, hash, at, size): each shingle of each document; ``at`` counts words from 1."""
    # the number of words is a column before the explode: the words themselves then stay behind
    docs = docs.select("row", F.size("w").alias("n"), "w")
    parts = [docs.select("row", "n", F.posexplode(shingles(F.col("w"), size)).alias("at", "hash"))
             .select("row", "n", "hash", (F.col("at") + 1).alias("at"), F.lit(size).alias("size")) for size in sizes]
    out = parts[0]
    for part in parts[1:]:
        out = out.union(part)
    return out


def prefixes(windows: DataFrame, docs: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """The rarest shingle of each window: (hash, size, offset, len, window), and the places of all windows' shingles in documents
    (see ``occurrences``), stored; None without windows.

    Sizes are at most ``SHINGLE`` different numbers."""
    each = None
    for size in range(1, SHINGLE + 1):
        fits = F.size("window") >= SHINGLE if size == SHINGLE else F.size("window") == size
        part = windows.where(fits).select("window", F.size("window").alias("len"), F.lit(size).alias("size"),
                                          F.posexplode(shingles(F.col("window"), size)).alias("offset", "hash"))
        each = part if each is None else each.union(part)
    each = cut_lineage(each, "window-shingle")
    sizes = sorted(r["size"] for r in each.select("size").distinct().collect())
    if not sizes:
        return each.select("hash", "size", "offset", "len", "window"), None
    wanted = each.select("hash", "size").distinct()
    found = cut_lineage(occurrences(docs, sizes).join(wanted, ["hash", "size"], "left_semi"), "places")
    rarity = found.groupBy("hash", "size").agg(F.count(F.lit(1)).alias("times"))
    ranked = each.join(rarity, ["hash", "size"], "left").withColumn("times", F.coalesce("times", F.lit(0)))
    rarest = ranked.groupBy("window", "len", "size").agg(F.min(F.struct("times", "hash", "offset")).alias("m"))
    return rarest.where("m.times > 0").select("m.hash", "size", "m.offset", "len", "window"), found


def contamination(docs: DataFrame, items: DataFrame, doc: str = "doc_id", text: str = "text", item: str = "item_id",
                  item_text: str = "text", width: int = WIDTH, keep: list[str] | None = None) -> DataFrame:
    """Per document row: its kept columns, ``n_words``, ``n_hit`` (words inside an occurrence of a window), ``n_items``
    and ``items`` (sorted ids, as strings, of items with an occurring window), ``contaminated``."""
    kept = list(dict.fromkeys([doc, *(keep or [])]))
    row = F.struct(F.col(doc).alias("id"), F.xxhash64(text).alias("text"))
    split = docs.select(row.alias("row"), words(F.col(text)).alias("w"))
    windows = cut_lineage(item_windows(items, item, item_text, width), "window")
    prefix, places = prefixes(windows.select("window").distinct(), split)
    prefix = cut_lineage(prefix, "prefix")
    full = docs.select(row.alias("row"), *kept, F.col(text).alias("whole text"))      # a text is smaller than its words
    if places is not None:
        near = places.join(prefix, ["hash", "size"]).select(
            "row", (F.col("at") - F.col("offset")).alias("start"), "len", "n", "window")
        near = near.where((F.col("start") >= 1) & (F.col("start") + F.col("len") - 1 <= F.col("n")))
        near = near.groupBy("row").agg(F.collect_set(F.struct("start", "len", "window")).alias("near"))
        near = cut_lineage(near, "candidate")
        full = full.join(near, "row", "left")
    else:
        full = full.withColumn("near", F.lit(None).cast("array<struct<start:int,len:int,window:array<string>>>"))
    full = full.withColumn("w", words(F.col("whole text")))
    same = lambda c: F.slice("w", c["start"], c["len"]) == c["window"]
    full = full.withColumn("hits", F.filter("near", same))
    covered = F.flatten(F.transform("hits", lambda c: F.sequence(c["start"], c["start"] + c["len"] - 1)))
    checked = cut_lineage(full.select(
        "row", *kept, F.coalesce(F.greatest(F.size("w"), F.lit(0)), F.lit(0)).cast("bigint").alias("n_words"),
        F.coalesce(F.greatest(F.size(F.array_distinct(covered)), F.lit(0)), F.lit(0)).cast("bigint").alias("n_hit"),
        F.array_distinct(F.transform("hits", lambda c: c["window"])).alias("windows")), "checked")
    listed = (checked.where("n_hit > 0").select("row", F.explode("windows").alias("window"))
              .join(windows.where(F.col("item").isNotNull()), "window")
              .groupBy("row").agg(F.sort_array(F.collect_set(F.col("item").cast("string"))).alias("items")))
    out = checked.drop("windows").join(listed, "row", "left").drop("row")
    out = out.withColumn("items", F.coalesce("items", F.array().cast("array<string>")))
    return out.withColumn("n_items", F.size("items").cast("bigint")).withColumn("contaminated", F.col("n_hit") > 0)
