"""MinHash near-duplicates with tensored banding (operator 8).

A text's set holds its distinct ``k``-word shingles as 64-bit hashes. Two collections of ``side`` keys each, a key being
``rows`` minhashes, are computed per set; the table keys are all pairs (one key of either collection), so ``side`` squared
tables cost 2 * side * rows minhashes in place of 2 * side**2 * rows. Two sets of similarity s share a table with probability
(1 - (1 - s**rows)**side)**2: at 0.8 and the defaults 0.9996, at 0.85 over 0.99997.

Equal sets are one class with one representative (map-side aggregation), so groups of copies cost one row. The rest:

1. The table rows are range-partitioned by (key, representative) and sorted: a bucket of any size is split over
   tasks, and no group is ever held whole.
2. Candidates are verified on full sets. Each member of a bucket meets its hub: first the most popular of its hubs, then the other
   hubs it is not connected with. In buckets whose other members are not connected by then, members outside the largest
   component meet all others block by block, and only links come out. So every candidate pair that could still change a
   component is verified, while a bucket of near copies of each other costs one pair per member.
3. Components come from large-star/small-star rounds, each a written table.

Defined cases: a text without words has an empty set and is linked with nothing; one of fewer than ``k`` words is its
whole sequence; rows that share a doc_id are one document, whose links are those of all its texts, and each such row gets
its result; a row without a doc_id joins the component of equal sets, or is kept with a null component; an
empty table gives an empty table; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bankflow.llm.arrow_text import append_columns, utf8_buffer
from bankflow.session import cut_lineage

SIDE = 12      # keys in either collection; SIDE * SIDE tables
ROWS = 3       # minhashes in a key
THRESHOLD = 80  # per cent
BLOCK_SETS = 128          # sets in a block of open members, and their shingles; more make more blocks
BLOCK_SHINGLES = 1 << 16

_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX1
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word of the texts in order, A-Z lower-cased, and the text it is in."""
    data = data.copy()
    data[(data >= 65) & (data <= 90)] += 32
    inside = ~((data == 0x20) | ((data >= 0x09) & (data <= 0x0D)))
    full = np.diff(offsets) > 0
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    begins[offsets[:-1][full]] = inside[offsets[:-1][full]]
    ends[offsets[1:][full] - 1] = inside[offsets[1:][full] - 1]
    first, last = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    raw = data.tobytes()
    words = [raw[a:b] for a, b in zip(first.tolist(), last.tolist())]
    known = {w: xxhash.xxh3_64_intdigest(w) for w in set(words)}
    hashes = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    return hashes, np.searchsorted(offsets, first, side="right") - 1


def shingle_sets(data: np.ndarray, offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of all texts, one text after the other, and their number per text."""
    hashes, text_of = word_hashes(data, offsets)
    n_texts = len(offsets) - 1
    words = np.bincount(text_of, minlength=n_texts)
    start = np.cumsum(words) - words
    rolled = np.zeros(max(len(hashes) - k + 1, 0), np.uint64)
    for j in range(k):
        rolled = _mix(rolled + hashes[j:j + len(rolled)] + np.uint64(j + 1))
    sets = []
    for a, n in zip(start.tolist(), words.tolist()):
        if n >= k:
            sets.append(np.unique(rolled[a:a + n - k + 1]))
        elif n:     # the whole sequence, told apart from shingles by its length
            whole = np.uint64(0)
            with np.errstate(over="ignore"):
                for h in hashes[a:a + n]:
                    whole = _mix(np.array([whole + h + np.uint64(1000 + n)], np.uint64))[0]
            sets.append(np.array([whole], np.uint64))
        else:
            sets.append(np.empty(0, np.uint64))
    counts = np.array([len(s) for s in sets], np.int64)
    return (np.concatenate(sets) if sets else np.empty(0, np.uint64)), counts


def minhash_keys(values: np.ndarray, counts: np.ndarray, side: int, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """The two collections of keys of each non-empty set: arrays (sets, side)."""
    full = np.flatnonzero(counts)
    starts = (np.cumsum(counts) - counts)[full]
    rng = np.random.Generator(np.random.PCG64(20240131))      # fixed: all workers use the same functions
    seeds = rng.integers(0, 2 ** 64, (2, side, rows), np.uint64)
    factors = rng.integers(0, 2 ** 64, (2, side, rows), np.uint64) | np.uint64(1)
    keys = np.zeros((2, side, len(counts)), np.uint64)
    for c in range(2):
        for i in range(side):
            acc = np.full(len(full), c * side + i + 1, np.uint64)
            for r in range(rows):
                if len(full):
                    least = np.minimum.reduceat((values ^ seeds[c, i, r]) * factors[c, i, r], starts)
                    acc = _mix(acc + least)
            keys[c, i, full] = acc
    return keys[0].T, keys[1].T


def sketches(df: DataFrame, k: int, text: str, keep: list[str], side: int = SIDE, rows: int = ROWS) -> DataFrame:
    """Kept columns, n_shingles, set_key, a, b: size and identity of each text's set and its two key collections."""
    def fn(batch: pa.RecordBatch) -> list[pa.Array]:
        values, counts = shingle_sets(*utf8_buffer(batch.column(batch.schema.get_field_index(text))), k)
        raw, ends = values.tobytes(), np.concatenate([[0], np.cumsum(counts)]) * 8
        identity = [xxhash.xxh3_128_digest(raw[a:b]) for a, b in zip(ends.tolist(), ends[1:].tolist())]
        a, b = minhash_keys(values, counts, side, rows)
        at = pa.array(np.arange(len(counts) + 1, dtype=np.int32) * side)
        lists = [pa.ListArray.from_arrays(at, pa.array(np.ascontiguousarray(x).reshape(-1).view(np.int64))) for x in (a, b)]
        return [pa.array(counts, pa.int64()), pa.array(identity, pa.binary()), *lists]

    return append_columns(df, text, "n_shingles bigint, set_key binary, a array<bigint>, b array<bigint>", fn, keep=keep)


def full_sets(df: DataFrame, k: int, text: str, keep: list[str]) -> DataFrame:
    """Add ``shingles`` (array<bigint>): the whole set of each text."""
    def fn(batch: pa.RecordBatch) -> list[pa.Array]:
        values, counts = shingle_sets(*utf8_buffer(batch.column(batch.schema.get_field_index(text))), k)
        ends = pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32))
        return [pa.ListArray.from_arrays(ends, pa.array(values.view(np.int64)))]

    return append_columns(df, text, "shingles array<bigint>", fn, keep=keep)


def buckets(classes: DataFrame) -> DataFrame:
    """(key, rep, n) of the table keys that several representatives share.

    Rows are range-partitioned by (key, rep) and sorted, so a bucket of any size is spread over tasks. Runs of one row are
    left out, but for those at either end of a partition, whose key may go on in another.
    """
    spark = classes.sparkSession
    tables = F.flatten(F.transform("a", lambda x, i: F.transform("b", lambda y, j: F.xxhash64(x, y, i, j))))
    rows = classes.select("rep", "n", F.explode(tables).alias("key"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartitionByRange(parts, "key", "rep").sortWithinPartitions("key", "rep")

    def shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("key", "rep", "n")
        held = {c: np.empty(0, np.int64) for c in names}    # the last row so far
        before = None                                       # key of the row before the held one
        first = True                                        # the held row may belong to the partition's first run

        def out(rows: dict[str, np.ndarray], keep: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(rows[c][:len(keep)][keep]) for c in names], names=list(names))

        for batch in batches:
            rows = {c: np.concatenate([held[c], batch.column(batch.schema.get_field_index(c)).to_numpy(zero_copy_only=False)]) for c in names}
            key = rows["key"]
            if not len(key):
                continue
            same = key[1:] == key[:-1]
            keep = same.copy()
            keep[1:] |= same[:-1]
            if len(keep):
                keep[0] |= before is not None and before == key[0]
                if first:
                    keep |= key[:-1] == key[0]
                    first = bool(key[-1] == key[0])
                before = key[-2]
            yield out(rows, keep)
            held = {c: v[-1:] for c, v in rows.items()}
        if len(held["key"]):
            yield out(held, np.array([True]))

    found = rows.select("key", "rep", "n").mapInArrow(shared, "key bigint, rep bigint, n bigint")
    return found


def _could_be(n1: str, n2: str):
    """Length bound: sets of these sizes can reach the threshold."""
    return 100 * F.least(n1, n2) >= THRESHOLD * F.greatest(n1, n2)


def verify(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs of ``pairs`` (x, y; distinct) that reach the threshold on their full sets. Nothing rides on the second join's
    partitioning, so Spark can split a popular hub's rows."""
    left = sets.select(F.col("rep").alias("x"), F.col("shingles").alias("sx"))
    right = sets.select(F.col("rep").alias("y"), F.col("shingles").alias("sy"))
    common = F.size(F.array_intersect("sx", "sy"))
    both = pairs.join(left, "x").join(right, "y")
    return both.where(100 * common >= THRESHOLD * (F.size("sx") + F.size("sy") - common)).select("x", "y")


def components(links: DataFrame) -> DataFrame:
    """(node, comp) for every node of ``links`` (x, y): comp is the least node it is connected with.

    Alternates large-star and small-star until nothing moves; each round is a written table.
    """
    def mark(e: DataFrame):
        return e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()

    edges = cut_lineage(links.select(F.greatest("x", "y").alias("u"), F.least("x", "y").alias("v")).distinct(), "cc")
    seen = mark(edges)
    while seen[0]:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(least.select("u", F.col("m").alias("v"))).distinct())
        edges = cut_lineage(small, "cc")
        now = mark(edges)
        if now == seen:
            break
        seen = now
    return (edges.groupBy("u").agg(F.min("v").alias("comp")).select(F.col("u").alias("node"), "comp")
            .union(edges.select("v", "v").distinct()))


def seats(members: DataFrame) -> DataFrame:
    """Bucket rows with the bucket's size and hub: (key, size, rep, n, hub, hub_n, weight).

    The hub of a bucket is its most popular member, popularity (``weight``) being the summed size of all buckets that a member is in. Of
    near copies of one text, that text has the minhashes most of them have, so it is the hub they are likeliest to link with.
    """
    members = members.join(members.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1"), "key")
    weight = members.groupBy("rep").agg(F.sum("size").alias("weight"))
    hub = members.join(weight, "rep").groupBy("key").agg(
        F.max(F.struct("weight", (-F.col("rep")).alias("minus"), "n")).alias("h"))
    return members.join(hub, "key").select("key", "size", "rep", "n", (-F.col("h.minus")).alias("hub"),
                                           F.col("h.n").alias("hub_n"), F.col("h.weight").alias("weight"))


def labelled(df: DataFrame, comps: DataFrame, node: str, name: str) -> DataFrame:
    """Add the component of ``node``, itself if it has no link, as ``name``."""
    of = comps.select(F.col("node").alias(node), F.col("comp").alias("_comp"))
    return df.join(of, node, "left").withColumn(name, F.coalesce("_comp", node)).drop("_comp")


def connect(comps: DataFrame, links: DataFrame) -> DataFrame:
    """Components after more links."""
    stars = comps.where("node <> comp").select(F.col("node").alias("x"), F.col("comp").alias("y"))
    return cut_lineage(components(stars.union(links)), "comp")


def block_links(table: pa.Table) -> pa.Table:
    """Links between the ``outside`` members of a block pair and the others, one per component that a member meets."""
    sets = table.column("shingles").combine_chunks()
    flat = sets.flatten().to_numpy(zero_copy_only=False)
    sizes = sets.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    rep, comp = (table.column(c).to_numpy() for c in ("rep", "comp"))
    outside = table.column("outside").to_numpy(zero_copy_only=False)
    values, ids = np.unique(flat, return_inverse=True)
    ends = np.cumsum(sizes)
    others = np.flatnonzero(~outside)
    out: list[tuple[int, int]] = []
    if len(others):
        other_ids = np.concatenate([ids[ends[o] - sizes[o]:ends[o]] for o in others])
        starts = np.cumsum(sizes[others]) - sizes[others]
        mark = np.zeros(len(values), np.int64)
        for x in np.flatnonzero(outside):
            own = ids[ends[x] - sizes[x]:ends[x]]
            mark[own] = 1
            common = np.add.reduceat(mark[other_ids], starts)
            mark[own] = 0
            linked = (100 * common >= THRESHOLD * (sizes[x] + sizes[others] - common)) & (comp[others] != comp[x])
            found = others[linked]
            out += [(int(rep[x]), int(rep[y])) for y in found[np.unique(comp[found], return_index=True)[1]]]
    return pa.table({"x": pa.array([x for x, _ in out], pa.int64()), "y": pa.array([y for _, y in out], pa.int64())})


def open_links(bucket_rows: DataFrame, comps: DataFrame, classes: DataFrame, sets: DataFrame) -> DataFrame:
    """Links between members of different components that no hub has settled.

    A bucket is open if its members other than the hub, which has met them all, are not in one component. The members of open buckets
    are dealt out again by each key of the first collection, which any two of a bucket share one of. There each
    member outside the largest component meets all others, block against block: tasks hold at most two blocks, and
    only links come out. The comparisons grow with the square of such a group, the rows with that over the block size.
    """
    rows = labelled(bucket_rows.where("size > 2 and rep <> hub").select("key", "rep"), comps, "rep", "comp")
    split = rows.groupBy("key").agg(F.min("comp").alias("c1"), F.max("comp").alias("c2")).where("c1 <> c2").select("key")
    members = cut_lineage(rows.join(split, "key", "left_semi").select("rep", "comp").distinct()
                          .join(classes.select("rep", "n", "a"), "rep")
                          .select("rep", "comp", "n", F.posexplode("a").alias("i", "at")), "open")
    per = members.groupBy("i", "at", "comp").agg(F.count(F.lit(1)).alias("c"), F.sum("n").alias("s"))
    place = (per.groupBy("i", "at").agg(F.max(F.struct("c", "comp", "s")).alias("m"), F.sum("c").alias("c"), F.sum("s").alias("s"))
             .where("c > m.c").select("i", "at", F.col("m.comp").alias("main"),
                                      F.ceil(F.greatest((F.col("c") - F.col("m.c")) / BLOCK_SETS, (F.col("s") - F.col("m.s")) / BLOCK_SHINGLES)).alias("across"),
                                      F.ceil(F.greatest(F.col("c") / (2 * BLOCK_SETS), F.col("s") / (2 * BLOCK_SHINGLES))).alias("down")))
    members = members.join(place, ["i", "at"])
    upto = lambda c: F.sequence(F.lit(0).cast("bigint"), F.col(c) - 1)
    out = (members.where("comp <> main").select("i", "at", "rep", "comp", F.pmod(F.xxhash64("rep"), F.col("across")).alias("p"),
                                                F.explode(upto("down")).alias("q"), F.lit(True).alias("outside")))
    rest = members.select("i", "at", "rep", "comp", F.explode(upto("across")).alias("p"),
                          F.pmod(F.xxhash64("rep", F.lit(1)), F.col("down")).alias("q"), F.lit(False).alias("outside"))
    dealt = out.unionByName(rest).join(sets, "rep").select("i", "at", "p", "q", "rep", "comp", "outside", "shingles")
    return dealt.groupBy("i", "at", "p", "q").applyInArrow(block_links, "x bigint, y bigint")


def near_duplicates(df: DataFrame, k: int = 5, text: str = "text", key: str = "doc_id", side: int = SIDE,
                    rows: int = ROWS, keep: list[str] | None = None) -> DataFrame:
    """(key, kept columns, n_shingles, component_id, kept) of every row; see the module text."""
    kept = list(dict.fromkeys([key, *(keep or [])]))
    sketched = cut_lineage(sketches(df, k, text, kept, side, rows).withColumn(key, F.col(key).cast("bigint")), "sketch")
    with_id = sketched.where((F.col("n_shingles") > 0) & F.col(key).isNotNull())
    classes = cut_lineage(with_id.groupBy("set_key").agg(F.min(key).alias("rep"), F.first("n_shingles").alias("n"),
                                                          F.first("a").alias("a"), F.first("b").alias("b")), "class")
    bucket_rows = cut_lineage(seats(cut_lineage(buckets(classes), "bucket")), "seat")
    hubs = cut_lineage(bucket_rows.where((F.col("rep") != F.col("hub"))
                                         & (100 * F.least("n", "hub_n") >= THRESHOLD * F.greatest("n", "hub_n")))
                       .select("rep", "hub", "weight").distinct(), "hub")
    nodes = hubs.select("rep").union(hubs.select("hub")).union(bucket_rows.where("size > 2").select("rep")).distinct()
    texts = df.select(F.col(key).cast("bigint").alias("rep"), F.col(text).alias("text")).join(nodes, "rep")
    sets = cut_lineage(full_sets(texts, k, "text", ["rep"]).where(F.size("shingles") > 0), "set")

    best = cut_lineage(hubs.groupBy("rep").agg(F.max(F.struct("weight", (-F.col("hub")).alias("minus"))).alias("m"))
                       .select(F.col("rep").alias("x"), (-F.col("m.minus")).alias("y")), "best")
    comps = cut_lineage(components(cut_lineage(verify(best, sets), "link")), "comp")
    rest = labelled(labelled(hubs, comps, "rep", "c1"), comps, "hub", "c2").where("c1 <> c2")
    rest = rest.select(F.col("rep").alias("x"), F.col("hub").alias("y")).join(best, ["x", "y"], "left_anti")
    comps = connect(comps, cut_lineage(verify(rest, sets), "link"))
    comps = connect(comps, cut_lineage(open_links(bucket_rows, comps, classes, sets), "link"))
    rep_of = classes.select("set_key", "rep")
    out = sketched.select(*kept, "n_shingles", "set_key").join(rep_of, "set_key", "left")
    # rows that share an id are one document: its component is the least of its texts' components
    out = out.join(comps, out.rep == comps.node, "left").select(
        *kept, "n_shingles", F.coalesce("comp", "rep", key).alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col(key) == F.col("component_id"), F.col("component_id").isNull()))
