"""Hard-negative mining by slots (operator 11).

Every anchor has up to ``positives`` nearest rows of its own label. For each of them, the negatives wanted are the first ``negatives``
rows of other labels whose score lies in the window from ``low`` to ``high`` per cent of the positive's score. The windows of an
anchor overlap, so they are not searched one by one: their upper limits cut the scores into disjoint slots, one pass over the rows keeps
the first few rows of each slot, and as slots follow each other in falling order, the rows up to a limit are its
slot and those behind it: each window takes the head of that suffix, down to its own lower limit.

Scores are integer inner products of vectors with ``floor(scale * x)`` as components; higher ones come first, ties by smaller id.

Anchors (a stated share of the rows) meet all rows in cells: a cell joins a block of at most about ``ANCHORS`` anchors with a hashed share of the
rows of about ``CELL_BYTES``. Positives are searched in cells of one label, negatives in cells of all labels. A cell returns a few rows per anchor and
slot, whatever its size, and a second such selection merges the cells, so neither a hot label nor a vector that a third of the
rows share makes a large group anywhere. Nothing is broadcast and nothing is collected.

Defined cases: rows with a null id or label, a null vector or a null or non-finite component take no part; an id that is there more than
once with equal label and vector counts once, otherwise each is a row, and no row of the anchor's own id is
its positive or negative; vectors of different lengths are not compared, empty ones score 0; a positive with a negative score has an empty
window, one with the score 0 the window 0; anchors without positives or with empty windows return nothing; scores beyond 64 bits are cut to that
range; an empty table gives an empty table; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bankflow.session import cut_lineage

ANCHORS = 1024            # anchors of a block, about
CELL_BYTES = 16 << 20     # vectors of a cell's rows, about
AT_ONCE = 1 << 21         # scores that a task holds at once
EXACT = 2.0 ** 53         # integers below are exact as doubles
LONG = 2 ** 63


def _finite(vector: Column) -> Column:
    return vector.isNotNull() & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))


def matrix(column: pa.ChunkedArray | pa.Array, width: int, scale: float) -> np.ndarray:
    """Vectors of one length as whole numbers (doubles)."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    most = np.finfo(np.float64).max
    with np.errstate(over="ignore"):
        return np.clip(np.floor(scale * flat.reshape(len(column), width)), -most, most)


def inner(rows: np.ndarray, anchors: np.ndarray) -> np.ndarray:
    """Integer inner products: by doubles where they are exact, by Python's integers for the rows beyond."""
    with np.errstate(over="ignore", invalid="ignore"):
        reach = np.abs(rows).sum(axis=1) * (np.abs(anchors).max(initial=0.0))
    exact = reach < EXACT
    out = np.empty((len(rows), len(anchors)), np.int64)
    out[exact] = (rows[exact] @ anchors.T).astype(np.int64)
    if not exact.all():
        whole = np.frompyfunc(int, 1, 1)
        big = whole(rows[~exact]).astype(object) @ whole(anchors).astype(object).T
        out[~exact] = np.clip(big, 1 - LONG, LONG - 1).astype(np.int64)
    return out


def first_rows(scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` highest scores, earlier places first among equal ones, highest score first."""
    if len(scores) > k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        above = np.flatnonzero(scores > least)
        at = np.concatenate([above, np.flatnonzero(scores == least)[:k - len(above)]])
        at.sort()
    else:
        at = np.arange(len(scores))
    return at[np.argsort(-scores[at], kind="stable")]


def _blocks(rows: pa.Table, anchors: pa.Table, scale: float):
    """For each anchor of a cell: its place, and the scores of the cell's rows, which are in order of their ids."""
    width = rows.column("dim")[0].as_py()
    points, against = matrix(rows.column("vector"), width, scale), matrix(anchors.column("vector"), width, scale)
    step = max(1, AT_ONCE // max(len(points), 1))
    for i in range(0, len(against), step):
        scores = inner(points, against[i:i + step])
        for j in range(scores.shape[1]):
            yield i + j, np.ascontiguousarray(scores[:, j])


FOUND = "akey bigint, anchor_id bigint, slot int, id bigint, score bigint"


def _table(found: list[tuple]) -> pa.Table:
    """Rows of ``FOUND`` from one tuple per anchor and slot (ids and scores as arrays)."""
    types = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64()]
    names = FOUND.replace(",", "").split()[::2]
    if not found:
        return pa.table([pa.array([], t) for t in types], names=names)
    sizes = [len(f[3]) for f in found]
    columns = [np.repeat([f[i] for f in found], sizes) for i in range(3)] + [np.concatenate([f[i] for f in found]) for i in (3, 4)]
    return pa.table([pa.array(c, t) for c, t in zip(columns, types)], names=names)


def _positives_of(k: int, scale: float):
    def fn(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        found = []
        if rows.num_rows and anchors.num_rows:
            rows = rows.sort_by("id")
            ids, keys, own = (t.column(c).to_numpy() for t, c in ((rows, "id"), (anchors, "akey"), (anchors, "id")))
            for j, scores in _blocks(rows, anchors, scale):
                other = np.flatnonzero(ids != own[j])
                at = other[first_rows(scores[other], k)]
                found.append((keys[j], own[j], 0, ids[at], scores[at]))
        return _table(found)

    return fn


def _negatives_of(k: int, scale: float, low: int, high: int):
    def fn(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        found = []
        if rows.num_rows and anchors.num_rows:
            rows = rows.sort_by("id")
            ids, labels = rows.column("id").to_numpy(), rows.column("label").combine_chunks().dictionary_encode()
            code_of = {v: i for i, v in enumerate(labels.dictionary.to_pylist())}
            codes = labels.indices.to_numpy()
            keys, own = anchors.column("akey").to_numpy(), anchors.column("id").to_numpy()
            own_label, limits = anchors.column("label").to_pylist(), anchors.column("limits").to_pylist()
            for j, scores in _blocks(rows, anchors, scale):
                tops = limits[j]                                      # positives' scores, falling, none below 0
                top, least = tops[0] * high // 100, -(-tops[-1] * low // 100)
                at = np.flatnonzero((scores <= top) & (scores >= least) & (ids != own[j]) & (codes != code_of.get(own_label[j], -1)))
                uppers = np.array([t * high // 100 for t in tops], np.int64)
                slots = np.searchsorted(-uppers, -scores[at], side="right") - 1
                for slot in range(len(tops)):
                    mine = at[slots == slot]
                    if len(mine):
                        mine = mine[first_rows(scores[mine], k)]
                        found.append((keys[j], own[j], slot, ids[mine], scores[mine]))
        return _table(found)

    return fn


def _cells(rows: DataFrame, anchors: DataFrame, by: list[str], fn, seed: int) -> DataFrame:
    """``fn`` over every cell of the groups ``by``. A group's anchors are dealt to blocks and its rows to shares; a row goes to
    all blocks of its group, an anchor to all shares, so each pair meets in one cell."""
    blocks = anchors.groupBy(*by).agg(F.ceil(F.count(F.lit(1)) / ANCHORS).cast("int").alias("blocks"))
    shares = rows.groupBy(*by).agg(F.ceil(F.count(F.lit(1)) * (F.lit(8) * (F.max("dim") + 1)) / CELL_BYTES).cast("int").alias("shares"))
    plan = cut_lineage(blocks.join(shares, by), "cells")              # a row per group that has anchors
    deal = lambda shift, among: F.pmod(F.xxhash64("akey", F.lit(seed + shift)), among).cast("int")
    among = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = rows.join(plan, by).withColumn("share", deal(0, "shares")).withColumn("block", among("blocks")).drop("blocks", "shares")
    right = anchors.join(plan, by).withColumn("block", deal(1, "blocks")).withColumn("share", among("shares")).drop("blocks", "shares")
    keys, right = [*by, "block", "share"], right.toDF(*right.columns)   # the anchors are some of the rows: columns of their own
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(fn, FOUND)


def _merged(found: DataFrame, keys: list[str], k: int) -> DataFrame:
    """The first ``k`` rows per key over all cells (limited before they are shuffled as well)."""
    order = Window.partitionBy(*keys).orderBy(F.col("score").desc(), "id")
    return found.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= k)


def mine(df: DataFrame, is_anchor: Column, id: str = "vec_id", label: str = "label", vector: str = "embedding", scale: float = 256.0,
         positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100) -> DataFrame:
    """Hard negatives of every anchor and positive: anchor_id, positive_id, rank (from 1), negative_id, positive_score, negative_score.

    ``is_anchor`` is a condition on the columns of ``df``; ``low`` and ``high`` are whole per cent (0 <= low <= high)."""
    if not 0 <= low <= high:
        raise ValueError("the window's limits must be 0 <= low <= high")
    rows = df.where(F.col(id).isNotNull() & F.col(label).isNotNull() & _finite(F.col(vector))).select(
        F.col(id).cast("bigint").alias("id"), F.col(label).alias("label"), F.col(vector).alias("vector"),
        F.size(vector).alias("dim"), F.coalesce(is_anchor, F.lit(False)).alias("is_anchor")).distinct()
    rows = cut_lineage(rows.withColumn("akey", F.xxhash64("id", "label", "vector")), "negatives-rows")
    anchors, rows = rows.where("is_anchor").drop("is_anchor"), rows.drop("is_anchor")
    near = _cells(rows, anchors, ["dim", "label"], _positives_of(positives, scale), 1)
    near = cut_lineage(_merged(near, ["akey"], positives).select("akey", "anchor_id", F.col("id").alias("positive_id"),
                                                                 F.col("score").alias("positive_score"), "nth"), "positives")
    wanted = near.where("positive_score >= 0")
    limits = wanted.groupBy("akey").agg(F.sort_array(F.collect_set("positive_score"), asc=False).alias("limits"))   # ``positives`` at most
    found = _cells(rows, anchors.join(limits, "akey"), ["dim"], _negatives_of(negatives, scale, low, high), 3)
    slots = _merged(found, ["akey", "slot"], negatives)
    # at most positives * negatives rows per anchor: its slots one after the other, in falling order
    falling = F.transform(F.array_sort(F.collect_list(F.struct("slot", "nth", "id", "score"))), lambda e: F.struct(e["id"].alias("id"), e["score"].alias("score")))
    falling = slots.groupBy("akey").agg(falling.alias("falling"))
    times = lambda c, n: c.cast("decimal(20,0)") * F.lit(n)
    score = F.col("positive_score")
    suffix = F.slice(F.filter("falling", lambda e: times(e["score"], 100) <= times(score, high)), 1, negatives)
    window = F.filter(suffix, lambda e: times(e["score"], 100) >= times(score, low))
    picked = wanted.join(falling, "akey").select("anchor_id", "positive_id", "positive_score", F.posexplode(window).alias("rank", "e"))
    return picked.select("anchor_id", "positive_id", (F.col("rank") + 1).cast("int").alias("rank"), F.col("e.id").alias("negative_id"),
                         "positive_score", F.col("e.score").alias("negative_score"))
