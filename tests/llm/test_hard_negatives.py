"""Hard negatives against a plain search."""
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from bankflow.llm import hard_negatives as hn
from bankflow.llm import registry
from bankflow.llm.sql import ORACLE
from tests.conftest import SF_SMALL
from tools.check_oracle import digest

SCHEMA = "vec_id bigint, label int, embedding array<double>"


def plain(rows, every=10, k=5, m=5, low=80, high=100, scale=256):
    """Rows (anchor, positive, rank, negative, positive score, negative score) by looking at all pairs in order."""
    ok = {(i, lab, tuple(math.floor(scale * x) for x in v)) for i, lab, v, *_ in rows
          if i is not None and lab is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)}
    out = []
    for i, lab, v in ok:
        if i % every:
            continue
        scored = sorted(((-sum(a * b for a, b in zip(v, w)), j, other) for j, other, w in ok if j != i and len(w) == len(v)), key=lambda x: x[:2])
        for p, pid, _ in [s for s in scored if s[2] == lab][:k]:
            found = [s for s in scored if s[2] != lab and low * -p <= 100 * -s[0] <= high * -p][:m]
            out += [(i, pid, n, s[1], -p, -s[0]) for n, s in enumerate(found, 1)]
    return sorted(out)


def mined(spark, rows, **more):
    df = spark.createDataFrame(rows, SCHEMA) if not hasattr(rows, "columns") else rows
    return sorted(tuple(r) for r in hn.mine(df, F.col("vec_id") % 10 == 0, **more).collect())


def some_rows(n, dims=6, seed=1, labels=3):
    r = random.Random(seed)
    return [(i, r.randrange(labels), [r.choice([-0.25, 0.0, 0.25, 0.5, r.random()]) for _ in range(dims)]) for i in range(n)]


def test_equals_the_plain_search(spark):
    rows = some_rows(240)
    want = plain(rows)
    assert len(want) > 100 and mined(spark, rows) == want


def test_many_cells_and_other_windows(spark, monkeypatch):
    monkeypatch.setattr(hn, "ANCHORS", 3)
    monkeypatch.setattr(hn, "CELL_BYTES", 700)
    rows = some_rows(200, seed=2)
    assert mined(spark, rows, positives=3, negatives=2, low=50, high=90) == plain(rows, k=3, m=2, low=50, high=90)


def test_ties_and_copies(spark):
    same = [0.5, 0.5, 0.0]
    rows = [(i, i % 2, same) for i in range(60)] + [(100 + i, 0, [0.5, 0.25, 0.25]) for i in range(12)]
    assert mined(spark, rows) == plain(rows)
    assert mined(spark, rows + rows[:40]) == plain(rows)          # exact repeats count once
    moved = rows + [(10, 0, [0.25, 0.5, 0.5]), (11, 0, same)]      # ids with other contents are rows of their own
    assert mined(spark, moved) == plain(moved)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = some_rows(60, seed=3) + [(None, 1, [0.5] * 6), (10, None, [0.5] * 6), (20, 1, None), (30, 1, [0.5, None, 0.0, 0.0, 0.0, 0.0]), (40, 1, [nan] + [0.5] * 5),
                                    (50, 0, [inf] + [0.5] * 5), (51, 0, [-inf] * 6), (900, 0, []), (901, 0, []), (902, 1, []), (910, 0, [0.5]), (911, 0, [1.0]), (912, 2, [0.99]),
                                    (920, 1, [1e6] * 6), (921, 1, [3e6] * 6), (922, 2, [2.5e6] * 6)]
    want = plain(rows)
    assert {900, 910, 920} <= {w[0] for w in want}
    assert mined(spark, rows) == want
    assert mined(spark, [(10, 1, [1e300] * 2), (11, 1, [1e308] * 2), (12, 2, [1e300] * 2)]) == [(10, 11, 1, 12, 2 ** 63 - 1, 2 ** 63 - 1)]


def test_negative_scores_have_empty_windows(spark):
    rows = [(0, 1, [1.0]), (1, 1, [-1.0]), (2, 2, [-0.9]), (3, 1, [0.0]), (4, 2, [0.0])]
    assert mined(spark, rows) == [(0, 3, 1, 4, 0, 0)]


def test_empty_and_clashing(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert mined(spark, empty) == []
    assert mined(spark, some_rows(9, seed=4)[1:]) == []              # no anchor
    rows = some_rows(80, seed=5)
    clash = spark.createDataFrame(rows, SCHEMA).withColumn("id", F.lit("x")).withColumn("block", F.lit(1)).withColumn("score", F.lit(None).cast("int"))
    assert mined(spark, clash) == plain(rows)


def test_bad_limits(spark):
    with pytest.raises(ValueError):
        hn.mine(spark.createDataFrame([], SCHEMA), F.lit(True), low=110)


def test_first_rows():
    r = np.random.default_rng(1)
    for _ in range(200):
        scores = r.integers(-3, 4, r.integers(0, 30))
        assert hn.first_rows(scores, 5).tolist() == sorted(range(len(scores)), key=lambda i: (-scores[i], i))[:5]


def test_query_equals_its_sql(spark, duck):
    duck.execute(f"CREATE OR REPLACE VIEW embeddings AS SELECT * FROM read_parquet('{SF_SMALL}/embeddings.parquet')")
    df = registry.op11_hard_negatives(spark, SF_SMALL)
    got = duck.execute(ORACLE["op11_hard_negatives"])
    rows, want = [tuple(r) for r in df.collect()], got.fetchall()
    assert rows and digest(df.columns, rows)[0] == digest([d[0] for d in got.description], want)[0]
