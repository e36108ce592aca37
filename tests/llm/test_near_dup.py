"""Near-duplicate components against all pairs."""
import random
import re

import numpy as np
import pyarrow as pa

from bankflow.llm import near_dup, registry
from bankflow.llm.arrow_text import utf8_buffer
from tests.conftest import SF_SMALL


def shingles(text, k):
    w = re.findall(r"[^\x20\x09-\x0d]+", (text or "").translate({i: i + 32 for i in range(65, 91)}))
    return frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])


def plain(docs, k):
    sets = {}
    for d, t in docs:
        if d is not None:
            sets.setdefault(d, []).append(shingles(t, k))
    parent = {d: d for d in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for i, x in enumerate(ids):
        for y in ids[:i]:
            if any(a and b and 100 * len(a & b) >= 80 * len(a | b) for a in sets[x] for b in sets[y]):
                a, b = sorted((find(x), find(y)))
                parent[b] = a
    return {d: find(d) for d in sets}


def run(spark, docs, k):
    df = spark.createDataFrame([(d, t, 1, "z") for d, t in docs], "doc_id bigint, text string, kept int, component_id string")
    return near_dup.near_duplicates(df, k).collect()


def family(rng, base, n, most):
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(rng.randrange(most)):
            w[rng.randrange(len(w))] = f"v{rng.randrange(10 ** 6)}"
        out.append(" ".join(w))
    return out


def test_families_copies_and_edges(spark):
    rng = random.Random(9)
    word = lambda: f"w{rng.randrange(5000)}"
    texts = []
    for _ in range(6):
        texts += family(rng, [word() for _ in range(120)], 40, 14)     # links, and pairs just under the threshold
    texts += ["one", "ONE", "one  ", "one two", "Two one", "", None, " \n", "solo word here"] + ["same text of copies " * 3] * 25
    texts += [" ".join(word() for _ in range(rng.randrange(1, 60))) for _ in range(150)] + ["long " + " ".join(f"x{i}" for i in range(30_000))]
    rng.shuffle(texts)
    docs = list(enumerate(texts)) + [(5, texts[6]), (7, texts[7])]
    for k in (2, 5):
        want = plain(docs, k)
        got = run(spark, docs, k)
        assert len(got) == len(docs)
        for r in got:
            assert (r["component_id"], r["kept"]) == (want[r["doc_id"]], want[r["doc_id"]] == r["doc_id"])
        sizes = {(d, len(shingles(t, k))) for d, t in docs}
        assert {(r["doc_id"], r["n_shingles"]) for r in got} == sizes


def test_rows_without_id(spark):
    got = {(r["doc_id"], r["component_id"], r["kept"]) for r in run(spark, [(None, "a b c d e"), (3, "a b c d e"), (None, "other words"), (None, None)], 2)}
    assert got == {(None, 3, False), (3, 3, True), (None, None, True)}


def test_empty_table(spark):
    assert run(spark, [], 2) == []


def test_shingle_hashes_are_the_sets():
    docs = ["a b a b a", "A B", "a", "", None, "b a", "a b c d e f"]
    values, counts = near_dup.shingle_sets(*utf8_buffer(pa.array(docs, pa.string())), 2)
    ends = np.cumsum(counts)
    hashed = [frozenset(values[e - c:e].tolist()) for e, c in zip(ends, counts)]
    for a, x in zip(docs, hashed):
        for b, y in zip(docs, hashed):
            assert len(shingles(a, 2) & shingles(b, 2)) == len(x & y)


def test_minhash_recall():
    """Pairs at the threshold share a table as often as the formula says."""
    rng = np.random.default_rng(1)
    hits = 0
    for _ in range(40):
        common, left, right = (rng.integers(0, 2 ** 63, n).astype(np.uint64) for n in (400, 50, 50))
        values = np.concatenate([common, left, common, right])
        a, b = near_dup.minhash_keys(values, np.array([450, 450]), near_dup.SIDE, near_dup.ROWS)
        hits += (a[0] == a[1]).any() and (b[0] == b[1]).any()
    assert hits >= 39


def test_components(spark):
    links = [(i, i + 1) for i in range(1, 40)] + [(100, 90), (90, 95), (7, 200), (300, 300 + 1)]
    got = {r["node"]: r["comp"] for r in near_dup.components(spark.createDataFrame(links, "x bigint, y bigint")).collect()}
    assert got == {**{i: 1 for i in range(1, 41)}, 200: 1, 90: 90, 95: 90, 100: 90, 300: 300, 301: 300}


def test_query(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    want = plain(docs, 2)
    assert {r["doc_id"]: r["component_id"] for r in registry.op8_near_dup(spark, SF_SMALL).collect()} == want
