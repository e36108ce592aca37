"""Benchmark decontamination against a plain search."""
import hashlib
import re

from bankflow.llm import decontaminate, registry
from tests.conftest import SF_SMALL

LOWER = {i: i + 32 for i in range(65, 91)}


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def plain(docs, items, width=10):
    windows = {}
    for item, text in items:
        w = words(text)
        for i in range(max(len(w) - width, 0) + 1):
            if w:
                windows.setdefault(tuple(w[i:i + width]), set()).add(item)
    sizes = {len(w) for w in windows}
    out = []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for size in sizes:
            for i in range(len(w) - size + 1):
                if tuple(w[i:i + size]) in windows:
                    hit.update(range(i, i + size))
                    found |= windows[tuple(w[i:i + size])]
        out.append((doc, len(w), len(hit), sorted(str(i) for i in found if i is not None)))
    return out


def run(spark, docs, items):
    d = spark.createDataFrame([(*r, 1, "z") for r in docs], "doc_id bigint, text string, n_hit int, near string")
    i = spark.createDataFrame(items, "item_id bigint, text string")
    return sorted(((r["doc_id"], r["n_words"], r["n_hit"], r["items"]) for r in decontaminate.contamination(d, i).collect()), key=str)


def test_windows_short_items_and_ties(spark):
    long_item = "One two, THREE four five six seven eight nine ten eleven twelve"
    items = [(1, long_item), (2, "just three words"), (3, long_item), (3, "solo"), (None, "no id here at all"), (7, None), (8, "..."),
             (9, "ÄRGER über alles hier"), (10, "a pair")]
    docs = [(1, "zero one two three four five six seven eight nine ten end"), (2, "two three four five six seven eight nine ten eleven-twelve. x"),
            (3, "Just THREE words; just three words! A pair"), (4, None), (5, ""), (None, "solo solo"), (6, "no id here at all"), (6, "no id here at all"),
            (7, "one two three four five six seven eight nine"), (8, "Ärger über alles hier"), (9, "ÄRGER ÜBER alles hier"), (10, "ÄRGER über Alles HIER"),
            (11, "filler words " * 20_000 + long_item)]
    assert run(spark, docs, items) == sorted(plain(docs, items), key=str)


def test_empty_tables(spark):
    assert run(spark, [], [(1, "some words here")]) == []
    assert run(spark, [(1, "some words here")], []) == [(1, 3, 0, [])]
    assert run(spark, [(1, "some words here")], [(1, None), (2, "?")]) == [(1, 3, 0, [])]


def test_query_equals_the_search(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").select("item_id", "text").collect()]
    want = {d: (n, h, len(i), hashlib.sha256(",".join(i).encode()).hexdigest(), h > 0) for d, n, h, i in plain(docs, items)}
    got = {r["doc_id"]: (r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"])
           for r in registry.op1_decontaminate(spark, SF_SMALL).collect()}
    assert got == want
    assert any(v[4] for v in want.values())
