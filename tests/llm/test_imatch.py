"""I-Match fingerprints against a version with plain sets and Python integers."""
import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash

from bankflow.llm import imatch, registry
from bankflow.llm.arrow_text import utf8_buffer
from tests.conftest import SF_SMALL

M64 = 2 ** 64 - 1
WORD = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
CAPITALS = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
STEP = 0x9E3779B97F4A7C15


def mix(x):
    x ^= x >> 30
    x = x * 0xBF58476D1CE4E5B9 & M64
    x ^= x >> 27
    x = x * 0x94D049BB133111EB & M64
    return x ^ x >> 31


def term_hash(word):
    data = word.encode()
    if len(data) > 48:
        return mix(xxhash.xxh3_64_intdigest(data))
    h = 0xCBF29CE484222325
    for b in data:
        h = (h ^ b) * 0x100000001B3 & M64
    return mix(h)


def terms_of(text):
    return {term_hash(w) for w in WORD.findall(text.translate(CAPITALS))}


def sequence(terms):
    if not terms:
        return 0
    return mix((sum(mix((t + (i + 1) * STEP) & M64) for i, t in enumerate(sorted(terms))) + len(terms)) & M64) | 1


def subset(terms, j, level):
    return {t for t in terms if mix((t + (j + 1) * STEP) & M64) <= M64 >> level}


def fingerprint(text, words):
    terms = terms_of(text)
    level = int(math.log2(max(len(terms), 1)))
    kept = [t for t in terms if t in words]
    prints = [[sequence(subset(kept, j, r)) >> 32 for j in range(imatch.SUBSETS)] for r in (level, level + 1)]
    if not any(prints[0]):
        return f"all-{sequence(terms) or xxhash.xxh3_64_intdigest(text.encode()):016x}"
    return "-".join([f"{level:02d}", *("".join(f"{h:08x}" for h in p) for p in prints)])


def likeness(a, b):
    if a == b:
        return 1.0
    a, b = a.split("-"), b.split("-")
    if "all" in (a[0], b[0]) or abs(int(a[0]) - int(b[0])) > 1:
        return 0.0
    level = max(int(a[0]), int(b[0]))
    x, y = (re.findall("." * 8, p[1 + level - int(p[0])]) for p in (a, b))
    some = [p == q for p, q in zip(x, y) if p != "0" * 8 or q != "0" * 8]
    return sum(some) / len(some) if some else 0.0


def plain(rows):
    """{position in order: result} of (key, text) rows that are in order."""
    texts = [t or "" for _, t in rows]
    count = Counter(t for x, (_, raw) in zip(texts, rows) if raw is not None for t in terms_of(x))
    total = sum(raw is not None for _, raw in rows)
    words = {t for t, n in count.items() if n >= imatch.LEAST and n <= max(imatch.MOST * total, imatch.LEAST)}
    out = []
    for i, text in enumerate(texts):
        after, q = texts[(i + 1) % len(texts)], len(text) // 4
        edited = text[:len(text) - q] + after[:q]
        own, new, other = (fingerprint(t, words) for t in (text, edited, after))
        out.append((rows[i][0], len(text), hashlib.sha256(edited.encode()).hexdigest(), own, new, likeness(own, new), likeness(own, other)))
    return out


def result(df):
    return [(r["doc_id"], r["n_chars"], r["edited_sha256"], r["fingerprint"], r["edited_fingerprint"], r["near_edited"], r["near_next"]) for r in df.collect()]


def order(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, *[x if x is not None else 0 for x in r]))


def some_rows(n, seed=1):
    r = random.Random(seed)
    vocabulary = ["".join(r.choices("abcdefgéöß漢", k=r.randint(1, 9))) for _ in range(400)] + ["Word" * 15, "X9"]
    text = lambda: " ".join(r.choices(vocabulary, k=r.choice([0, 1, 2, 5, 20, 100, 400])))
    return [(i, text()) for i in range(n)]


def test_words_and_hashes():
    texts = ["", "Ab ab,AB  c", "漢字 é!é", " ", "x" * 47 + " " + "x" * 48 + " " + "x" * 49 + " " + "X" * 200, "a-b_c", None, "tail"]
    of, h = imatch.text_terms(*utf8_buffer(pa.array(texts)))
    for i, text in enumerate(texts):
        assert sorted(h[of == i].tolist()) == sorted(terms_of(text or ""))


def test_words_in_blocks(monkeypatch):
    monkeypatch.setattr(imatch, "WORDS_AT_ONCE", 7)
    texts = [t for _, t in some_rows(60)]
    of, h = imatch.text_terms(*utf8_buffer(pa.array(texts)))
    assert [sorted(h[of == i].tolist()) for i in range(60)] == [sorted(terms_of(t)) for t in texts]
    assert (np.diff(of) >= 0).all()


def test_equals_the_plain_version(spark):
    rows = some_rows(150)
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    assert sorted(result(imatch.edited_fingerprints(df))) == plain(rows)


def test_query_equals_the_plain_version(spark):
    rows = sorted((r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect())
    assert sorted(result(registry.op13_imatch(spark, SF_SMALL))) == plain(rows)


def test_odd_rows(spark):
    rows = [(None, "a null id"), (1, None), (2, ""), (3, "abc"), (4, "!!! ???"), (6, "same text here"), (7, "same text here"), (8, "é" * 3), (9, "word " * 120_000),
            (10, "".join(chr(97 + i % 26) + (" " if i % 5 == 0 else "") for i in range(200_000))), (11, "q" * 100_000), (12, "!!! ???")]
    got = {r[0]: r for r in result(imatch.edited_fingerprints(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)))}
    assert [got[r[0]] for r in rows] == plain(rows)
    assert got[6][3] == got[7][3] and got[6][6] == 1.0 and got[1][3] == got[2][3] and got[3][5] == 1.0 - (got[3][3] != got[3][4])
    assert got[4][3] == got[12][3] != got[2][3]


def test_repeated_rows_and_one_row(spark):
    rows = [(5, "one two three four"), (5, "one two three four"), (5, "one two three four"), (9, "other words")]
    got = sorted(result(imatch.edited_fingerprints(spark.createDataFrame(rows, "doc_id bigint, text string"))))
    assert got == sorted(plain(rows))
    alone = [(1, "only one text in here")]
    assert result(imatch.edited_fingerprints(spark.createDataFrame(alone, "doc_id bigint, text string"))) == plain(alone)


def test_empty_and_clashing(spark):
    assert imatch.edited_fingerprints(spark.createDataFrame([], "doc_id bigint, text string")).collect() == []
    rows = some_rows(20, seed=2)
    df = spark.createDataFrame([(*r, "r", 1, "gone", "k") for r in rows], "doc_id bigint, text string, row string, part int, fingerprint string, key string")
    out = imatch.edited_fingerprints(df, keep=["doc_id", "row", "part", "fingerprint", "key"])
    assert out.columns == ["doc_id", "row", "part", "key", *imatch.ADDED]
    assert sorted(result(out)) == plain(rows) and out.first()["row"] == "r" and out.first()["key"] == "k"


def test_edited_texts_are_nearer_than_next_ones(spark):
    rows = registry.op13_imatch(spark, "/root/testdata/sf0.01").where("n_chars >= 200").select("near_edited", "near_next").collect()
    edited, after = (np.array([r[c] for r in rows]) for c in ("near_edited", "near_next"))
    assert edited.mean() > 0.25 and np.median(after) == 0.0
    assert (edited > after).mean() > 0.95
