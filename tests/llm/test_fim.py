"""Fill-in-the-middle against plain slicing, and the rank index against counting."""
import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from bankflow.llm import fim, registry
from bankflow.llm.arrow_text import utf8_buffer
from bankflow.llm.rank_index import ERROR, RankIndex, code_points
from bankflow.llm.sql import ORACLE
from tests.conftest import SF_SMALL
from tools.check_oracle import digest


def plain(key, text):
    t = text or ""
    h = hashlib.sha256(f"1:{'null' if key is None else key}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i:i + 8], 16) for i in (0, 8, 16, 24))
    a, b = sorted((h1 % (len(t) + 1), h2 % (len(t) + 1)))
    if not t or any(m in t for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return len(t), "plain", None, None, t
    p, m, s = t[:a], t[a:b], t[b:]
    if h4 % 100 < 20:
        return len(t), "spm", a, b - a, f"<S>{s}<P>{p}<M>{m}"
    return len(t), "psm", a, b - a, f"<P>{p}<S>{s}<M>{m}"


PARTS = ["a", "<", "<P", "S>", "<S>", ">", "M>", "é", "漢字", "😀", "x" * 30, "\n", "ö" * 9, "\x00"]


def some_texts(n):
    r = random.Random(3)
    return ["".join(r.choices(PARTS, [9, 3, 1, 1, .2, 1, 1, 5, 5, 5, 1, 1, 1, 1], k=r.randint(0, 60))) for _ in range(n)]


def check(spark, rows, schema="doc_id bigint, text string"):
    got = fim.fill_in_middle(spark.createDataFrame(rows, schema)).withColumn("back", fim.restore(F.col("output"), F.col("form"))).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"]) == plain(r["doc_id"], r["text"])
        assert r["back"] == (r["text"] or "")
    return got


def test_random_texts(spark):
    got = check(spark, [(i, t) for i, t in enumerate(some_texts(1500))])
    assert {"plain", "psm", "spm"} == {r["form"] for r in got}


def test_odd_rows(spark):
    long = "".join(random.Random(4).choices("abcé漢😀", k=1_500_000))
    rows = [(1, None), (2, ""), (None, "abc"), (None, None), (7, "same"), (7, "same"), (8, "é"), (9, "<P>x"), (10, "a<S"), (-5, long), (11, "a" * 3_000_000)]
    check(spark, rows)
    assert fim.fill_in_middle(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0


def test_clashing_columns(spark):
    df = spark.createDataFrame([(1, "hello there", "kept", "gone", 5)], "doc_id bigint, text string, fim_key string, form string, N int")
    out = fim.fill_in_middle(df)
    assert out.columns == ["doc_id", "text", "fim_key", "n", "form", "prefix_chars", "middle_chars", "output"]
    r = out.first()
    assert r["fim_key"] == "kept" and (r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"]) == plain(1, "hello there")


def boundaries(text):
    return np.concatenate([[0], np.cumsum([len(c.encode()) for c in text])])


def test_rank_index_is_exact_and_bounded():
    r = random.Random(5)
    for text in ["", "a", "漢", "a" * 5000, "漢" * 5000, "a" * 700 + "漢" * 900 + "é" * 300 + "b" * 2000, *("".join(r.choices("aé漢😀", [r.random() + .01 for _ in range(4)], k=r.randint(1, 9000))) for _ in range(30))]:
        data, want = np.frombuffer(text.encode(), np.uint8), boundaries(text)
        index = RankIndex(data)
        ranks = np.arange(len(text) + 1)
        assert index.count == len(text) and np.array_equal(index.offset(ranks), want)
        assert np.abs(index.predict(ranks) - want).max() <= ERROR + 1
    assert len(RankIndex(np.frombuffer(b"a" * 900_000, np.uint8)).ranks) == 1          # one segment where all code points have a size
    assert len(RankIndex(np.frombuffer(("a" * 50_000 + "漢" * 50_000).encode(), np.uint8)).ranks) <= 3


def test_rank_index_over_blocks_and_texts(monkeypatch):
    from bankflow.llm import rank_index

    monkeypatch.setattr(rank_index, "BLOCK", 1000)
    texts = some_texts(200)
    data, offsets = utf8_buffer(pa.array(texts))
    index = RankIndex(data, offsets)
    assert np.array_equal(index.offset(np.arange(index.count + 1)), boundaries("".join(texts)))
    assert code_points(data, offsets).tolist() == [len(t) for t in texts]
    junk = [b"\x80\x80a", b"", b"\xff\xfe", b"abc", b"\x81"]                # no UTF-8: a text's first byte begins a code point
    data, offsets = utf8_buffer(pa.array(junk, pa.binary()))
    index, n = RankIndex(data, offsets), code_points(data, offsets)
    assert n.tolist() == [2, 0, 2, 3, 1]
    assert index.offset(np.cumsum(n)).tolist() == offsets[1:].tolist()
    with pytest.raises(ValueError):
        RankIndex(data, error=200)


def test_query_equals_its_sql(spark, duck):
    df = registry.op12_fill_in_middle(spark, SF_SMALL)
    got = duck.execute(ORACLE["op12_fill_in_middle"])
    rows, want = [tuple(r) for r in df.collect()], got.fetchall()
    assert rows and digest(df.columns, rows)[0] == digest([d[0] for d in got.description], want)[0]
