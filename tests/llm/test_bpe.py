"""Byte-level BPE against the tiktoken library, and exact round trips."""
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from bankflow.llm import bpe
from bankflow.llm.arrow_text import utf8_buffer
from tests.conftest import SF_SMALL

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
LIBRARY = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.load_ranks(PATH), special_tokens={})


def check(texts):
    import pyarrow as pa

    codec = bpe.codec(PATH)
    data, offsets = utf8_buffer(pa.array(texts, pa.string()))
    ids, counts, at = codec.encode(data, offsets)
    ends = np.cumsum(counts)
    for text, a, b in zip(texts, ends - counts, ends):
        assert ids[a:b].tolist() == LIBRARY.encode_ordinary(text or "")
    out, size = codec.decode(ids, at, counts)
    assert out.tobytes() == data.tobytes()
    assert size.tolist() == np.diff(offsets).tolist()


def test_mixed_pieces():
    random.seed(3)
    parts = ["'s", "'t", "'re", "'ve", "'ll", "'d", "'m", "'", " ", "  ", "\n", "\t", " ", " ", "a", "S", "é", "日本", "1", "٣", "!", "😀", "x'"]
    check(["".join(random.choices(parts, k=random.randint(0, 30))) for _ in range(4000)] + ["", None, " ", "\n\n", "'"])


def test_long_pieces_and_blocks():
    check(["a" * 5000, " " * 3000, "ab" * 2000 + " " + "!" * 700, "word " * 4000, "x" * 255, "x" * 256, "x" * 257])


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.characters(exclude_categories=["Cs", "Cn"], max_codepoint=0x2FFF), max_size=40), max_size=4))
def test_any_text(texts):
    check(texts)


def test_scan_is_the_sequential_run():
    random.seed(5)
    _, states, of_symbol, _ = bpe.monoid()
    for n in (0, 1, 255, 256, 257, 70_000):
        symbols = np.array([random.randrange(2 * bpe.N_SYMBOLS) for _ in range(n)], np.int64)
        got = states[bpe.scan(of_symbol[symbols]), bpe.CLOSED]
        state = bpe.CLOSED
        for i in range(n):
            assert got[i] == state
            state = bpe.step(state, int(symbols[i]))[0]


def test_query_equals_the_library(spark):
    from bankflow.llm.registry import op7_byte_bpe

    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()}
    rows = op7_byte_bpe(spark, SF_SMALL).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = LIBRARY.encode_ordinary(texts[r["doc_id"]] or "")
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256((texts[r["doc_id"]] or "").encode()).hexdigest()


def test_edges(spark):
    schema = "doc_id bigint, text string, bpe_ids string, n_tokens int, extra int"
    rows = [(1, None, "x", 7, None), (1, None, "x", 7, None), (None, "", None, None, 3), (2, "a'll go " * 30_000, "y", 1, 1)]
    out = bpe.decode(bpe.encode(spark.createDataFrame(rows, schema), PATH), PATH)
    got = out.withColumn("n", F.octet_length("bpe_ids") / 4).collect()
    assert sorted((r["n_tokens"], r["n"]) for r in got)[:3] == [(0, 0.0)] * 3
    assert all(r["decoded"] == bytearray((r["text"] or "").encode()) for r in got)
    assert {r["extra"] for r in got} == {None, 3, 1}
    empty = bpe.decode(bpe.encode(spark.createDataFrame([], schema), PATH), PATH)
    assert empty.count() == 0 and "decoded" in empty.columns


@pytest.mark.parametrize("piece", [b"hello", b"\xff\xfe", b"aaaaaaa", "日本語日本語".encode(), b"abcabcabd" * 6, b"unbelievably so" * 4])
def test_short_and_long_merging_agree(piece):
    merges = bpe._merges(PATH)
    ids = [merges.single[b] for b in piece]
    assert merges._short(list(ids)) == merges._long(list(ids))
    tokens = {rank: token for token, rank in merges.ranks.items()}
    assert b"".join(tokens[i] for i in merges.merge(piece)) == piece
