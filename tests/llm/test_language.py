"""Language identification: the automaton against plain parsing, held-out accuracy."""
import random
import re
import unicodedata
import zlib

import numpy as np
import pyarrow as pa

from bankflow.llm import language, registry
from bankflow.llm.arrow_text import utf8_buffer

SF = "/root/testdata/sf0.01"


def phrases(text, sample):
    count, at = 0, 0
    while at < len(text):
        n = 1
        while at + n <= len(text) and text[at:at + n] in sample:
            n += 1
        at += max(n - 1, 1)
        count += 1
    return count


def test_automaton_parses_like_a_search():
    rng = random.Random(8)
    for _ in range(60):
        sample = "".join(rng.choices("abc ", k=rng.randrange(1, 60)))
        automaton = language.Automaton(np.array([ord(c) for c in sample], np.uint32))
        texts = sorted(("".join(rng.choices("abcx ", k=rng.randrange(1, language.LANE))) for _ in range(5)), key=len, reverse=True)
        lanes = np.zeros((language.LANE, 5), np.uint32)
        for i, t in enumerate(texts):
            lanes[:len(t), i] = [ord(c) for c in t]
        active = np.array([sum(len(t) > row for t in texts) for row in range(language.LANE)])
        assert automaton.phrases(lanes, active).tolist() == [phrases(t, sample) for t in texts]


def test_memory_follows_the_sample_not_the_alphabet():
    rng = np.random.default_rng(5)
    for symbols in (60, 2_000, 6_000):
        sample = (0x4E00 + rng.zipf(1.3, language.SAMPLE_CHARS) % symbols).astype(np.uint32)
        automaton = language.Automaton(sample)
        assert sum(a.nbytes for a in (automaton.base, automaton.owner, automaton.move)) < 3_000_000
        text = "".join(map(chr, sample[100:140])) + "x" + "".join(map(chr, rng.permutation(sample)[:200]))
        lanes = np.zeros((language.LANE, 1), np.uint32)
        lanes[:len(text), 0] = [ord(c) for c in text]
        want = phrases(text, "".join(map(chr, sample)))
        assert automaton.phrases(lanes, (np.arange(language.LANE) < len(text)).astype(int)).tolist() == [want]


def plain_prediction(text, samples):
    """Language and score by searching the samples."""
    folded = lambda t: re.sub(" +", " ", "".join(
        (c.lower() if len(c.lower()) == 1 else c) if unicodedata.category(c)[0] == "L" else " " for c in t)).lstrip(" ")
    own = folded(text or "")
    if not own.strip():
        return "und", 0.0
    lanes = [own[i:i + language.LANE] for i in range(0, len(own), language.LANE)]
    rates = []
    for lang, sample in samples:
        known = folded(sample)
        rates.append((sum(phrases(lane, known) for lane in lanes) * np.log2(max(len(known), 2)) / len(own), lang))
    (best, lang), (second, _) = sorted(rates)[:2]
    return lang, (second - best) / second


def test_query_equals_plain_parsing(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    samples = language.learn(docs)
    got = {r["doc_id"]: r for r in registry.op10_language(spark, "/root/testdata/sf0.001").collect()}
    rows = docs.select("doc_id", "text").collect()
    assert len(got) == len(rows) and len(samples) > 1
    for r in rows:
        lang, score = plain_prediction(r["text"], samples)
        assert got[r["doc_id"]]["lang_pred"] == lang and abs(got[r["doc_id"]]["score"] - score) < 1e-9


def test_fold():
    data, offsets = utf8_buffer(pa.array(["Ab, c!", None, "  é1É ", "日本", "...", "x"]))
    codes, at, letters = language.fold(data, offsets)
    got = ["".join(map(chr, codes[a:b])) for a, b in zip(at, at[1:])]
    assert got == ["ab c ", "", "é é ", "日本", "", "x"] and letters.tolist() == [3, 0, 2, 2, 0, 1]


def test_held_out_accuracy(spark):
    truth = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang").collect()}
    rows = registry.op10_language(spark, SF).collect()
    assert len(rows) == len(truth)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) and 0 <= r["score"] <= 1 for r in rows)
    held = [r for r in rows if r["held_out"]]
    assert sum(r["lang_pred"] == truth[r["doc_id"]] for r in held) >= 0.97 * len(held)


def test_edges(spark):
    schema = "doc_id bigint, text string, lang string, score string"
    rows = [(1, "hello there friend", "en", "x"), (2, "hallo mein freund", "de", None), (3, None, "en", None), (4, "123 !", "de", None),
            (5, "", None, None), (None, "hello friend", None, None), (6, "mein freund " * 40_000, None, None), (1, "hello there friend", "en", "x")]
    docs = spark.createDataFrame(rows, schema)
    samples = language.learn(docs)
    assert [lang for lang, _ in samples] == ["de", "en"]
    got = [(r["doc_id"], r["lang_pred"]) for r in language.predict(docs, samples).collect()]
    assert got == [(1, "en"), (2, "de"), (3, "und"), (4, "und"), (5, "und"), (None, "en"), (6, "de"), (1, "en")]
    none = language.learn(docs.where("lang is null"))
    assert none == () and {r["lang_pred"] for r in language.predict(docs, none).collect()} == {"und"}
    assert language.predict(docs.limit(0), samples).count() == 0
