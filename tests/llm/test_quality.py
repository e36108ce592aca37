"""Repetition rules against a plain recount."""
import random
import re
from collections import Counter

import pyarrow as pa

from bankflow.llm import quality, registry
from bankflow.llm.arrow_text import utf8_buffer
from tests.conftest import SF_SMALL


def covered(words, n):
    at = Counter(tuple(words[i:i + n]) for i in range(len(words) - n + 1))
    out = set()
    for i in range(len(words) - n + 1):
        if at[tuple(words[i:i + n])] > 1:
            out.update(range(i, i + n))
    return out


def plain(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0d]+", text)
    lines, seen, dup_chars = 0, set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0d]", line):
            if line in seen:
                lines, dup_chars = lines + 1, dup_chars + len(line)
            seen.add(line)
    n, repeat = len(words), len(covered(words, 8))
    got = {"n_words": n, "word_chars": sum(map(len, words)), "n_symbols": sum(text.count(c) for c in "#*$%&|<>"),
           "n_dup_lines": lines, "n_repeat_words": repeat, "dup_line_chars": dup_chars, "base_failed": n < 20 or 100 * repeat > 30 * n}
    bad = dup_chars > quality.LINE_LIMIT * max(len(text), 1)
    for k, limit in quality.WINDOW_LIMITS.items():
        got[f"dup_{k}gram_chars"] = sum(len(words[i]) for i in covered(words, k))
        bad |= got[f"dup_{k}gram_chars"] > limit * max(got["word_chars"], 1)
    return got | {"kept": not got["base_failed"] and not bad}


def check(texts):
    got = quality.measure(*utf8_buffer(pa.array(texts, pa.string())))
    for i, text in enumerate(texts):
        want = plain(text)
        assert {k: got[k][i].item() for k in want} == want, text


def test_random_texts():
    random.seed(2)
    parts = ["a ", "b ", "a b c d e f g h ", "x\n", "\n", "é ", "word word ", "#", "| ", "a b c d e f g h i j\n", "\x0b", " "]
    check(["".join(random.choices(parts, k=random.randint(0, 40))) for _ in range(1500)] + ["", None, "\n\n", "a\na\n a\na"])


def test_query_equals_the_recount(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()}
    rows = registry.op5_repetition(spark, SF_SMALL).collect()
    assert len(rows) == len(texts)
    for r in rows:
        want = plain(texts[r["doc_id"]])
        assert {k: r[k] for k in want} == want


def test_edges(spark):
    schema = "doc_id bigint, text string, kept string, n_words string"
    rows = [(1, None, "x", None), (1, None, "x", None), (None, "", "y", "z"), (2, "one two three " * 60_000, None, None)]
    got = quality.repetition(spark.createDataFrame(rows, schema)).collect()
    assert [r["n_words"] for r in got] == [0, 0, 0, 180_000]
    assert [r["kept"] for r in got] == [False] * 4
    assert quality.repetition(spark.createDataFrame([], schema)).count() == 0
