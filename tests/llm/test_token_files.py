"""Token files against the tokenizers library, their layout and selective reads."""
import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest
from tokenizers import Tokenizer

from bankflow.llm import registry, token_files
from bankflow.session import work_dir
from tests.conftest import SF_SMALL

LIBRARY = Tokenizer.from_file(registry.WORD_BPE)
LIBRARY.encode_special_tokens = True


def ids_of(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids + [registry.END_ID]


def test_encoder_equals_the_library():
    import random

    random.seed(4)
    parts = ["a", "b ", "é", "é", "'s", "'ll", " ", "\n", "\x1c", "\u0085", " ", "12", "İ", "ΑΣ", "ß", "日本", "!", "<|endoftext|>", "́"]
    texts = ["".join(random.choices(parts, k=random.randint(0, 25))) for _ in range(2500)] + ["", None]
    ids, counts = token_files.encoder(registry.WORD_BPE).encode(texts, registry.END_ID)
    ends = np.cumsum(counts)
    for text, a, b in zip(texts, ends - counts, ends):
        assert ids[a:b].tolist() == ids_of(text)


def test_query_equals_the_library(spark):
    docs = sorted((r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect())
    got = {r["doc_id"]: r for r in registry.op2_token_files(spark, SF_SMALL).collect()}
    assert len(got) == len(docs)
    start = 0
    for doc, text in docs:
        ids = ids_of(text)
        r = got[doc]
        assert (r["start"], r["n_tokens"]) == (start, len(ids))
        assert r["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)


def test_layout_and_selective_reads(spark):
    folder = work_dir(spark, "tokens")
    token_files.write(spark.read.parquet(f"{SF_SMALL}/documents.parquet"), folder, registry.WORD_BPE, registry.END_ID)
    seen = []
    for path in spark.read.parquet(f"{folder}/tokens").inputFiles():
        meta = pq.ParquetFile(path.removeprefix("file:").replace("//", "/"))
        if not meta.metadata.num_rows:
            continue
        for i in range(meta.metadata.num_row_groups):
            columns = {meta.metadata.row_group(i).column(c).path_in_schema: meta.metadata.row_group(i).column(c) for c in range(meta.metadata.num_columns)}
            ids = columns["ids.list.element"]
            assert ids.has_offset_index and ids.has_column_index
            assert {"RLE_DICTIONARY", "DELTA_BINARY_PACKED"} & set(ids.encodings)
        seen.append([r["doc_id"] for r in meta.read(columns=["doc_id"]).to_pylist()])
    assert all(part == sorted(part) for part in seen)
    assert sorted(sum(seen, [])) == list(range(200))
    one = token_files.read_tokens(spark, folder).where("doc_id = 17")
    assert one.count() == 1
    assert "EqualTo(doc_id,17)" in one._jdf.queryExecution().executedPlan().toString()
    assert "ids" not in token_files.read_index(spark, folder).columns


def test_edges(spark):
    schema = "doc_id bigint, text string, ids int, row string"
    rows = [(5, None, 1, "a"), (5, "b c", 1, "a"), (5, "b c", 2, "b"), (None, "", 1, None), (1, "word " * 50_000, 0, "z")]
    for data in (rows, []):
        folder = work_dir(spark, "tokens")
        token_files.write(spark.createDataFrame(data, schema), folder, registry.WORD_BPE, registry.END_ID)
        index = sorted((r["start"], r["n_tokens"], r["doc_id"]) for r in token_files.read_index(spark, folder).collect())
        stored = {r["row"]: r["ids"] for r in token_files.read_tokens(spark, folder).collect()}
        assert len(index) == len(data) == len(stored)
    folder = work_dir(spark, "tokens")
    token_files.write(spark.createDataFrame(rows, schema), folder, registry.WORD_BPE, registry.END_ID)
    index = sorted((r["start"], r["n_tokens"], r["doc_id"]) for r in token_files.read_index(spark, folder).collect())
    assert index[0] == (0, 1, None) and [i[2] for i in index] == [None, 1, 5, 5, 5]
    assert all(a[0] + a[1] == b[0] for a, b in zip(index, index[1:]))


def test_other_tokenizers_are_refused():
    import public_tokenizers

    with pytest.raises(ValueError):
        token_files.check_tokenizer(public_tokenizers.path("byte_bpe_50k.json"))


def test_a_tokenizer_with_capitals_is_refused(tmp_path):
    """The encoder takes words of letters without regard to case, so the tokenizer must do so, too."""
    import json

    spec = json.load(open(registry.WORD_BPE))
    token_files.check_tokenizer(registry.WORD_BPE)
    spec["normalizer"]["normalizers"] = [n for n in spec["normalizer"]["normalizers"] if n["type"] != "Lowercase"]
    cased = tmp_path / "cased.json"
    cased.write_text(json.dumps(spec))
    with pytest.raises(ValueError):
        token_files.check_tokenizer(str(cased))
