"""The pipeline, stage by stage, against plain versions of what each stage decides."""
import numpy as np

import corpus_pipeline
from bankflow.llm import bpe, registry, secrets, toxicity
from bankflow.session import cut_lineage
from tests.llm.test_decontaminate import plain as contaminated
from tests.llm.test_near_dup import plain as components
from tests.conftest import SF_SMALL


def rows(df):
    return sorted((tuple(r) for r in df.select("doc_id", "text", "lang", "source", "n_chars").collect()), key=str)


def test_stages(spark):
    docs = registry.table(spark, SF_SMALL, "documents")
    items = [tuple(r) for r in registry.table(spark, SF_SMALL, "benchmark").select("item_id", "text").collect()]
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_copies", "decontamination", "secrets", "encoding"]
    for name, stage in corpus_pipeline.STAGES:
        before = rows(docs)
        after = cut_lineage(stage(spark, docs, SF_SMALL), "stage")
        if name == "toxicity":
            model = toxicity.train(docs, registry.table(spark, SF_SMALL, "labels"))
            grammar, weights = toxicity.Grammar(dict(model["lexicon"])), model["weights"]
            logit = lambda t: model["bias"] + sum(x * w for x, w in zip(grammar.patterns(t), weights))
            want = [r for r in before if 1 / (1 + np.exp(-logit(r[1]))) < toxicity.THRESHOLD]
        elif name == "near_copies":
            comp = components([r[:2] for r in before], 5)
            want = [r for r in before if comp[r[0]] == r[0]]
        elif name == "decontamination":
            hit = {d for d, _, n, _ in contaminated([r[:2] for r in before], items) if n}
            want = [r for r in before if r[0] not in hit]
        elif name == "secrets":
            spans = {r["doc_id"]: r["spans"] for r in secrets.scan(docs).collect()}
            want = []
            for r in before:
                text, at, out = r[1], 0, ""
                for s in spans[r[0]]:
                    if s["start"] >= at:
                        out += text[at:s["start"]] + "[SECRET]"
                    at = max(at, s["end"])
                want.append((r[0], out + text[at:], r[2], r[3], len(out + text[at:]) if spans[r[0]] else r[4]))
            want.sort(key=str)
        else:
            out = bpe.decode(after, registry.BYTE_RANKS)
            assert {r["doc_id"]: bytes(r["decoded"]).decode() for r in out.collect()} == {r[0]: r[1] for r in before}
            continue
        assert after.columns == docs.columns
        assert rows(after) == want
        docs = after
    assert corpus_pipeline.run(spark, SF_SMALL).count() == docs.count()


def test_stages_take_odd_rows(spark):
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, predicted int, text_hash string"
    odd = [(None, None, None, None, None, None, None), (None, "", None, None, None, 1, "x"), (1, "a b c", None, "s", 5, 0, None),
           (1, "a b c", None, "s", 5, 0, None), (None, "token=abcdefgh1", "en", None, 1, None, None), (2, "word " * 30_000, "en", "s", 1, 1, None)]
    for data in (odd, []):
        docs = spark.createDataFrame(data, schema)
        for name, stage in corpus_pipeline.STAGES:
            docs = cut_lineage(stage(spark, docs, SF_SMALL), "stage")
            repeated = 1 if data and name != "toxicity" else 0          # of the two rows (1, "a b c") one stays
            assert docs.count() == len(data) - repeated, name


def test_one_of_repeated_rows_stays(spark):
    rows = [(1, "some text of more than five words"), (1, "some text of more than five words"), (1, "another"), (None, "no id"), (None, "no id"),
            (None, None), (None, None), (2, ""), (2, "")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = corpus_pipeline.drop_near_copies(spark, docs, SF_SMALL).collect()
    assert sorted(map(tuple, got), key=str) == sorted([rows[0], rows[2], rows[3], *rows[5:]], key=str)
