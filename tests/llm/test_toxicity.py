"""Toxicity: the machine on sentences, learning, held-out accuracy."""
import random
import zlib

from pyspark.sql import functions as F

from bankflow.llm import registry, toxicity

SF = "/root/testdata/sf0.01"
I, T = toxicity.INSULT, toxicity.THREAT


def matched(text, lexicon=None):
    values = toxicity.Grammar(lexicon or {"idiot$": 5.0, "sçum": 4.0}).patterns(text)
    return {p for p, v in zip(toxicity.PATTERNS, values) if v > 0}


def test_clauses():
    assert matched("what an idiot.") == {(I, 0, 0, 0)}
    assert matched("you are an IDIOT!") == {(I, 1, 0, 0)} == matched("idiot you") == matched("an idiot is what you are")
    assert matched("you are there. an idiot came") == {(I, 0, 0, 0)}
    assert matched("you are not an idiot") == {(I, 1, 1, 0)}
    assert matched("not now; an idiot") == {(I, 0, 0, 0)}
    assert matched("they said she is an idiot") == {(I, 1, 0, 1)}
    assert matched('a note: "idiot" it read') == {(I, 0, 0, 1)}
    assert matched("i will kill you") == {(T, 1, 0, 0)} and matched("kill the light") == {(T, 0, 0, 0)}
    assert matched("idiots sçumeux sçum") == {(I, 0, 0, 0)}
    assert matched("You aren't an idiot") == matched("you’re here and you don’t need an idiot") == {(I, 1, 1, 0)}
    assert matched("I won't kill you") == {(T, 1, 1, 0)} and matched("tu n'es qu'sçum") == {(I, 1, 1, 0)}
    assert matched("won't; an idiot") == {(I, 0, 0, 0)} and matched("wasn'tidiot") == set()
    assert matched("He said: you are an idiot") == {(I, 1, 0, 1)} and matched("never: an idiot") == {(I, 0, 0, 0)}
    assert matched('"Go home. You are an idiot," he said') == {(I, 1, 0, 1)}
    assert matched('He said: "You are nice. Go away." You idiot!') == {(I, 1, 0, 0)}
    assert matched('„Geh heim. Du idiot.“ Ende') == {(I, 1, 0, 1)}
    assert matched('an open " quote\nyou idiot') == {(I, 1, 0, 0)} and matched('an open " quote. you idiot') == {(I, 1, 0, 1)}
    assert matched("") == matched(None) == matched("all fine, nothing here") == set()


def test_composition_is_the_chain():
    """The composed machine gives what its parts give one after the other."""
    rng = random.Random(3)
    machine = toxicity.Machine([toxicity.negation, toxicity.reported, toxicity.target], [(0,), (0, 0), (0, (), 0)])
    for _ in range(400):
        stream = [(k, 2.0 if k <= T else 0, 0, 0, 0) for k in rng.choices(range(toxicity.END), weights=[3, 2, 2, 2, 1, 1, 4, 1], k=rng.randrange(14))]
        want = [*stream, (toxicity.END, 0, 0, 0, 0)]
        for step, state in zip((toxicity.negation, toxicity.reported, toxicity.target), ((0,), (0, 0), (0, (), 0))):
            out = []
            for s in want:
                state, more = step(state, s)
                out += more
            want = out
        assert machine.run(stream) == [s for s in want if s[0] <= T]


def test_held_out_accuracy(spark):
    truth = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    rows = registry.op9_toxicity(spark, SF).collect()
    assert len(rows) == 1000
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) and 0 <= r["score"] <= 1 for r in rows)
    assert all(r["predicted"] == int(r["score"] >= 0.7) for r in rows)
    pairs = [(truth[r["doc_id"]], r["predicted"]) for r in rows if r["held_out"] and r["doc_id"] in truth]
    clean = [p for t, p in pairs if not t]
    toxic = [p for t, p in pairs if t]
    assert sum(clean) <= 0.02 * len(clean)
    assert sum(toxic) >= 0.6 * len(toxic)     # a third of the toxic texts use stems that 34 training texts rarely show


def test_edges(spark):
    docs = spark.createDataFrame([(1, "you idiot", 1), (2, None, 2), (3, "", 3), (None, "nice words here", 4), (5, "idiot " * 50_000, 5), (1, "you idiot", 1)],
                                 "doc_id bigint, text string, score int")
    labels = spark.createDataFrame([(1, 1), (1, 0), (None, 1), (99, 1), (2, None)], "doc_id bigint, toxic int")
    for these in (labels, labels.limit(0)):
        out = toxicity.score(docs, toxicity.train(docs, these)).collect()
        assert len(out) == 6 and all(0 <= r["score"] <= 1 for r in out)
    assert toxicity.score(docs.limit(0), toxicity.train(docs.limit(0), labels)).count() == 0


def test_only_verified_near_copies_count_once(spark):
    """Unlike texts share the first table's minhashes: each counts, with its own label. Near copies count once."""
    rng = random.Random(9)
    pool = ["".join(rng.choices("bcdfghklmnprst", k=9)) for _ in range(3000)]
    hashed = spark.createDataFrame([(w,) for w in pool], "w string")
    shared = list(hashed.agg(*[F.min_by("w", F.xxhash64("w", F.lit(s))) for s in range(4)]).first())
    texts = [(i, " ".join([*shared, *rng.sample(pool, 30), "vileworm" if i < 20 else "lovely"]), int(i < 20)) for i in range(60)]
    base = rng.sample(pool, 60)
    texts += [(100 + i, " ".join([*base[:i], *base[i + 1:], "copyword"]), 1) for i in range(40)]
    rows = spark.createDataFrame([*texts, (200, texts[0][1], 0)], "id bigint, text string, toxic int")
    lexicon = toxicity.learn_lexicon(rows)
    assert any("vileworm$".startswith(e) for e in lexicon)
    assert not any(w.startswith(e.rstrip("$")) for e in lexicon for w in ("lovely", "copyword"))
    words = rows.select("id", "toxic", F.sort_array(F.split("text", " ")).alias("words"))
    counted = {r["id"]: r["toxic"] for r in toxicity.families(words).collect()}
    assert {i: t for i, t in counted.items() if i < 100} == {i: t for i, _, t in texts[:60]}
    assert 200 not in counted and 1 <= sum(100 <= i < 200 for i in counted) <= 2


def plain_patterns(text, lexicon):
    """The patterns by rules over the tokens, without machines: every mark is looked for from the insult or threat itself."""
    import math
    import re

    words = re.findall("[^\\W\\d_]*n['’]t(?![^\\W\\d_])|(?<![^\\W_])n['’](?=[^\\W\\d_])|[^\\W\\d_]+|[.;:!?\n]|[\"“”„«»]", (text or "").lower())

    def weight(w):
        if re.search("n['’]t$", w) or not w[0].isalpha():
            return None
        w = w.replace("’", "'")
        for entry in [w + "$", *(w[:n] for n in range(min(8, len(w)), 2, -1))]:
            if entry in lexicon:
                return I, round(lexicon[entry], 1)
        return (T, 1.0) if w in toxicity.THREATS else None

    def is_of(w, closed):
        return weight(w) is None and w.replace("’", "'") in closed

    sums = dict.fromkeys(toxicity.PATTERNS, 0.0)
    ends = lambda marks: [-1, *(j for j, w in enumerate(words) if w in marks), len(words)]
    clause, part = ends(".;!?\n"), ends(".;!?\n:")
    for i, w in enumerate(words):
        if not weight(w):
            continue
        kind, value = weight(w)
        begin, stop = max(j for j in part if j < i), min(j for j in part if j > i)
        near = [j for j in range(max(begin + 1, i - toxicity.REACH), i)]
        negated = any(re.search("n['’]t$", words[j]) or is_of(words[j], toxicity.NEGATIONS) for j in near)
        person, left = any(is_of(words[j], toxicity.TARGETS) for j in near), toxicity.REACH
        for j in range(i + 1, stop):                  # what waits for a person waits on with the next insult
            person = person or is_of(words[j], toxicity.TARGETS)
            if person or left == 0:
                break
            left = toxicity.REACH if weight(words[j]) else left - 1
        line = max([-1, *(j for j in range(i) if words[j] == "\n")])
        quoted = sum(words[j] in "\"“”„«»" for j in range(line + 1, i)) % 2
        verb = any(is_of(words[j], toxicity.SPEECH) for j in range(max(j for j in clause if j < i) + 1, i))
        sums[kind, int(person), int(negated), int(verb or quoted)] += value
    return [math.log1p(sums[p]) for p in toxicity.PATTERNS]


def test_machine_equals_plain_rules():
    rng = random.Random(8)
    lexicon = {"idiot$": 5.0, "sçum": 4.0}
    parts = ["idiot", "you", "not", "isn't", "said", '"', ".", ":", "\n", "word", "more", "than", "that", "„", "n'est", "kill"]
    for _ in range(3000):
        words = rng.choices(parts, [1, 2, 2, 1, 1, 2, 1, 1, 1, 4, 4, 3, 3, 1, 1, 0.5], k=rng.randrange(18))
        text = " ".join(words)
        assert toxicity.Grammar(lexicon).patterns(text) == plain_patterns(text, lexicon), text


def test_query_equals_plain_rules(spark):
    """Scores of the whole query from the lexicon and weights of its model, by plain rules, and the lexicon by a recount."""
    import math

    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.train(docs, labels)
    lexicon, texts = dict(model["lexicon"]), {r["doc_id"]: r["text"] for r in docs.collect()}
    assert lexicon
    got = {r["doc_id"]: r["score"] for r in registry.op9_toxicity(spark, SF).collect()}
    for doc, text in texts.items():
        found = plain_patterns(text, lexicon)
        want = 1 / (1 + math.exp(-(model["bias"] + sum(v * w for v, w in zip(found, model["weights"])))))
        assert abs(got[doc] - want) < 1e-9, text
    rows = toxicity.training_rows(docs, labels, "doc_id", "text", "toxic").where(F.pmod(F.xxhash64("id"), F.lit(4)) != 0)
    words = F.sort_array(F.array_distinct(F.filter(F.split(F.lower("text"), toxicity.WORD_BREAK), lambda w: F.length(w) >= 3)))
    counted = [(r["toxic"], r["words"]) for r in toxicity.families(rows.select("id", "toxic", words.alias("words")).where(F.size("words") > 0)).collect()]
    bad, good = (sum(t == k for t, _ in counted) for k in (1, 0))
    for entry, weight in lexicon.items():
        hits = [(t, sum((w + "$" == entry) or (not entry.endswith("$") and w.startswith(entry)) for w in ws)) for t, ws in counted]
        toxic, other = (sum(n for t, n in hits if t == k) for k in (1, 0))
        assert abs(weight - (math.log((toxic + 0.5) / (bad + 1)) - math.log((other + 0.5) / (good + 1)))) < 1e-9
        assert toxic >= max(toxicity.MIN_TEXTS, toxicity.MIN_SHARE * bad) and weight >= toxicity.MIN_ODDS
