"""Toxicity by a weighted finite-state pattern grammar (operator 9).

A text is cut into clauses. In each, a lexical transducer turns words into symbols: insult (with a weight), threat, target,
negation, reported speech, other. Three more transducers rewrite that stream, one after the other: negation marks
insults and threats that follow a negation within reach, reported speech marks those behind a speech verb or inside quotes, target
marks those that meet a person near by. They are composed into one machine whose product states are built when first met.
Its output counts weighted clause patterns, e.g. "insult at a target, not negated, not reported", and a logistic layer over
the patterns gives the score. So a word counts by the clause it stands in.

Learned from labelled rows: the insult lexicon, word stems and whole words with their log odds over all training texts (verified
near copies of one text count once), and the logistic layer, from at most ``FIT_ROWS`` training rows. An entry is in ``MIN_SHARE`` of the
toxic training texts or more, so the lexicon is as large as their words allow and does not grow with their number. The closed classes (threat verbs, persons, negations, speech verbs) are fixed lists.

Defined cases: a null or empty text, and one without a match, gets the score of no pattern; without any toxic training row the
lexicon is empty; labels of unknown documents, null labels and repeated label rows (the greatest counts) do no harm; a
long text is scored whole; every row gets its own result; other columns pass through or are not read.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bankflow.llm.arrow_text import append_columns
from bankflow.session import cut_lineage

# The closed classes, in English, German, French and Spanish.
THREATS = ("kill hurt destroy burn beat shoot stab hang smash crush töten umbringen schlagen verbrennen erschießen "
           "tuer frapper brûler détruire égorger matar golpear quemar destruir apuñalar").split()
TARGETS = ("you your yours yourself u ur he she they them him her his their these those people du dich dir dein deine ihr "
           "euch sie er tu te toi ton ta tes vous votre vos ils elles lui usted ustedes ellos ellas él ella vosotros").split()
NEGATIONS = ("not no never none nobody neither nor without cannot nicht kein keine keinen keiner nie niemals ne n' pas jamais aucun aucune "
             "sans nunca jamás tampoco sin ni").split()
SPEECH = ("said says say called calls wrote writes told claims claimed quoted sagte sagt schrieb nannte dit disait écrit "
          "appelé dijo dice escribió llamó").split()

INSULT, THREAT, TARGET, NEGATION, REPORT, QUOTE, WORD, COLON, END = range(9)
REACH = 4                 # words between a mark and what it marks
STEM = (3, 8)             # lengths of learned stems
FIT_ROWS = 20_000         # rows that fit the logistic layer
MIN_TEXTS = 3             # toxic training texts that a lexicon entry is in, at least
MIN_SHARE = 0.004         # and their share of all toxic training texts
MIN_ODDS = 2.5            # least log odds of a lexicon entry
MIN_EVIDENCE = 15.0       # least log-likelihood ratio
THRESHOLD = 0.7
NEAR = 0.8                # least Jaccard similarity of the word sets of near copies
TABLES, MINHASHES = 3, 4  # tables that near copies are looked up in, and minhashes of a table's key

# Words with an English "not" in them ("isn't") and the French "n'" are words of their own; letters are those of ``WORD_BREAK`` below.
TOKEN = re.compile(r"[^\W\d_]*n['’]t(?![^\W\d_])|(?<![^\W_])n['’](?=[^\W\d_])|[^\W\d_]+|[.;:!?\n]|[\"“”„«»]")
WORD_BREAK = r"[^\p{L}\p{Nl}\p{No}]+"
# Patterns: (kind, at a target, negated, reported)
PATTERNS = [(k, t, n, r) for k in (INSULT, THREAT) for t in (0, 1) for n in (0, 1) for r in (0, 1)]
# Prior of the logistic layer: it holds where the rows to fit say nothing.
PRIOR_BIAS = -3.0
PRIOR = [(1.8 if k == INSULT else 0.6) * (1.2 if t else 1.0) * (0.7 if n else 1.0) * (0.8 if r else 1.0) for k, t, n, r in PATTERNS]
PRIOR_WEIGHT = 0.5

Step = Callable[[tuple, tuple], tuple[tuple, list[tuple]]]


def negation(state: tuple, symbol: tuple) -> tuple[tuple, list[tuple]]:
    """Mark insults and threats within reach behind a negation. State: words of reach left."""
    kind, weight, *marks = symbol
    left = state[0]
    if kind == NEGATION:
        return (REACH,), [symbol]
    if kind in (INSULT, THREAT):
        return (max(left - 1, 0),), [(kind, weight, marks[0], int(left > 0), marks[2])]
    return (0 if kind in (END, COLON) else max(left - 1, 0),), [symbol]


def reported(state: tuple, symbol: tuple) -> tuple[tuple, list[tuple]]:
    """Mark insults and threats behind a speech verb of the clause or inside quotes. State: (verb seen, quotes open); quotes stay open
    over the end of a clause, a verb over a colon."""
    kind, weight, *marks = symbol
    verb, quoted = state
    if kind in (INSULT, THREAT):
        return state, [(kind, weight, marks[0], marks[1], int(verb or quoted))]
    if kind == END:
        return (0, quoted), [symbol]
    return (int(verb or kind == REPORT), quoted ^ int(kind == QUOTE)), [symbol]


def target(state: tuple, symbol: tuple) -> tuple[tuple, list[tuple]]:
    """Mark insults and threats with a person within reach before or behind. State: (reach of the last person, what
    waits for a person, reach left to wait)."""
    kind, weight, *marks = symbol
    person, waiting, left = state
    out: list[tuple] = []
    if kind == TARGET:
        return (REACH, (), 0), [(k, w, 1, n, r) for k, w, n, r in waiting]
    if kind in (END, COLON):
        return (0, (), 0), [(k, w, 0, n, r) for k, w, n, r in waiting]
    if waiting and left == 0:
        out, waiting = [(k, w, 0, n, r) for k, w, n, r in waiting], ()
    if kind in (INSULT, THREAT):
        if person:
            out.append((kind, weight, 1, marks[1], marks[2]))
        else:
            return (0, (*waiting, (kind, weight, marks[1], marks[2])), REACH), out
    return (max(person - 1, 0), waiting, max(left - 1, 0)), out


class Machine:
    """Composition of transducers: the output of each is the input of the next. Product states get numbers and their
    moves are kept; weights are classed so that the table stays small."""

    LIMIT = 1 << 16

    def __init__(self, steps: list[Step], starts: list[tuple]):
        self.steps, self.start = steps, tuple(starts)
        self.moves: dict[tuple, tuple] = {}

    def move(self, state: tuple, symbol: tuple) -> tuple[tuple, list[tuple]]:
        known = self.moves.get((state, symbol))
        if known is None:
            stream, after = [symbol], []
            for step, inner in zip(self.steps, state):
                out: list[tuple] = []
                for s in stream:
                    inner, more = step(inner, s)
                    out += more
                after.append(inner)
                stream = out
            known = (tuple(after), [s for s in stream if s[0] in (INSULT, THREAT)])
            if len(self.moves) >= self.LIMIT:
                self.moves.clear()
            self.moves[state, symbol] = known
        return known

    def run(self, symbols: list[tuple], start: tuple | None = None) -> list[tuple]:
        """Marked insults and threats of a stream of symbols."""
        state, found = start or self.start, []
        for symbol in symbols:
            state, out = self.move(state, symbol)
            found += out
        return found + self.move(state, (END, 0, 0, 0, 0))[1]


class Grammar:
    """The composed machine behind the lexical transducer of one lexicon."""

    CACHE = 1 << 17      # words remembered by a worker; beyond it the cache starts anew
    PLAIN = (WORD, 0, 0, 0, 0)

    def __init__(self, lexicon: dict[str, float]):
        self.lexicon = lexicon
        self.closed = {**dict.fromkeys(TARGETS, TARGET), **dict.fromkeys(NEGATIONS, NEGATION),
                       **dict.fromkeys(SPEECH, REPORT), **dict.fromkeys(THREATS, THREAT), **dict.fromkeys(".;!?\n", END),
                       **dict.fromkeys("\"“”„«»", QUOTE), ":": COLON}
        self.symbols: dict[str, tuple] = {}
        self.machine = Machine([negation, reported, target], [(0,), (0, 0), (0, (), 0)])
        self.quoted = ((0,), (0, 1), (0, (), 0))         # at the begin of a clause inside quotes

    def symbol(self, word: str) -> tuple:
        """Lexical transducer: the longest stem or whole word of the lexicon decides."""
        given, word = word, word.replace("’", "'")
        if word.endswith("n't"):
            self.symbols[given] = got = (NEGATION, 0, 0, 0, 0)
            return got
        weight = self.lexicon.get(word + "$")
        for n in range(min(STEM[1], len(word)), STEM[0] - 1, -1):
            if weight is not None:
                break
            weight = self.lexicon.get(word[:n])
        if weight is not None:
            got = (INSULT, round(weight, 1), 0, 0, 0)
        else:
            kind = self.closed.get(word, WORD)
            got = self.PLAIN if kind == WORD else (kind, 1.0 if kind == THREAT else 0, 0, 0, 0)
        if len(self.symbols) >= self.CACHE:
            self.symbols.clear()
        self.symbols[given] = got
        return got

    def patterns(self, text: str | None) -> list[float]:
        """log(1 + weight) of each pattern over the clauses of a text."""
        sums = dict.fromkeys(PATTERNS, 0.0)
        known = self.symbols.get
        words = TOKEN.findall(text.lower()) if text else []
        symbols = [known(w) or self.symbol(w) for w in words]
        marked = [i for i, s in enumerate(symbols) if s[0] <= THREAT]
        done = line = quotes = 0              # quotes of the line that ``done`` lies in, up to there
        for i in marked:                      # only clauses with an insult or a threat are run
            if i < done:
                continue
            first = i
            while first > done and symbols[first - 1][0] != END:
                first -= 1
            last = i
            while last < len(symbols) and symbols[last][0] != END:
                last += 1
            for j in range(line, first):
                if symbols[j][0] == QUOTE:
                    quotes += 1
                elif words[j] == "\n":
                    quotes = 0
            line = first
            for kind, weight, at, neg, rep in self.machine.run(symbols[first:last], self.quoted if quotes % 2 else None):
                sums[kind, at, neg, rep] += weight
            done = last
        return [math.log1p(sums[p]) for p in PATTERNS]


@lru_cache(2)
def _grammar(entries: tuple[tuple[str, float], ...]) -> Grammar:
    return Grammar(dict(entries))


def training_rows(docs: DataFrame, labels: DataFrame, doc: str, text: str, label: str) -> DataFrame:
    """(id, text, toxic) of the labelled documents that may be learned from: crc32(id) mod 3 is not 1."""
    known = labels.select(F.col(doc).alias("id"), F.col(label).cast("int").alias("toxic"))
    known = known.where(F.col("id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("id")))
    known = known.groupBy("id").agg(F.max("toxic").alias("toxic"))
    rows = docs.select(F.col(doc).alias("id"), F.col(text).alias("text")).where(F.col(text).isNotNull() & ~held_out(F.col(doc)))
    # labels grow with the documents, so neither side is broadcast, at any size
    return rows.join(known.hint("merge"), "id")


def held_out(doc: Column) -> Column:
    """True where crc32 of the id as text, modulo 3, is 1; false for a null id."""
    return F.coalesce(F.crc32(doc.cast("string")) % 3 == 1, F.lit(False))


def families(rows: DataFrame) -> DataFrame:
    """(key, id, toxic, words) of the texts that count: of equal word sets the row with the least id, and no set that is verified to be a
    near copy of one that comes before it by id and key. Label and words are always those of one row.

    Sets with equal minhashes of a table are compared, word by word, with the first of them. That one may be unlike a set, so
    there are several tables; a set counts unless it is a near copy of the first one in any of them."""
    key = F.md5(F.array_join("words", " "))          # words are letters only, so the joined words are the set
    sets = rows.groupBy(key.alias("key")).agg(F.min(F.struct("id", "toxic")).alias("least"), F.first("words").alias("words"))
    least = [F.array_min(F.transform("words", lambda w, s=s: F.xxhash64(w, F.lit(s)))) for s in range(TABLES * MINHASHES)]
    buckets = F.array(*[F.xxhash64(F.lit(t), *least[t * MINHASHES:(t + 1) * MINHASHES]) for t in range(TABLES)])
    sets = cut_lineage(sets.select("key", "least.id", "least.toxic", "words", buckets.alias("buckets")), "toxic-train")
    dealt = sets.select("key", F.explode("buckets").alias("bucket"), "id")
    first = dealt.groupBy("bucket").agg(F.min(F.struct("id", "key")).alias("first"), F.count(F.lit(1)).alias("n"))
    first = cut_lineage(first.where("n > 1").select("bucket", F.col("first.key").alias("first")), "toxic-first")
    pairs = cut_lineage(dealt.join(first, "bucket").where("key <> first").select("key", "first").distinct(), "toxic-pairs")
    own = sets.select("key", "words").join(pairs, "key")
    firsts = sets.select(F.col("key").alias("first"), F.col("words").alias("first_words")).join(pairs.select("first").distinct(), "first", "left_semi")
    common, sizes = F.size(F.array_intersect("words", "first_words")), F.size("words") + F.size("first_words")
    near = own.join(firsts, "first").where(common >= NEAR * (sizes - common)).select("key").distinct()
    return sets.drop("buckets").join(cut_lineage(near, "toxic-near"), "key", "left_anti")


def learn_lexicon(rows: DataFrame) -> dict[str, float]:
    """Stems and whole words with their log odds in toxic against other texts."""
    words = F.sort_array(F.array_distinct(F.filter(F.split(F.lower("text"), WORD_BREAK), lambda w: F.length(w) >= STEM[0])))
    rows = families(rows.select("id", "toxic", words.alias("words")).where(F.size("words") > 0))
    totals = rows.agg(F.sum("toxic"), F.sum(1 - F.col("toxic"))).first()
    bad, good = int(totals[0] or 0), int(totals[1] or 0)
    if not bad:
        return {}
    words = rows.select("toxic", F.explode("words").alias("word")).groupBy("word").agg(
        F.sum("toxic").alias("t"), F.sum(1 - F.col("toxic")).alias("g"))
    # sums over words stand in for texts: a stem counts once for each different word of a text
    stems = F.transform(F.sequence(F.lit(STEM[0]), F.least(F.lit(STEM[1]), F.length("word"))),
                        lambda n: F.substring(F.col("word"), F.lit(1), n))
    counts = words.select(F.explode(F.concat(stems, F.array(F.concat("word", F.lit("$"))))).alias("entry"), "t", "g")
    counts = counts.groupBy("entry").agg(F.sum("t").alias("t"), F.sum("g").alias("g"))
    odds = F.log((F.col("t") + 0.5) / (bad + 1.0)) - F.log((F.col("g") + 0.5) / (good + 1.0))
    both, base = F.col("t") + F.col("g"), bad / (bad + good)
    evidence = 2 * (F.col("t") * F.log(F.col("t") / (both * base))
                    + F.when(F.col("g") > 0, F.col("g") * F.log(F.col("g") / (both * (1 - base)))).otherwise(0.0)) if good else F.lit(MIN_EVIDENCE)
    kept = counts.where(F.col("t") >= max(MIN_TEXTS, MIN_SHARE * bad)).select("entry", "t", "g", odds.alias("odds"), evidence.alias("ev"))
    kept = kept.where((F.col("odds") >= MIN_ODDS) & (F.col("ev") >= MIN_EVIDENCE))
    # each entry is in MIN_SHARE of the toxic texts, so there are at most their mean number of entries over that share
    table = {r["entry"]: (r["t"], r["g"], r["odds"]) for r in kept.collect()}
    # a stem gives way to a longer entry that explains nearly all of it as well or better; an entry that a stem which is left
    # covers is not needed
    for e, (toxic, good_ones, weight) in sorted(table.items(), key=lambda kv: -len(kv[0])):
        for n in range(STEM[0], len(e)):
            stem = table.get(e[:n])
            if stem and (stem[:2] == (toxic, good_ones) or toxic >= 0.9 * stem[0] and weight > stem[2]):
                del table[e[:n]]
    covered = {e for e in table if any(e[:n] in table for n in range(STEM[0], len(e)))}
    return {e: float(o) for e, (_, _, o) in sorted(table.items()) if e not in covered}


def fit(features: np.ndarray, toxic: np.ndarray) -> tuple[float, list[float]]:
    """Logistic layer by Newton steps towards the prior; weights are not negative."""
    x = np.hstack([np.ones((len(features), 1)), features])
    prior = np.array([PRIOR_BIAS, *PRIOR])
    w = prior.copy()
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (p - toxic) + PRIOR_WEIGHT * (w - prior)
        bend = (x * (p * (1 - p))[:, None]).T @ x + PRIOR_WEIGHT * np.eye(x.shape[1])
        move = np.linalg.solve(bend, slope)
        w -= np.clip(move, -1, 1)
        if np.abs(move).max() < 1e-9:
            break
    return float(w[0]), np.maximum(w[1:], 0).tolist()


def train(docs: DataFrame, labels: DataFrame, doc: str = "doc_id", text: str = "text", label: str = "toxic") -> dict:
    """The model: lexicon, bias and pattern weights. Three quarters of the training rows give the lexicon, the rest fit the
    logistic layer, so that it sees the lexicon's errors on unseen texts."""
    rows = training_rows(docs, labels, doc, text, label)
    part = F.pmod(F.xxhash64("id"), F.lit(4))
    lexicon = learn_lexicon(rows.where(part != 0))
    model = {"lexicon": tuple(sorted(lexicon.items()))}
    # a share of the rest, by a hash of the id, that is FIT_ROWS rows in the mean at most
    left = labels.select(F.col(doc).alias("id")).where(~held_out(F.col("id")) & (part == 0)).count()
    share = min(1.0, FIT_ROWS / max(left, 1))
    pick = rows.where((part == 0) & (F.pmod(F.xxhash64("id", F.lit(1)), F.lit(1_000_000)) < int(share * 1_000_000)))
    seen = patterns(pick, model, keep=["toxic"]).collect()
    model["bias"], model["weights"] = PRIOR_BIAS, PRIOR
    if seen:
        model["bias"], model["weights"] = fit(np.array([r["patterns"] for r in seen]), np.array([r["toxic"] for r in seen], float))
    return model


def patterns(df: DataFrame, model: dict, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Add ``patterns`` (array<double>, one value per entry of ``PATTERNS``)."""
    entries = model["lexicon"]

    def fn(batch: pa.RecordBatch) -> list[pa.Array]:
        grammar = _grammar(entries)
        rows = [grammar.patterns(t) for t in batch.column(batch.schema.get_field_index(text)).to_pylist()]
        return [pa.array(rows, pa.list_(pa.float64()))]

    return append_columns(df, text, "patterns array<double>", fn, keep=keep)


def score(df: DataFrame, model: dict, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Add ``score`` (0 to 1) and ``predicted`` (1 from ``THRESHOLD`` on)."""
    weights = F.array(*[F.lit(float(w)) for w in model["weights"]])
    logit = F.aggregate(F.zip_with("patterns", weights, lambda x, w: x * w), F.lit(float(model["bias"])), lambda a, x: a + x)
    out = patterns(df, model, text, keep).withColumn("score", 1.0 / (1.0 + F.exp(-logit))).drop("patterns")
    return out.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
