"""Language identification by cross-parsing entropy (operator 10).

Per language, a suffix automaton of a sample of labelled text knows every substring of it. A text is parsed from left to
right into the longest phrases that the automaton knows; c phrases over n characters against a sample of N characters
estimate the cross entropy c * log2(N) / n, and the language with the least one wins. Texts are case-folded and
everything but letters becomes one space.

All parses of a run of texts advance together in numpy: texts are cut into lanes, and one look-up per character and
language gives the next state and whether a phrase ended.

The sample of a language: up to ``SAMPLE_TEXTS`` training texts, whole ones, those of at most ``SAMPLE_TEXT_CHARS``
characters first and in the order of a hash, and of them ``SAMPLE_CHARS`` characters. Everything else covers all texts.

Defined cases: a null text or one without letters is "und" with score 0; ties go to the alphabetically first language; without any
training row all texts are "und"; a long text is parsed whole; every row gets its own result; other columns are not read.
"""

from __future__ import annotations

import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bankflow.llm.arrow_text import append_columns, utf8_buffer

UNKNOWN = "und"
SAMPLE_TEXTS = 64
SAMPLE_TEXT_CHARS = 4000
SAMPLE_CHARS = 24_000
LANE = 512


@lru_cache(1)
def fold_table() -> np.ndarray:
    """Lower case of each letter, 0 for any other code point."""
    table = np.zeros(0x110000, np.uint32)
    for code in range(0x110000):
        char = chr(code)
        if unicodedata.category(char)[0] == "L":
            low = char.lower()
            table[code] = ord(low) if len(low) == 1 else code
    return table


def fold(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """UTF-8 texts as folded code points with single spaces for what is no letter, their offsets and letters."""
    at = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))
    codes = fold_table()[np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)]
    starts = np.searchsorted(at, offsets)
    first = np.zeros(len(codes) + 1, bool)
    first[starts] = True
    space = codes == 0
    keep = ~space
    keep[1:] |= space[1:] & ~space[:-1] & ~first[1:-1]
    upto = np.concatenate([[0], np.cumsum(keep)])
    letters = np.concatenate([[0], np.cumsum(~space)])
    folded = codes[keep]
    folded[folded == 0] = ord(" ")
    return folded, upto[starts], np.diff(letters[starts])


TRIES = 64     # places of a row that are looked at together


def interleave(rows: list[tuple[int, list[int], list[int]]], states: int, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sparse rows (state, symbols, targets) laid into one another, so that memory follows the moves and not states x symbols: the move of a
    state by a symbol is at ``base[state] + symbol`` if that place is owned by the state. Moves are targets times 4.

    Rows of several moves are placed first, largest first, each at the next base at which all its places are free; rows of one
    move then take the places that are left."""
    total = sum(len(symbols) for _, symbols, _ in rows)
    base = np.zeros(states, np.int32)
    owner, move = np.full(2 * total + 2 * width + TRIES, -1, np.int32), np.zeros(2 * total + 2 * width + TRIES, np.int32)
    tries, at = np.arange(TRIES)[:, None], 0
    for state, symbols, targets in sorted((r for r in rows if len(r[1]) > 1), key=lambda r: -len(r[1])):
        places = np.array(symbols)
        while True:
            if at + TRIES + width > len(owner):
                owner, move = np.append(owner, np.full(len(owner), -1, np.int32)), np.append(move, np.zeros(len(move), np.int32))
            fits = (owner[at + tries + places] < 0).all(axis=1)
            if fits.any():
                break
            at += TRIES
        base[state] = at + int(fits.argmax())
        owner[base[state] + places], move[base[state] + places] = state, np.array(targets) * 4
    single = [r for r in rows if len(r[1]) == 1]
    if single:
        state, symbol, target = (np.array(c) for c in zip(*((s, symbols[0], targets[0]) for s, symbols, targets in single)))
        free = np.flatnonzero(owner < 0)
        free = free[free >= width]                       # no base is negative
        if len(free) < len(state):
            more = len(state) - len(free)
            free = np.append(free, len(owner) + np.arange(more))
            owner, move = np.append(owner, np.full(more, -1, np.int32)), np.append(move, np.zeros(more, np.int32))
        place = free[:len(state)]
        base[state], owner[place], move[place] = place - symbol, state, target * 4
    used = int(np.flatnonzero(owner >= 0).max(initial=0)) + 1
    used = max(used, int(base.max(initial=0)) + width)
    pad = max(used - len(owner), 0)
    return base, np.append(owner, np.full(pad, -1, np.int32))[:used], np.append(move, np.zeros(pad, np.int32))[:used]


class Automaton:
    """Suffix automaton of one string (code points), as interleaved rows of moves for cross-parsing."""

    def __init__(self, text: np.ndarray):
        links, lengths, moves = [-1], [0], [{}]
        last = 0
        for c in text.tolist():
            here = len(lengths)
            lengths.append(lengths[last] + 1)
            links.append(0)
            moves.append({})
            p = last
            while p >= 0 and c not in moves[p]:
                moves[p][c] = here
                p = links[p]
            if p >= 0:
                q = moves[p][c]
                if lengths[p] + 1 == lengths[q]:
                    links[here] = q
                else:
                    twin = len(lengths)
                    lengths.append(lengths[p] + 1)
                    links.append(links[q])
                    moves.append(dict(moves[q]))
                    while p >= 0 and moves[p].get(c) == q:
                        moves[p][c] = twin
                        p = links[p]
                    links[q] = links[here] = twin
            last = here
        self.symbols = np.unique(text)
        width = len(self.symbols) + 1                    # the last symbol: characters that the sample has not
        index = {c: i for i, c in enumerate(self.symbols.tolist())}
        # after a miss the phrase ends and the character opens the next one; an unknown one is a phrase by itself
        self.opened = np.ones(width, np.int32)
        self.opened[:-1] = [moves[0][c] * 4 for c in self.symbols.tolist()]
        rows = [(state, [index[c] for c in row], list(row.values())) for state, row in enumerate(moves) if state and row]
        self.base, self.owner, self.move = interleave(rows, len(moves), width)
        self.bits = float(np.log2(max(len(text), 2)))

    def phrases(self, lanes: np.ndarray, active: np.ndarray) -> np.ndarray:
        """Phrases in each lane. ``lanes``: (LANE, lanes) code points, longest lanes first; ``active``: lanes with a
        character in each row."""
        place = np.searchsorted(self.symbols, lanes)
        place[place == len(self.symbols)] = 0
        symbol = np.where(self.symbols[place] == lanes, place, len(self.symbols)).astype(np.int32)
        opened = self.opened[symbol]
        state, count = np.zeros(lanes.shape[1], np.int32), np.zeros(lanes.shape[1], np.int32)
        for t, n in enumerate(active.tolist()):
            if not n:
                break
            now = state[:n]
            at = self.base[now] + symbol[t, :n]
            move = np.where(self.owner[at] == now, self.move[at], opened[t, :n] + (now > 0))
            count[:n] += move & 3
            state[:n] = move >> 2
        return count + (state > 0)


class Model:
    """Automata of all languages."""

    def __init__(self, samples: tuple[tuple[str, str], ...]):
        self.languages = [lang for lang, _ in samples]
        self.automata = []
        for _, text in samples:
            raw = np.frombuffer(text.encode("utf-8"), np.uint8)
            self.automata.append(Automaton(fold(raw, np.array([0, len(raw)]))[0]))

    def rates(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bits per character of each text (texts, languages), and the letters of each text."""
        folded, at, letters = fold(data, offsets)
        size = np.diff(at)
        pieces = -(-size // LANE)
        text_of = np.repeat(np.arange(len(size)), pieces)
        nth = np.arange(len(text_of)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        start = at[:-1][text_of] + nth * LANE
        length = np.minimum(at[1:][text_of] - start, LANE)
        order = np.argsort(-length, kind="stable")
        start, length, text_of = start[order], length[order], text_of[order]
        out = np.zeros((len(size), len(self.automata)))
        if len(start):
            rows = np.arange(LANE)[:, None]
            lanes = folded[np.minimum(start[None, :] + rows, len(folded) - 1)]
            active = np.searchsorted(-length, -np.arange(LANE), side="left")
            for i, automaton in enumerate(self.automata):
                found = np.bincount(text_of, automaton.phrases(lanes, active), minlength=len(size))
                out[:, i] = found * automaton.bits / np.maximum(size, 1)
        return out, letters


@lru_cache(2)
def _model(samples: tuple[tuple[str, str], ...]) -> Model:
    return Model(samples)


def held_out(doc: Column) -> Column:
    """True where crc32 of the id as text, modulo 5, is 0; false for a null id."""
    return F.coalesce(F.crc32(doc.cast("string")) % 5 == 0, F.lit(False))


def learn(docs: DataFrame, doc: str = "doc_id", text: str = "text", lang: str = "lang") -> tuple[tuple[str, str], ...]:
    """(language, sample) of every language that a training row names, in alphabetical order.

    The sampled rows are the least in each of ``SAMPLE_TEXTS`` hash buckets of a language, so counts combine on the map side and
    the driver gets at most that many keys and short texts per language."""
    rows = docs.where(F.col(lang).isNotNull() & ~held_out(F.col(doc)) & F.rlike(F.col(text), F.lit(r"\p{L}")))
    spread = F.xxhash64(doc, text)
    long_last = F.shiftleft((F.length(text) > SAMPLE_TEXT_CHARS).cast("bigint"), 62)
    rows = rows.select(F.col(lang).alias("lang"), F.col(text).alias("text"), F.pmod(spread, F.lit(SAMPLE_TEXTS)).alias("bucket"),
                       (long_last + F.shiftrightunsigned(spread, 2)).alias("order"))
    best = rows.groupBy("lang", "bucket").agg(F.min("order").alias("order"))
    keys = [r["order"] for r in best.collect()]           # at most SAMPLE_TEXTS per language
    if not keys:
        return ()
    picked = rows.where(F.col("order").isin(keys)).select(
        "lang", "order", F.substring("text", 1, SAMPLE_CHARS).alias("text")).dropDuplicates(["lang", "order"])
    samples: dict[str, str] = {}
    for r in sorted(picked.collect(), key=lambda r: (r["lang"], r["order"])):
        have = samples.get(r["lang"], "")
        if len(have) < SAMPLE_CHARS and r["text"] not in have:
            samples[r["lang"]] = have + r["text"] + "\n"
    return tuple((lang, s[:SAMPLE_CHARS]) for lang, s in sorted(samples.items()))


def predict(df: DataFrame, samples: tuple[tuple[str, str], ...], text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Add ``lang_pred`` and ``score``, one less the best rate over the second best."""
    def fn(batch: pa.RecordBatch) -> list[pa.Array]:
        data, offsets = utf8_buffer(batch.column(batch.schema.get_field_index(text)))
        if not samples:
            n = batch.num_rows
            return [pa.array([UNKNOWN] * n), pa.array(np.zeros(n))]
        model = _model(samples)
        rates, letters = model.rates(data, offsets)
        best = rates.argmin(axis=1)
        low = np.sort(rates, axis=1)
        first = low[:, 0]
        second = low[:, 1] if low.shape[1] > 1 else np.full(len(first), np.inf)
        with np.errstate(invalid="ignore", divide="ignore"):
            sure = np.where(np.isinf(second), 1.0, (second - first) / np.maximum(second, 1e-12))
        none = letters == 0
        langs = np.array([*model.languages, UNKNOWN], object)[np.where(none, len(model.languages), best)]
        return [pa.array(langs.tolist(), pa.string()), pa.array(np.clip(np.where(none, 0.0, sure), 0, 1))]

    return append_columns(df, text, "lang_pred string, score double", fn, keep=keep)
