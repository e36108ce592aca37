"""Document fingerprints by I-Match (operator 13).

Terms are runs of letters and digits, ASCII capitals lowered. The lexicon holds the terms whose inverse document frequency lies in a band:
in at least ``least`` documents and in at most a share ``most`` of them, counted over all documents. A text's
fingerprint holds ``SUBSETS`` hashes, each of its sorted distinct terms that lie in one randomised subset of the lexicon; a
subset without a term of the text has the hash 0.

One subset for all lengths would be either empty for short texts or upset by any edit of long ones. So the subsets are nested: subset j
at level r holds the terms whose j-th draw is below 2**(64 - r), and a text of m distinct terms takes r = floor(log2 m), at which one or two of
its terms are expected in each. The fingerprint holds levels r and r + 1, so that texts of similar size always share a level. The likeness of
two fingerprints is the share of equal hashes among the subsets of the shared level that have a term in either; it is 0 if
they share no level. A text without a term of the lexicon in its subsets is known by the hash of all its terms, one without
terms by that of its bytes.

Only the terms that a subset draws (about ``2 * SUBSETS`` a text, whatever its length) are looked up in the lexicon, by a
shuffled join; the lexicon is never collected. Terms enter as 64-bit hashes.

Defined cases: a null text is empty; a long text is taken whole, its words in blocks of ``WORDS_AT_ONCE``; equal texts have equal
fingerprints and likeness 1; rows with equal ids are ordered by the hash of their texts, null ids come first; an empty table gives an empty
table; of other columns those in ``keep`` pass through, unless they have the name of a result column.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from bankflow.llm.arrow_text import append_columns, runs, utf8_buffer
from bankflow.llm.rank_index import RankIndex, code_points
from bankflow.session import cut_lineage

SUBSETS = 16
LEAST, MOST = 2, 0.05            # documents with a term of the lexicon: at least so many, at most this share
WORDS_AT_ONCE = 1 << 18
SHORT = 48                       # bytes of a word up to which it is hashed with all others at once
FNV_START, FNV_PRIME = np.uint64(0xCBF29CE484222325), np.uint64(0x100000001B3)
ALL = np.uint64(0xFFFFFFFFFFFFFFFF)
POSITION = np.uint64(0x9E3779B97F4A7C15)
SHIFTS = np.cumsum(np.full(SUBSETS, POSITION), dtype=np.uint64)      # of the terms' hashes, one per subset

SEPARATOR = np.ones(256, bool)   # bytes between words: ASCII but letters and digits
SEPARATOR[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """Spread hashes over 64 bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(data: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """64-bit hash of each word ``data[first:last]``, capitals lowered: byte by byte for all short words at once (FNV-1a), long ones each."""
    length = last - first
    order = np.argsort(-np.minimum(length, SHORT + 1), kind="stable")
    start, size = first[order], length[order]
    long = int(np.searchsorted(-size, -SHORT, side="left"))            # the longest stand first
    h = np.full(len(first), FNV_START, np.uint64)
    for k in range(int(size[long]) if long < len(size) else 0):
        end = int(np.searchsorted(-size, -k, side="left"))
        h[long:end] = (h[long:end] ^ LOWER[data[start[long:end] + k]]) * FNV_PRIME
    for i in range(long):
        h[i] = xxhash.xxh3_64_intdigest(LOWER[data[start[i]:start[i] + size[i]]].tobytes())
    out = np.empty_like(h)
    out[order] = mix(h)
    return out


def text_terms(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text, hash) of the distinct terms of each text, sorted by both."""
    inside = ~SEPARATOR[data]
    edges = offsets[:-1][np.diff(offsets) > 0]
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    begins[edges] = inside[edges]
    ends[:-1] &= ~inside[1:]
    stops = offsets[1:][np.diff(offsets) > 0] - 1
    ends[stops] = inside[stops]
    first, last = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    texts, hashes = [], []
    for i in range(0, len(first), WORDS_AT_ONCE):
        a, b = first[i:i + WORDS_AT_ONCE], last[i:i + WORDS_AT_ONCE]
        of, h = _distinct(np.searchsorted(offsets, a, side="right") - 1, word_hashes(data, a, b))
        texts.append(of)
        hashes.append(h)
    if len(texts) == 1:
        return texts[0], hashes[0]
    if not texts:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    return _distinct(np.concatenate(texts), np.concatenate(hashes))


def _distinct(of: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((h, of))
    of, h = of[order], h[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (of[1:] != of[:-1])
    return of[new], h[new]


def draw(h: np.ndarray, j: int) -> np.ndarray:
    """The j-th draw of each term."""
    return mix(h + SHIFTS[j])


def sequence_hashes(of: np.ndarray, h: np.ndarray, texts: int) -> np.ndarray:
    """Hash of the sequence of terms of each text (0 for none); terms are sorted by text."""
    count = np.bincount(of, minlength=texts)
    place = np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count)
    sums = np.zeros(texts, np.uint64)
    np.add.at(sums, of, mix(h + (place.astype(np.uint64) + np.uint64(1)) * POSITION))
    return np.where(count > 0, mix(sums + count.astype(np.uint64)) | np.uint64(1), np.uint64(0))


def levels(of: np.ndarray, texts: int) -> np.ndarray:
    """Level of each text by its number of distinct terms."""
    count = np.bincount(of, minlength=texts)
    return np.floor(np.log2(np.maximum(count, 1))).astype(np.int64)


def drawn(of: np.ndarray, h: np.ndarray, level: np.ndarray) -> np.ndarray:
    """Mask of the terms that some subset at their text's level holds."""
    most, found = ALL >> level[of].astype(np.uint64), np.zeros(len(h), bool)
    for j in range(SUBSETS):
        found |= draw(h, j) <= most
    return found


def whole_hashes(data: np.ndarray, offsets: np.ndarray, of: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Hash of all distinct terms of each text, or of its bytes if it has none."""
    out = sequence_hashes(of, h, len(offsets) - 1)
    for i in np.flatnonzero(out == 0).tolist():
        out[i] = xxhash.xxh3_64_intdigest(data[offsets[i]:offsets[i + 1]].tobytes())
    return out


# ------------------------------------------------------------------ the lexicon
def lexicon(df: DataFrame, text: str = "text", least: int = LEAST, most: float = MOST) -> DataFrame:
    """Terms of the band (``term``, a signed hash, and ``documents``), counted over all rows with a text."""
    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in runs(batches, text):
            data, offsets = utf8_buffer(run.column(0))
            term, n = np.unique(text_terms(data, offsets)[1], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(term.view(np.int64)), pa.array(n)], names=["term", "n"])

    found = df.select(text).mapInArrow(counts, "term bigint, n bigint").groupBy("term").agg(F.sum("n").alias("documents"))
    total = df.select(F.count(text)).first()[0]
    return found.where((F.col("documents") >= least) & (F.col("documents") <= max(most * total, least)))


# ------------------------------------------------------------------ texts in the order of their ids
ADDED = ["n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
TERMS = "array<struct<term: bigint, sides: tinyint>>"
SIDES = ("level int, whole bigint, edited_level int, edited_whole bigint, terms " + TERMS)


def measured(texts: list[bytes], others: list[bytes | None]) -> list[pa.Array]:
    """n_chars, edited_sha256 and ``SIDES`` of texts and of their edited versions; None for the next text: not known here."""
    data = np.frombuffer(b"".join(texts), np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    n = code_points(data, offsets)
    index, first = RankIndex(data, offsets), np.cumsum(n) - n
    cut = index.offset(first + n - n // 4) - offsets[:-1]
    edited, known = [], []
    for text, other, at, want in zip(texts, others, cut.tolist(), (n // 4).tolist()):
        known.append(other is not None)
        edited.append(text[:at] + first_code_points(other or b"", want))
    both = data, offsets
    changed = np.frombuffer(b"".join(edited), np.uint8), np.concatenate([[0], np.cumsum([len(t) for t in edited])]).astype(np.int64)
    sides = []
    for d, o in (both, changed):
        of, h = text_terms(d, o)
        level = levels(of, len(texts))
        whole, mask = whole_hashes(d, o, of, h), drawn(of, h, level)
        sides.append((of[mask], h[mask], level, whole))
    of, h = (np.concatenate([s[i] for s in sides]) for i in (0, 1))
    side = np.repeat(np.array([1, 2], np.int8), [len(s[0]) for s in sides])
    order = np.lexsort((side, h, of))
    of, h, side = of[order], h[order], side[order]
    twin = np.zeros(len(h), bool)
    twin[1:] = (h[1:] == h[:-1]) & (of[1:] == of[:-1])            # the edited text has this term, too
    side[:-1][twin[1:]] = 3
    of, h, side = of[~twin], h[~twin], side[~twin]
    bounds = np.concatenate([[0], np.cumsum(np.bincount(of, minlength=len(texts)))]).astype(np.int32)
    terms = pa.ListArray.from_arrays(pa.array(bounds), pa.StructArray.from_arrays([pa.array(h.view(np.int64)), pa.array(side)], names=["term", "sides"]))
    return [pa.array(n), pa.array([hashlib.sha256(e).hexdigest() if k else None for e, k in zip(edited, known)], pa.string()),
            pa.array(sides[0][2], pa.int32()), pa.array(sides[0][3].view(np.int64)), pa.array(sides[1][2], pa.int32()),
            pa.array(sides[1][3].view(np.int64)), terms]


def first_code_points(text: bytes, count: int) -> bytes:
    """The first ``count`` code points of a text, or all."""
    for head in (text[:4 * count + 4], text):                # a code point has four bytes at most, in UTF-8
        lead = (np.frombuffer(head, np.uint8) & 0xC0) != 0x80
        lead[:1] = True
        at = np.flatnonzero(lead)
        if len(at) > count:
            return text[:int(at[count])]
    return text


def _texts(column: pa.Array) -> list[bytes]:
    return [t or b"" for t in column.cast(pa.binary()).to_pylist()]


OWN = "n_chars bigint, edited_sha256 string, " + SIDES


def with_next(df: DataFrame, keep: list[str]) -> DataFrame:
    """Rows (``key``, ``text`` and ``keep``) measured with their successors in ascending order of the key (after the last: the first).
    ``row`` numbers them in that order, ``next_row`` is the successor's number.

    Rows are range-partitioned and streamed in order; a task knows all successors but that of its last row. That row and
    the first one of each partition hand on their texts, and these few (one pair a partition) are measured apart."""
    out = StructType([*df.select(*keep).schema, *StructType.fromDDL(f"row bigint, next_row bigint, part int, {OWN}, head string, tail string")])
    order = [F.col("key").asc_nulls_first(), F.xxhash64("text")]
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order, "text").select(*keep, "text")

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        begin = row = part << 33

        def done(run: pa.RecordBatch, after: bytes | None) -> pa.RecordBatch:
            texts = _texts(run.column("text"))
            size = len(texts)
            head, tail = [None] * size, [None] * size
            if row == begin:
                head[0] = texts[0]
            if after is None:
                tail[-1] = texts[-1]
            numbers = np.arange(row, row + size)
            columns = [*[run.column(c) for c in keep], pa.array(numbers), pa.array(numbers + 1), pa.array([part] * size, pa.int32()),
                       *measured(texts, [*texts[1:], after]), *[pa.array(e, pa.binary()).view(pa.string()) for e in (head, tail)]]
            return pa.RecordBatch.from_arrays(columns, names=out.names)

        held = None
        for run in runs(batches, "text"):
            if held is not None:
                yield done(held, _texts(run.column("text").slice(0, 1))[0])
                row += held.num_rows
            held = run
        if held is not None:
            yield done(held, None)

    stored = cut_lineage(ranged.mapInArrow(measure, out), "imatch-ordered")
    parts = stored.where("head is not null").select("part")                         # a row per partition
    first = F.min("part").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    following = parts.select("part", F.coalesce(F.lead("part").over(Window.orderBy("part")), first).alias("next_part"))
    heads = stored.where("head is not null").select(F.col("part").alias("next_part"), "head")
    lasts = stored.where("tail is not null").select(*keep, "row", "part", "tail").join(following, "part").join(heads, "next_part")

    def pair(batch: pa.RecordBatch) -> list[pa.Array]:
        return measured(*[_texts(batch.column(batch.schema.get_field_index(c))) for c in ("tail", "head")])

    lasts = lasts.withColumn("next_row", F.shiftleft(F.col("next_part").cast("bigint"), 33))
    mended = append_columns(lasts, "tail", OWN, pair, keep=[*keep, "row", "next_row", "tail", "head"])
    columns = [*keep, "row", "next_row", *[f.name for f in StructType.fromDDL(OWN)]]
    return stored.where("tail is null").select(*columns).unionByName(mended.select(*columns))


# ------------------------------------------------------------------ fingerprints
def signatures(of: np.ndarray, h: np.ndarray, level: np.ndarray) -> np.ndarray:
    """32-bit hashes of the subsets at a level given per text: an array of texts x ``SUBSETS``. Terms are sorted by text and hash."""
    out, most = np.zeros((len(level), SUBSETS), np.uint32), ALL >> np.minimum(level, 63).astype(np.uint64)
    for j in range(SUBSETS):
        inside = draw(h, j) <= most[of]
        out[:, j] = (sequence_hashes(of[inside], h[inside], len(level)) >> np.uint64(32)).astype(np.uint32)
    return out


WHOLE = 255      # in place of a level: the hash of all terms follows


def fingerprints(of: np.ndarray, h: np.ndarray, level: np.ndarray, whole: np.ndarray) -> list[bytes]:
    """The level and the hashes at the level and the one above; or ``WHOLE`` and the hash of all terms."""
    own, above = signatures(of, h, level), signatures(of, h, level + 1)
    some, wide = own.any(axis=1).tolist(), np.concatenate([own, above], axis=1).astype(">u4")
    return [bytes([r]) + row.tobytes() if s else bytes([WHOLE]) + w.to_bytes(8) for r, row, s, w in zip(level.tolist(), wide, some, whole.tolist())]


def as_text(print_: bytes) -> str:
    """``level-hashes-hashes`` or ``all-hash`` in hexadecimal."""
    if print_[0] == WHOLE:
        return f"all-{print_[1:].hex()}"
    half = 1 + 4 * SUBSETS
    return f"{print_[0]:02d}-{print_[1:half].hex()}-{print_[half:].hex()}"


def likeness(one: bytes, other: bytes) -> float:
    """Share of equal hashes at the higher of two levels among the subsets that are not empty in both."""
    if one == other:
        return 1.0
    if WHOLE in (one[0], other[0]) or abs(one[0] - other[0]) > 1:
        return 0.0
    level = max(one[0], other[0])
    a, b = (np.frombuffer(p, np.uint32, SUBSETS, 1 + 4 * SUBSETS * (level - p[0])) for p in (one, other))
    some = (a | b) != 0
    return float(np.count_nonzero((a == b) & some) / np.count_nonzero(some)) if some.any() else 0.0


def _side(terms: pa.ListArray, bit: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, hash) of one side's terms, sorted."""
    flat = terms.flatten()
    of = np.repeat(np.arange(len(terms)), terms.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64))
    h, side = flat.field(0).to_numpy().view(np.uint64), flat.field(1).to_numpy()
    mine = (side & bit) > 0
    return _distinct(of[mine], h[mine])


def edited_fingerprints(df: DataFrame, key: str = "doc_id", text: str = "text", least: int = LEAST, most: float = MOST,
                        keep: list[str] | None = None) -> DataFrame:
    """Fingerprints of every text and of its edited version, whose last quarter of code points is replaced by as many first ones of the
    next text in ascending order of ``key``. Adds ``ADDED``; ``keep`` names the columns that stay (default: the key)."""
    kept = [c for c in (keep if keep is not None else [key]) if c.lower() not in ADDED]
    names = [f"kept_{i}" for i in range(len(kept))]                   # whatever the kept columns are called
    source = df.select(F.col(key).alias("key"), F.col(text).alias("text"), *[F.col(c).alias(n) for c, n in zip(kept, names)])
    rows = with_next(source, names)
    looked_up = rows.select("row", F.explode("terms").alias("t")).select("row", "t.term", "t.sides")
    found = looked_up.join(lexicon(source, "text", least, most).select("term"), "term")
    found = found.groupBy("row").agg(F.collect_list(F.struct("term", "sides")).alias("found"))
    found = rows.drop("terms").join(found, "row", "left").withColumn("found", F.coalesce("found", F.array().cast(TERMS)))

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            num = lambda name, t: b.column(name).to_numpy(zero_copy_only=False).astype(np.int64).view(t)
            mine = fingerprints(*_side(b.column("found"), 1), num("level", np.int64), num("whole", np.uint64))
            edit = fingerprints(*_side(b.column("found"), 2), num("edited_level", np.int64), num("edited_whole", np.uint64))
            near = [likeness(x, y) for x, y in zip(mine, edit)]
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in (*names, "next_row", "n_chars", "edited_sha256", "row")], pa.array(mine, pa.binary()),
                                              pa.array(edit, pa.binary()), pa.array(near, pa.float64())], names=signed.names)

    signed = StructType([*df.select(*[F.col(c).alias(n) for c, n in zip(kept, names)]).schema, *StructType.fromDDL(
        "next_row bigint, n_chars bigint, edited_sha256 string, row bigint, print binary, edited_print binary, near_edited double")])
    prints = cut_lineage(found.mapInArrow(sign, signed), "imatch-prints")
    following = prints.select(F.col("row").alias("next_row"), F.col("print").alias("next_print"))
    last = prints.drop("row").join(following, "next_row").select(*names, "n_chars", "edited_sha256", "print", "edited_print", "near_edited", "next_print")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            mine, edit, after = (b.column(c).to_pylist() for c in ("print", "edited_print", "next_print"))
            columns = [*[b.column(c) for c in (*names, "n_chars", "edited_sha256")], pa.array(map(as_text, mine), pa.string()), pa.array(map(as_text, edit), pa.string()),
                       b.column("near_edited"), pa.array([likeness(x, y) for x, y in zip(mine, after)], pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, *ADDED])

    shape = StructType([*signed[:len(names)], *StructType.fromDDL("n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
                                                                  "near_edited double, near_next double")])
    return last.mapInArrow(write, shape).select(*[F.col(n).alias(c) for n, c in zip(names, kept)], *ADDED)
