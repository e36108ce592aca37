"""Quality rules: repetition coverage (operator 5).

Words are runs of characters other than ASCII white space. For several n, the hash of each n-word window is rolled
forward in numpy from the word ids of a whole run of texts; windows with an equal hash are confirmed word by word; each character of
a word inside a window that occurs twice or more counts once per n. Lines are compared whole.

The verdict: a text fails if, for some n, the share of its word characters inside duplicated n-word windows is over that n's
limit, or the share of characters inside lines equal to an earlier one is over the line limit. The limits are the
usual published ones for web text, widened for windows of few words.

Defined cases: a null text has no words and fails the base rule, as an empty one does; a long text is measured whole;
every row gets its own result; an empty table gives an empty table; extra columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from bankflow.llm.arrow_text import append_columns, utf8_buffer

# Largest share of word characters inside duplicated windows of n words, and inside repeated lines.
WINDOW_LIMITS = {5: 0.30, 6: 0.28, 8: 0.26, 10: 0.24}
LINE_LIMIT = 0.30
BASE_WINDOW = 8
SYMBOLS = b"#*$%&|<>"
ROLL = np.uint64(0x9E3779B97F4A7C15)   # odd multiplier of the rolling hash

ADDED = ("n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
         "dup_line_chars bigint, " + ", ".join(f"dup_{n}gram_chars bigint" for n in WINDOW_LIMITS)
         + ", base_failed boolean, kept boolean")


def mix(values: np.ndarray) -> np.ndarray:
    """Spread ids over 64 bits."""
    x = (values.astype(np.uint64) + np.uint64(1)) * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(31)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(29))


def rolling(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of each window of ``n`` words, from the difference of two running sums modulo 2**64."""
    size = len(hashes)
    if size < n:
        return np.empty(0, np.uint64)
    power = np.cumprod(np.full(size + 1, ROLL), dtype=np.uint64)
    sums = np.concatenate([[np.uint64(0)], np.cumsum(hashes * power[:size], dtype=np.uint64)])
    return (sums[n:] - sums[:-n]) * power[size - np.arange(size - n + 1) - 1]


def duplicated(ids: np.ndarray, text_of: np.ndarray, hashes: np.ndarray, n: int) -> np.ndarray:
    """Mask of the words inside windows of ``n`` words that occur twice or more in their text."""
    covered = np.zeros(len(ids) + 1, np.int64)
    keys = rolling(hashes, n)
    if not len(keys):
        return covered[:0].astype(bool) if not len(ids) else np.zeros(len(ids), bool)
    start = np.flatnonzero(text_of[:len(keys)] == text_of[n - 1:])
    keys = keys[start] ^ mix(text_of[start])
    order = np.argsort(keys, kind="stable")
    keys, start = keys[order], start[order]
    same = np.flatnonzero(keys[1:] == keys[:-1])
    if len(same):
        a, b = start[same], start[same + 1]
        equal = text_of[a] == text_of[b]
        for k in range(n):
            equal &= ids[a + k] == ids[b + k]
        hit = np.concatenate([a[equal], b[equal]])
        np.add.at(covered, hit, 1)
        np.add.at(covered, hit + n, -1)
    return np.cumsum(covered[:-1]) > 0


def measure(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """All measures of a run of texts given as UTF-8 bytes and offsets."""
    texts = len(offsets) - 1
    white = (data == 0x20) | ((data >= 0x09) & (data <= 0x0D))
    inside = ~white
    begins = inside.copy()
    begins[1:] &= white[:-1]
    edges = offsets[:-1][np.diff(offsets) > 0]
    begins[edges] = inside[edges]
    ends = inside.copy()
    ends[:-1] &= white[1:]
    ends[offsets[1:][np.diff(offsets) > 0] - 1] = inside[offsets[1:][np.diff(offsets) > 0] - 1]
    first, last = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    raw = data.tobytes()
    seen: dict[bytes, int] = {}
    ids = np.fromiter((seen.setdefault(raw[a:b], len(seen)) for a, b in zip(first.tolist(), last.tolist())),
                      np.int64, len(first))
    text_of = np.searchsorted(offsets, first, side="right") - 1
    lead = (data & 0xC0) != 0x80                        # one per code point
    chars = np.concatenate([[0], np.cumsum(lead)])
    size = chars[last] - chars[first]

    def per_text(at: np.ndarray, weights: np.ndarray | None = None) -> np.ndarray:
        return np.bincount(at, weights, minlength=texts).astype(np.int64)[:texts]

    symbol = np.concatenate([[0], np.cumsum(np.isin(data, np.frombuffer(SYMBOLS, np.uint8)))])
    out = {"n_words": per_text(text_of), "word_chars": per_text(text_of, size),
           "n_symbols": symbol[offsets[1:]] - symbol[offsets[:-1]]}
    hashes = mix(ids)
    for n in {BASE_WINDOW, *WINDOW_LIMITS}:
        mask = duplicated(ids, text_of, hashes, n)
        out[f"dup_{n}gram_chars"] = per_text(text_of[mask], size[mask])
        if n == BASE_WINDOW:
            out["n_repeat_words"] = per_text(text_of[mask])
    dup, dup_chars = np.zeros(texts, np.int64), np.zeros(texts, np.int64)
    breaks = np.flatnonzero(data == 0x0A)
    cuts = np.searchsorted(breaks, offsets)
    for i in range(texts):
        at = breaks[cuts[i]:cuts[i + 1]]
        if not len(at):
            continue
        lines: set[bytes] = set()
        a = int(offsets[i])
        for b in (*at.tolist(), int(offsets[i + 1])):
            line = raw[a:b]
            if line in lines:
                dup[i] += 1
                dup_chars[i] += int(chars[b] - chars[a])
            elif line.strip(b" \t\n\x0b\x0c\r"):
                lines.add(line)
            a = b + 1
    out["n_dup_lines"], out["dup_line_chars"] = dup, dup_chars
    out["n_chars"] = chars[offsets[1:]] - chars[offsets[:-1]]
    words, total = out["n_words"], np.maximum(out["word_chars"], 1)
    out["base_failed"] = (words < 20) | (100 * out["n_repeat_words"] > 30 * words)
    bad = out["dup_line_chars"] > LINE_LIMIT * np.maximum(out["n_chars"], 1)
    for n, limit in WINDOW_LIMITS.items():
        bad |= out[f"dup_{n}gram_chars"] > limit * total
    out["kept"] = ~out["base_failed"] & ~bad
    return out


def repetition(df: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Add the measures and the verdict (``ADDED``) to each row."""
    names = [c.split()[0] for c in ADDED.split(", ")]

    def fn(batch: pa.RecordBatch) -> list[pa.Array]:
        got = measure(*utf8_buffer(batch.column(batch.schema.get_field_index(text))))
        return [pa.array(got[c]) for c in names]

    return append_columns(df, text, ADDED, fn, keep=keep)
