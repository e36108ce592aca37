"""Fill-in-the-middle transformation (operator 12).

A text is cut at two code point ranks that follow from its id, and its parts are written with marks before them: prefix, suffix, middle (psm)
or suffix, prefix, middle (spm). Texts are UTF-8, so a cut is a byte offset: a learned rank index (``rank_index``) is fitted to
the boundary offsets of a run of texts, predicts the offset of every cut and corrects it by the stored residual; the
parts are slices of the bytes and are never decoded. ``restore`` rebuilds the text from the output and its form.

Which form a text takes follows from its id too: ``plain_percent`` of the texts stay as they are, ``spm_percent`` of the others are spm.

Defined cases: a null text is empty, and an empty text is plain, as is one that holds a mark of its own (it could not be taken apart
again); a null id counts as the word ``null``; a text of one code point is cut before or behind it; repeated rows each
get the same result; an empty table gives an empty table; other columns pass through, one with the name of a result column is replaced
by it. A text is held whole, with about two times its size besides it.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bankflow.llm.arrow_text import append_columns, utf8_buffer
from bankflow.llm.rank_index import RankIndex, code_points

# Fixed marks of the parts.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
MARK = re.compile(b"<[PSM]>")
ADDED = "n bigint, form string, prefix_chars bigint, middle_chars bigint, output string"


def draws(key: object, seed: int) -> tuple[int, int, int, int]:
    """Four numbers below 2**32 that follow from an id."""
    text = hashlib.sha256(f"{seed}:{'null' if key is None else key}".encode()).hexdigest()
    return tuple(int(text[i:i + 8], 16) for i in (0, 8, 16, 24))


def marked(data: bytes, offsets: np.ndarray) -> np.ndarray:
    """Texts of a run that hold a mark."""
    found = np.zeros(len(offsets) - 1, bool)
    at = np.array([m.start() for m in MARK.finditer(data)], np.int64)
    of = np.searchsorted(offsets, at, side="right") - 1
    found[of[at + len(PREFIX) <= offsets[of + 1]]] = True
    return found


def transform(data: np.ndarray, offsets: np.ndarray, keys: list, seed: int, plain_percent: int, spm_percent: int) -> list[pa.Array]:
    """The ``ADDED`` columns of a run of texts."""
    raw, n = data.tobytes(), code_points(data, offsets)
    own = marked(raw, offsets)
    h = np.array([draws(k, seed) for k in keys], np.int64).reshape(-1, 4)
    cuts = np.sort(h[:, :2] % (n + 1)[:, None], axis=1)
    plain = (n == 0) | own | (h[:, 2] % 100 >= 100 - plain_percent)
    spm = h[:, 3] % 100 < spm_percent
    index = RankIndex(data, offsets)
    first = np.cumsum(n) - n                                  # rank at which a text begins
    one, two = index.offset(first + cuts[:, 0]), index.offset(first + cuts[:, 1])
    p, s, m = PREFIX.encode(), SUFFIX.encode(), MIDDLE.encode()
    out = []
    for begin, a, b, end, is_plain, is_spm in zip(*(x.tolist() for x in (offsets[:-1], one, two, offsets[1:], plain, spm))):
        if is_plain:
            out.append(raw[begin:end])
        elif is_spm:
            out.append(b"".join((s, raw[b:end], p, raw[begin:a], m, raw[a:b])))
        else:
            out.append(b"".join((p, raw[begin:a], s, raw[b:end], m, raw[a:b])))
    return [pa.array(n), pa.array(np.where(plain, "plain", np.where(spm, "spm", "psm")), pa.string()),
            pa.array(cuts[:, 0], mask=plain), pa.array(cuts[:, 1] - cuts[:, 0], mask=plain),
            pa.array(out, pa.binary()).view(pa.string())]


def fill_in_middle(df: DataFrame, key: str = "doc_id", text: str = "text", seed: int = 1, plain_percent: int = 10,
                   spm_percent: int = 20, keep: list[str] | None = None) -> DataFrame:
    """Add to each row the ``ADDED`` columns; ``keep`` names the columns that stay (default: all)."""
    kept = keep if keep is not None else df.columns
    hidden = "fim_key"
    while hidden in df.columns:
        hidden += "_"

    def fn(batch: pa.RecordBatch) -> list[pa.Array]:
        keys = batch.column(batch.schema.get_field_index(hidden)).to_pylist()
        return transform(*utf8_buffer(batch.column(batch.schema.get_field_index(text))), keys, seed, plain_percent, spm_percent)

    rows = df.withColumn(hidden, F.col(key).cast("string"))
    return append_columns(rows, text, ADDED, fn, keep=[*kept, hidden]).drop(hidden)


def restore(output: Column, form: Column) -> Column:
    """The text that ``output`` was made from. Only the three marks of a psm or spm output split it."""
    parts = F.split(output, "<[PSM]>", 4)
    part = lambda i: F.get(parts, F.lit(i))
    return (F.when(form == "psm", F.concat(part(1), part(3), part(2)))
            .when(form == "spm", F.concat(part(2), part(3), part(1))).otherwise(output))
