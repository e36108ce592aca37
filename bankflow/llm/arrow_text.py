"""Arrow batches of text as numpy buffers, shared by the vectorised operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

# Texts are processed in runs of about this many bytes, whatever Spark's batch size is; one longer text is a run
# of its own. It bounds the working memory of a task, not what is processed.
RUN_BYTES = 2 << 20


def utf8_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A string or binary column as (bytes, offsets); nulls are empty."""
    arr = column.cast(pa.large_binary())
    if arr.null_count:
        arr = arr.fill_null(b"")
    offsets = np.frombuffer(arr.buffers()[1], np.int64)[arr.offset:arr.offset + len(arr) + 1]
    raw = arr.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.empty(0, np.uint8)
    if not len(arr):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def runs(batches: Iterator[pa.RecordBatch], column: str, run_bytes: int = RUN_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with about ``run_bytes`` of text each; order and rows are kept."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, offsets = utf8_buffer(batch.column(batch.schema.get_field_index(column)))
        first = 0
        while first < batch.num_rows:
            end = int(np.searchsorted(offsets, offsets[first] + run_bytes, side="right")) - 1
            end = min(max(end, first + 1), batch.num_rows)
            yield batch.slice(first, end - first)
            first = end


def packed(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    """``values`` cut into one little-endian binary cell per row, ``counts`` values each."""
    if values.nbytes >= 2 ** 31:
        raise ValueError("one run of texts encodes to over 2 GiB; Spark cells cannot hold it")
    ends = np.concatenate([[0], np.cumsum(counts)]) * values.itemsize
    little = np.ascontiguousarray(values, values.dtype.newbyteorder("<"))
    return pa.Array.from_buffers(pa.binary(), len(counts),
                                 [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(little)])


def gather(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Concatenate ``flat[s:s + n]`` for every (s, n), without a Python loop."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    at = np.repeat(starts - (ends - lengths), lengths) + np.arange(total)
    return flat[at]


def append_columns(df: DataFrame, text: str, added: str, fn: Callable[[pa.RecordBatch], list[pa.Array]],
                   keep: list[str] | None = None, run_bytes: int = RUN_BYTES) -> DataFrame:
    """Map ``df`` run by run: ``fn`` gets a batch and returns the arrays of the ``added`` columns (a DDL string).

    Kept columns come first; a kept column that has the name of an added one is replaced by it.
    """
    from pyspark.sql.types import StructType

    new = StructType.fromDDL(added)
    names = {f.name.lower() for f in new}
    kept = [c for c in (keep if keep is not None else df.columns) if c.lower() not in names]
    source = df.select(*dict.fromkeys([*kept, text]))
    schema = StructType([f for f in df.select(*kept).schema] + list(new))

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in runs(batches, text, run_bytes):
            columns = [run.column(run.schema.get_field_index(c)) for c in kept]
            yield pa.RecordBatch.from_arrays(columns + fn(run), names=[*kept, *(f.name for f in new)])

    return source.mapInArrow(mapped, schema)
