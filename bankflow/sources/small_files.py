"""Many small Parquet files in a folder that all executors mount.

Where Hadoop's native library is missing, its local file system starts a ``chmod`` process for each file it creates and
another for the file's checksums: some 10 ms of a core a file, however few rows it has; opening one takes Spark another
2 ms. Here the tasks create and open the files themselves. Other stores have no such cost; ``mounted`` is None for
them, and Spark writes and reads there.

``write`` commits as Spark's committer does: each attempt of a task writes into a folder of its own under
``_flush-<id>``, which readers pass over; when all rows are written, the files of the attempts that Spark took are
moved into place, by tasks that may be run again.
"""

from __future__ import annotations

import glob
import os
import re
import struct
import uuid
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bankflow.session import drop_path, write_text

NO_VALUE = "__HIVE_DEFAULT_PARTITION__"
ESCAPED = re.compile(r"""[\x01-\x1f"#%'*/:=?\\\x7f{\[\]^]""")      # in names of partitions, as Spark has it
NOT_IN_URI = re.compile(r"""[\x00-\x20"#%<>?\[\\\]^`{|}\x7f]""")
CODECS = {"uncompressed": "none", "lz4_raw": "lz4"}               # those that have another name here
SUMMED = 512             # bytes of a checksum
LISTED = 10_000          # names of a batch
MOST_ROWS = 500          # of a file that is small: a task holds the rows of one


def mounted(spark: SparkSession, path: str) -> str | None:
    """The path as any process sees it, if it is in a mounted file system."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    uri = at.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(at).toUri()
    return uri.getPath() if uri.getScheme() == "file" else None


def _percent(m: re.Match) -> str:
    return f"%{ord(m[0]):02X}"


def _folder(partitions: list[str], values: tuple) -> str:
    return "/".join(f"{c}={ESCAPED.sub(_percent, v) if v else NO_VALUE}" for c, v in zip(partitions, values, strict=True))


def _value(name: str) -> str | None:
    """The value that a partition folder stands for."""
    text = name.partition("=")[2]
    return None if text == NO_VALUE else re.sub("%([0-9a-fA-F]{2})", lambda m: chr(int(m[1], 16)), text)


def _stretches(batch: pa.RecordBatch, columns: list[str]) -> Iterator[tuple[int, int]]:
    """Start and end of each stretch of rows that are alike in these columns."""
    ends = sorted({end for c in columns for end in pc.run_end_encode(batch.column(c)).run_ends.to_pylist()})
    return zip([0, *ends], ends, strict=False)


def _sums(name: str) -> str:
    return f".{name}.crc"


def _checksums(data: pa.Buffer) -> bytes:
    """The checksum file that Hadoop keeps beside a local file, by which it knows a damaged one."""
    view = memoryview(data)
    sums = [zlib.crc32(view[i:i + SUMMED]) for i in range(0, len(view), SUMMED)]
    return struct.pack(f">4si{len(sums)}I", b"crc\0", SUMMED, *sums)


def _writer(partitions: list[str], most: int, staged: str, footer: dict[str, str], codec: str) -> Callable:
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        attempt, task, files = uuid.uuid4().hex, TaskContext.get().partitionId(), 0
        own, folder, at, held = f"{staged}/{attempt}", "", None, None       # held: rows of the partition at hand that fill no file yet

        def put(rows: pa.Table) -> None:
            nonlocal files
            plain, out = [f.name for f in rows.schema if not pa.types.is_nested(f.type)], pa.BufferOutputStream()
            with pq.ParquetWriter(out, rows.schema, compression=CODECS.get(codec, codec), write_statistics=plain, write_page_checksum=True,
                                  store_schema=False) as file:
                file.add_key_value_metadata(footer)
                file.write_table(rows)
            name, data = f"part-{task:05d}-{attempt}.c{files:03d}.{codec}.parquet", out.getvalue()
            with open(f"{folder}/{_sums(name)}", "xb") as f:
                f.write(_checksums(data))
            with open(f"{folder}/{name}", "xb") as f:
                f.write(data)
            files += 1

        for batch in batches:
            rows = batch.drop_columns(partitions)
            for start, end in _stretches(batch, partitions) if batch.num_rows else ():
                values = tuple(batch.column(c)[start].as_py() for c in partitions)
                if values != at:
                    if held:
                        put(held)
                    at, held, folder = values, None, f"{own}/{_folder(partitions, values)}"
                    os.makedirs(folder, exist_ok=True)
                held = pa.Table.from_batches([*(held.to_batches() if held else []), rows.slice(start, end - start)]).combine_chunks()
                full = held.num_rows // most * most
                for i in range(0, full, most):
                    put(held.slice(i, most))
                held = held.slice(full)
        if held:
            put(held)
        if files:
            yield pa.RecordBatch.from_pydict({"folder": [own]})

    return write


def _failed(error: OSError) -> None:
    raise error


def _mover(base: str) -> Callable:
    def move(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for own in batch.column("folder").to_pylist():
                for folder, _, names in os.walk(own, onerror=_failed):      # a folder that is not here is an error
                    to = f"{base}/{os.path.relpath(folder, own)}"
                    if names:
                        os.makedirs(to, exist_ok=True)
                    for name in sorted(names):          # checksums, whose names begin with a point, before the files
                        try:
                            os.rename(f"{folder}/{name}", f"{to}/{name}")
                        except FileNotFoundError:
                            if not os.path.exists(f"{to}/{name}"):          # else moved by another attempt
                                raise
            yield batch

    return move


def write(rows: DataFrame, partitions: list[str], most: int, base: str) -> None:
    """Add the rows under the mounted folder ``base``, partitioned as Spark does it, in files of at most ``most`` (``MOST_ROWS`` or fewer) rows."""
    spark = rows.sparkSession
    staged, codec = f"{base}/_flush-{uuid.uuid4().hex[:12]}", spark.conf.get("spark.sql.parquet.compression.codec").lower()
    kept = T.StructType([T.StructField(f.name, f.dataType) for f in rows.schema if f.name not in partitions])
    footer = {"org.apache.spark.version": spark.version, "org.apache.spark.sql.parquet.row.metadata": kept.json()}
    named = rows.select(*[F.col(c).cast("string") for c in partitions], *kept.names)      # values as folders spell them
    try:
        taken = named.sortWithinPartitions(*partitions).mapInArrow(_writer(partitions, most, staged, footer, codec), "folder string").collect()
        if taken:                     # a row for each task
            spark.createDataFrame(taken, "folder string").mapInArrow(_mover(base), "folder string").collect()
    finally:
        drop_path(spark, f"file://{staged}")
    write_text(spark, f"file://{base}/_SUCCESS", "")


def _hidden(name: str) -> bool:
    return name.startswith(".") or (name.startswith("_") and "=" not in name) or name.endswith("._COPYING_")


def _list(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for value, folder in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            with os.scandir(folder) as found:
                paths = [f"{folder}/{e.name}" for e in found if not _hidden(e.name)]
            for i in range(0, len(paths), LISTED):
                part = paths[i:i + LISTED]
                yield pa.RecordBatch.from_pydict({"value": pa.array([value] * len(part), pa.string()), "path": pa.array(part, pa.string())})


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [pq.read_metadata(path).num_rows for path in batch.column("path").to_pylist()]
        files = [f"file:{NOT_IN_URI.sub(_percent, path)}" for path in batch.column("path").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("value"), pa.array(files, pa.string()), pa.array(rows, pa.int64())], ["value", "file", "rows"])


def row_counts(spark: SparkSession, base: str, pattern: str) -> DataFrame:
    """(value, file, rows) of the files with rows in the folders under ``base`` that match ``pattern``, from their footers; ``value`` is that
    of the first partition. The names are listed where the files are counted, not by the driver."""
    found = sorted(glob.glob(f"{glob.escape(base)}/{pattern}"))
    folders = spark.createDataFrame([(_value(os.path.relpath(f, base).split("/")[0]), f) for f in found], "value string, path string")
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))         # by number: by their bytes all names would go to one task
    paths = folders.mapInArrow(_list, "value string, path string").repartition(tasks, "path")
    return paths.mapInArrow(_count, "value string, file string, rows bigint").where("rows > 0")
