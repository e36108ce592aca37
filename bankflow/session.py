"""Session defaults and shared work folders.

Everything that must outlive a task (snapshot versions, landing files, raw
tables, streaming checkpoints, lineage cuts) lives under the cluster's
``spark.checkpoint.dir``, a folder every executor can reach. A private folder
is chosen only for a ``local`` master that names none (tests); elsewhere that
is an error, since no machine's own folder reaches the other executors.
"""

from __future__ import annotations

import functools
import tempfile
import threading
import uuid

from pyspark.sql import DataFrame, SparkSession

# Session settings every job relies on. Timestamps are zone-less end to end, so
# the session zone only matters for display; it is pinned for reproducibility.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
    # Row images are stored whole, not field by field: they are moved from store to store far more often than flattened,
    # and taking them apart and putting them together again cost more than all of that.
    "spark.sql.variant.inferShreddingSchema": "false",
}


def get_spark(master: str = "local[*]", shuffle_partitions: int = 8, app: str = "bankflow",
              extra: dict | None = None) -> SparkSession:
    builder = (SparkSession.builder.master(master).appName(app)
               .config("spark.ui.enabled", "false")
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", "8g")
               .config("spark.ui.showConsoleProgress", "false"))
    for key, value in {**SESSION_DEFAULTS, **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_defaults(spark)
    return spark


def apply_defaults(spark: SparkSession) -> None:
    """Set the runtime SQL settings the operators assume (idempotent)."""
    for key, value in SESSION_DEFAULTS.items():
        spark.conf.set(key, value)
    checkpoint_root(spark)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``; a private one only on one machine."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="bankflow-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def work_dir(spark: SparkSession, name: str = "run") -> str:
    """A fresh folder for one run's tables, under the shared checkpoint root."""
    path = f"{checkpoint_root(spark)}/bankflow/{name}-{uuid.uuid4().hex[:12]}"
    if (passing := getattr(_passing, "folders", None)) is not None:
        passing.append(path)
    return path


_passing = threading.local()


def drops_own_work(step):
    """Decorator of a step, a function of (spark, ...), that stores its results under a path it is given: the work folders made
    while it runs are deleted when it ends, also by an error, so that a stream does not fill the shared folder batch by batch.
    What the step returns must not read them."""
    @functools.wraps(step)
    def run(spark: SparkSession, *args, **kwargs):
        outer, mine = getattr(_passing, "folders", None), []
        _passing.folders = mine
        try:
            return step(spark, *args, **kwargs)
        finally:
            _passing.folders = outer
            drop_work(spark, *mine)

    return run


def drop_work(spark: SparkSession, *paths: str) -> None:
    """Delete finished work folders (of a run whose results are stored elsewhere)."""
    for path in paths:
        if f"{checkpoint_root(spark)}/bankflow/" not in path:
            raise ValueError(f"not a work folder: {path}")
        drop_path(spark, path)


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a file or folder if it is there."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there; any other trouble than its absence is raised."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def _path(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if it is not there."""
    at, fs = _path(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(at)] if fs.exists(at) else []


def read_text(spark: SparkSession, path: str) -> str:
    """A small text file, read by the driver."""
    at, fs = _path(spark, path)
    stream = fs.open(at)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small text file, written by the driver."""
    at, fs = _path(spark, path)
    stream = fs.create(at, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def move_new(spark: SparkSession, path: str, to: str) -> None:
    """Rename a file to a name that is not taken."""
    (at, fs), (target, _) = _path(spark, path), _path(spark, to)
    if fs.exists(target) or not fs.rename(at, target):
        raise FileExistsError(to)


def cut_lineage(df: DataFrame, name: str = "cut") -> DataFrame:
    """Materialise ``df`` as a Parquet table in the shared checkpoint folder and read it back.

    One job writes it (an eager ``checkpoint()`` computes the plan twice unless
    cached); the re-read keeps column pruning and filter pushdown, and the files
    survive executor loss.
    """
    spark = df.sparkSession
    path = work_dir(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
