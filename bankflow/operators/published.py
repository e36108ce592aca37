"""Tables whose changes appear at once: Parquet folders listed by published versions.

A table's rows lie in folders (segments) that are never changed once written. A version says which segments are live; it is one small log
file, written last, so a writer that dies leaves folders that nobody reads, and a reader, who lists the segments of
one version when it plans, never sees half of a change. What a change must remember with its rows (the loads it has taken, the batch of
a stream, a snapshot's time) stands in the same log file.

A log file holds what its version adds and drops; every ``FULL`` versions one holds the whole state, and older files are
deleted, as are segments that have been dead for ``KEEP`` versions, so neither grows with the number of versions. The
driver holds a few numbers per segment. One writer at a time: a second one that publishes the same version is refused.

Layout: ``<root>/log/<version>.json`` and ``<root>/<kind>/c=<id>/[<partition>=<value>/]*.parquet``.

Segments can be kept in levels (``compact``): when ``FAN`` segments of a kind stand on one level, they are merged into one of the next, so
their number grows with the logarithm of the changes and a row is rewritten as many times at most. A keyed kind
has the columns ``step`` (the version that wrote the row) and ``bucket`` (a partition, by a hash of the key); of a key's rows the one of the
latest step counts.
"""

from __future__ import annotations

import json
import math
import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from bankflow.session import drop_path, list_names, move_new, read_text, write_text

FULL = 16      # versions after which the log holds the whole state again
KEEP = 16      # versions for which a dead segment stays, for readers that still use it
FAN = 8        # segments of one level that are merged
SMALL = 1000   # rows of a segment up to which it begins on the lowest level
BUCKET_ROWS = 1 << 17      # rows of a bucket, up to 2**MOST_BUCKETS buckets
MOST_BUCKETS = 14


@dataclass
class State:
    """A version: live segments (path below the root -> what is known of it), dead ones (path -> version of death), and facts by name."""

    version: int = 0
    segments: dict[str, dict] = field(default_factory=dict)
    dead: dict[str, int] = field(default_factory=dict)
    info: dict = field(default_factory=dict)

    def of(self, kind: str) -> dict[str, dict]:
        return {path: about for path, about in self.segments.items() if path.startswith(f"{kind}/")}

    def batch_done(self, stream: str, batch: int) -> bool:
        """Whether a micro-batch of a stream is in this version; other streams' batches do not count."""
        return self.info.get("streams", {}).get(stream, -1) >= batch


class Published:
    """The table at ``root``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root

    # ------------------------------------------------------------------ versions
    def _log(self, version: int) -> str:
        return f"{self.root}/log/{version:012d}.json"

    def versions(self) -> list[int]:
        return sorted(int(n[:-5]) for n in list_names(self.spark, f"{self.root}/log") if n.endswith(".json"))

    def state(self, version: int | None = None) -> State:
        """The latest version, or an earlier one that is still in the log."""
        have = [v for v in self.versions() if version is None or v <= version]
        if version is not None and version not in have:
            raise ValueError(f"version {version} is not in the log of {self.root}")
        entries = []
        for v in reversed(have):
            entries.append(json.loads(read_text(self.spark, self._log(v))))
            if entries[-1].get("full"):
                break
        state = State()
        for e in reversed(entries):
            if e.get("full"):
                state = State(e["version"], e["added"], e["dead"], e["info"])
                continue
            for path in e["dropped"]:
                state.segments.pop(path, None)
                state.dead[path] = e["version"]
            state.segments.update(e["added"])
            self._learn(state.info, e["info"])
            state.version = e["version"]
        return state

    @staticmethod
    def _learn(info: dict, news: dict) -> None:
        for name, value in news.items():
            if isinstance(value, dict):
                info[name] = {**info.get(name, {}), **value}
            elif isinstance(value, list):
                known = set(info.get(name, []))
                info[name] = info.get(name, []) + [v for v in value if v not in known]
            else:
                info[name] = value

    def publish(self, before: State, added: dict[str, dict] | None = None, dropped: list[str] | None = None, **info) -> State:
        """The version after ``before``. A dict in ``info`` updates the one known, a list is added to it, other values replace."""
        added, dropped, version = added or {}, [p for p in dropped or [] if p not in (added or {})], before.version + 1
        after = State(version, {p: a for p, a in {**before.segments, **added}.items() if p not in dropped},
                      {**before.dead, **dict.fromkeys(dropped, version)}, dict(before.info))
        self._learn(after.info, info)
        if version % FULL == 0 or version == 1:
            gone = [p for p, died in after.dead.items() if died <= version - KEEP]
            after.dead = {p: died for p, died in after.dead.items() if p not in gone}
            entry = {"version": version, "full": True, "added": after.segments, "dead": after.dead, "info": after.info}
        else:
            gone, entry = [], {"version": version, "added": added, "dropped": dropped, "info": info}
        draft = f"{self.root}/log/.{uuid.uuid4().hex}"
        write_text(self.spark, draft, json.dumps(entry))
        move_new(self.spark, draft, self._log(version))
        for path in gone:
            drop_path(self.spark, f"{self.root}/{path}")
        if version % FULL == 0:
            for v in self.versions():
                if v < version - FULL:
                    drop_path(self.spark, self._log(v))
        return after

    def drop_unpublished(self) -> list[str]:
        """Delete what writers that died have left: folders that no version in the log knows. Not while another writer is at work."""
        state = self.state()
        known = {"/".join(p.split("/")[:2]) for p in (*state.segments, *state.dead)}
        found = [f"{kind}/{c}" for kind in list_names(self.spark, self.root) if kind != "log"
                 for c in list_names(self.spark, f"{self.root}/{kind}") if c.startswith("c=")]
        left = [p for p in found if p not in known]
        for path in left:
            drop_path(self.spark, f"{self.root}/{path}")
        return left

    # ------------------------------------------------------------------ segments
    def write(self, df: DataFrame, kind: str, partition_by: list[str] | None = None, bloom: str | None = None, rows: int = 0, **about) -> dict[str, dict]:
        """Store ``rows`` rows in a new folder; it becomes live with the version that adds it. ``about``: plain values for the log."""
        path = f"{kind}/c={uuid.uuid4().hex}"
        writer = df.write.mode("overwrite")
        if bloom:
            writer = writer.option(f"parquet.bloom.filter.enabled#{bloom}", "true")
        (writer.partitionBy(*partition_by) if partition_by else writer).parquet(f"{self.root}/{path}")
        return {path: {"level": level_of(rows), "rows": rows, **about}}

    def read(self, state: State, kind: str, schema: str, segments: list[str] | None = None) -> DataFrame | None:
        """Live rows of a kind (or of some of its segments); None if there are none. ``schema`` includes its partition columns."""
        paths = sorted(state.of(kind)) if segments is None else sorted(segments)
        if not paths:
            return None
        found = self.spark.read.schema(f"{schema}, c string").option("basePath", f"{self.root}/{kind}")
        return found.parquet(*[f"{self.root}/{p}" for p in paths]).drop("c")

    def compact(self, state: State, kind: str, schema: str, store=None) -> State:
        """Merge the segments of each level that has ``FAN`` of them. ``store`` writes the merged rows (default: all of them, as they are)
        and gets their number (at most) and level."""
        store = store or (lambda found, rows, level: self.write(found, kind, rows=rows, level=level))
        while True:
            levels: dict[int, list[str]] = {}
            for path, about in state.of(kind).items():
                levels.setdefault(about["level"], []).append(path)
            full = [n for n, paths in sorted(levels.items()) if len(paths) >= FAN]
            if not full:
                return state
            paths = levels[full[0]]
            merged = store(self.read(state, kind, schema, paths), sum(state.segments[p]["rows"] for p in paths), full[0] + 1)
            steps = [state.segments[p].get("step") for p in paths]
            if None not in steps:
                merged = {p: {**about, "step": max(steps)} for p, about in merged.items()}
            state = self.publish(state, merged, paths)


def level_of(rows: int) -> int:
    """Level at which a segment of so many rows begins: segments of similar size meet there."""
    return max(0, math.floor(math.log(max(rows, 1) / SMALL, FAN)))


# ------------------------------------------------------------------ keyed kinds
def buckets_for(rows: int) -> int:
    """Buckets of a segment with so many rows: a power of two, so that a key's bucket among fewer follows from that among more."""
    return 1 << min(max(math.ceil(math.log2(max(rows, 1) / BUCKET_ROWS)), 0), MOST_BUCKETS)


def bucket_of(key: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key.cast("string")), F.lit(buckets)).cast("int")


def latest_step(rows: DataFrame, key: str) -> DataFrame:
    """Of each key the row of the latest step."""
    w = Window.partitionBy(key).orderBy(F.col("step").desc())
    return rows.withColumn("nth_step", F.row_number().over(w)).where("nth_step = 1").drop("nth_step")


class Keyed:
    """A keyed kind of a published table: rows with one ``key`` each, replaced by later ones. Each segment has buckets by its size, so
    it is cut finer when small ones are merged into a large one."""

    def __init__(self, table: Published, kind: str, key: str, schema: str):
        self.table, self.kind, self.key = table, kind, key
        self.schema = f"{schema}, step bigint, bucket int"

    def _store(self, found: DataFrame, rows: int, **about) -> dict[str, dict]:
        n = buckets_for(rows)
        found = found.withColumn("bucket", bucket_of(F.col(self.key), n)).repartition("bucket").sortWithinPartitions("bucket", self.key)
        return self.table.write(found, self.kind, ["bucket"], self.key, rows=rows, buckets=n, **about)

    def write(self, state: State, found: DataFrame, rows: int) -> dict[str, dict]:
        """A segment with ``rows`` rows (unique on the key) that are newer than all stored ones."""
        step = state.version + 1
        return self._store(found.withColumn("step", F.lit(step).cast("bigint")), rows, step=step)

    def buckets_of(self, state: State, found: DataFrame) -> list[int]:
        """Buckets of some rows' keys in the finest segment: at most as many numbers as it has buckets."""
        n = max((s["buckets"] for s in state.of(self.kind).values()), default=1)
        return [0] if n == 1 else sorted(r[0] for r in found.select(bucket_of(F.col(self.key), n)).distinct().collect())

    def read(self, state: State, buckets: list[int] | None = None, since: int = 0) -> DataFrame:
        """The current rows, of all keys or of those in some buckets of the finest segment (others' files are not opened). ``since``:
        only rows that a later version wrote; segments that hold none are not opened."""
        sizes: dict[int, list[str]] = {}
        for path, about in state.of(self.kind).items():
            if about.get("step", since + 1) > since:
                sizes.setdefault(about["buckets"], []).append(path)
        stored = None
        for n, paths in sorted(sizes.items()):
            part = self.table.read(state, self.kind, self.schema, paths)
            if buckets is not None and len(wanted := sorted({b % n for b in buckets})) < n:
                part = part.where(F.col("bucket").isin(wanted))
            if since:
                part = part.where(F.col("step") > since)
            stored = part if stored is None else stored.unionByName(part)
        if stored is None:
            return self.table.spark.createDataFrame([], self.schema).drop("step", "bucket")
        if sum(map(len, sizes.values())) > 1:
            stored = latest_step(stored, self.key)
        return stored.drop("step", "bucket")

    def compact(self, state: State) -> State:
        return self.table.compact(state, self.kind, self.schema, lambda found, rows, level: self._store(latest_step(found, self.key), rows, level=level))
