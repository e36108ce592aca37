"""WARC archives with segmented records (operator 4).

``write`` makes one response or revisit record per page, its payload under chunked transfer framing; blocks over
``SEGMENT_BYTES`` are cut into a first record and continuation records. ``read`` parses the archives, puts segments together
by origin identifier in the order of their numbers, verifies the total length, undoes the chunked framing and verifies the
payload digest.

Archives are gzip files that Spark writes and reads (a record ends with two line ends, which is the writer's separator), of at
most ``FILE_RECORDS`` records, so that a task holds one file of bounded size. Only segmented blocks are shuffled, by origin.

Defined cases: a null html is an empty payload; a null url leaves out the target field; equal payloads of at least
``REVISIT_BYTES`` are stored once, in the record of the largest page id, and pages without an id refer to it too (if no page of
the group has an id, all are responses); rows repeated with the largest id are each a response; a record that lacks a
segment, has another total length or a damaged frame is returned with ``complete`` false and no payload; an empty table
gives an empty result; other columns are not archived.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CHUNK_BYTES = 4096
SEGMENT_BYTES = 16 << 10
REVISIT_BYTES = 1000
FILE_RECORDS = 4000
BATCH_BYTES = 4 << 20
LINE_END = "\r\n"

RECORD = ("warc_type string, record_id string, page_id bigint, url string, refers_to bigint, digest string, origin_id string, "
          "segment int, total_length bigint, block binary")


def _fields(pairs: list[tuple[str, object]]) -> bytes:
    lines = ["WARC/1.1", *(f"{k}: {v}" for k, v in pairs if v is not None), "", ""]
    return LINE_END.join(lines).encode()


def chunked(payload: bytes, size: int = CHUNK_BYTES) -> bytes:
    """Chunked transfer framing."""
    parts = []
    for at in range(0, len(payload), size):
        part = payload[at:at + size]
        parts += [b"%x\r\n" % len(part), part, b"\r\n"]
    return b"".join([*parts, b"0\r\n\r\n"])


def unchunked(body: bytes) -> bytes | None:
    """Payload of a chunked body; None if the framing is damaged."""
    parts, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        head = body[at:end].split(b";")[0].strip() if end >= 0 else b""
        if not re.fullmatch(rb"[0-9A-Fa-f]+", head):
            return None
        size, at = int(head, 16), end + 2
        if size == 0:                                    # trailer fields, if any, end with an empty line
            return b"".join(parts) if body[at:].endswith(b"\r\n") else None
        if body[at + size:at + size + 2] != b"\r\n":
            return None
        parts.append(body[at:at + size])
        at += size + 2


def record_id(archive: str, row: int, segment: int = 1) -> str:
    """Id of a record: it follows from the archive's own random id, so records of different archives never share one."""
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.md5(f'{archive}-{row}-{segment}'.encode()).digest())}>"


def page_records(archive: str, row: int, page_id: int | None, url: str | None, payload: bytes, refers_to: int | None,
                 revisit: bool) -> list[bytes]:
    """The records of one page, each without the two line ends behind it."""
    name = record_id(archive, row)
    digest = "sha1:" + base64.b32encode(hashlib.sha1(payload).digest()).decode()
    clean = url if url is None else re.sub(r"[\r\n]", " ", url)
    common = [("WARC-Date", "2024-01-01T00:00:00Z"), ("WARC-Target-URI", clean), ("Page-Id", page_id),
              ("WARC-Payload-Digest", digest), ("Content-Type", "application/http; msgtype=response")]
    if revisit:
        block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
        profile = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
        return [_fields([("WARC-Type", "revisit"), ("WARC-Record-ID", name), *common, ("WARC-Profile", profile),
                         ("Refers-To-Page-Id", refers_to), ("Content-Length", len(block))]) + block]
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n" + chunked(payload)
    cuts = [block[at:at + SEGMENT_BYTES] for at in range(0, len(block), SEGMENT_BYTES)]
    out = [_fields([("WARC-Type", "response"), ("WARC-Record-ID", name), *common,
                    ("WARC-Segment-Number", 1 if len(cuts) > 1 else None), ("Content-Length", len(cuts[0]))]) + cuts[0]]
    for n, cut in enumerate(cuts[1:], 2):
        out.append(_fields([("WARC-Type", "continuation"), ("WARC-Record-ID", record_id(archive, row, n)), ("WARC-Date", "2024-01-01T00:00:00Z"),
                            ("WARC-Segment-Origin-ID", name), ("WARC-Segment-Number", n),
                            ("WARC-Segment-Total-Length", len(block) if n == len(cuts) else None),
                            ("Content-Length", len(cut))]) + cut)
    return out


def write(pages: DataFrame, folder: str, page: str = "page_id", url: str = "url", html: str = "html") -> None:
    """Archive every page under ``folder``."""
    archive_id = uuid.uuid4().hex
    payload = F.encode(F.coalesce(F.col(html), F.lit("")), "UTF-8")
    rows = pages.select(F.col(page).cast("bigint").alias("page_id"), F.col(url).alias("url"), payload.alias("payload"))
    rows = rows.withColumn("sha", F.sha1("payload"))
    large = rows.where(F.octet_length("payload") >= REVISIT_BYTES)
    kept = large.groupBy("sha").agg(F.max("page_id").alias("kept"), F.count(F.lit(1)).alias("copies")).where("copies > 1 and kept is not null")
    rows = rows.join(kept.select("sha", "kept"), "sha", "left")
    revisit = F.col("kept").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("kept"))
    rows = rows.select("page_id", "url", "payload", "kept", revisit.alias("revisit")).withColumn("row", F.monotonically_increasing_id())

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            columns = [batch.column(batch.schema.get_field_index(c)) for c in ("row", "page_id", "url", "payload", "kept", "revisit")]
            for i in range(batch.num_rows):
                row, page_id, link, body, keep, again = (c[i].as_py() for c in columns)
                for record in page_records(archive_id, row, page_id, link, body, keep, again):
                    held.append(record)
                    size += len(record)
                if size >= BATCH_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array(held, pa.binary())], names=["record"])
                    held, size = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(held, pa.binary())], names=["record"])

    archive = rows.mapInArrow(records, "record binary").select(F.col("record").cast("string").alias("value"))
    (archive.write.mode("overwrite").option("lineSep", LINE_END * 2).option("compression", "gzip")
     .option("maxRecordsPerFile", FILE_RECORDS).text(folder))


def parse(data: bytes) -> Iterator[dict]:
    """Records of one archive file, plain or gzip (of any number of members), one after the other."""
    buffer, rest = bytearray(), data
    packed = data[:2] == b"\x1f\x8b"
    inflate = zlib.decompressobj(31) if packed else None

    def more() -> bool:
        nonlocal rest, inflate
        if not packed:
            buffer.extend(rest)
            had, rest = bool(rest), b""
            return had
        while rest:
            out = inflate.decompress(rest, 1 << 20)
            rest = inflate.unconsumed_tail
            if inflate.eof:
                rest, inflate = inflate.unused_data, zlib.decompressobj(31)
            if out:
                buffer.extend(out)
                return True
        return False

    while True:
        while (end := buffer.find(b"\r\n\r\n")) < 0:
            if not more():
                if buffer.strip():
                    raise ValueError("the archive ends inside a record's fields")
                return
        lines = bytes(buffer[:end]).decode("utf-8").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no record where one should begin: {lines[0][:40]!r}")
        fields = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}
        size = int(fields["content-length"])
        while len(buffer) < end + 4 + size + 4:
            if not more():
                raise ValueError("the archive ends inside a record")
        block = bytes(buffer[end + 4:end + 4 + size])
        del buffer[:end + 4 + size + 4]
        number = lambda k: int(fields[k]) if k in fields else None
        yield {"warc_type": fields.get("warc-type"), "record_id": fields.get("warc-record-id"), "page_id": number("page-id"),
               "url": fields.get("warc-target-uri"), "refers_to": number("refers-to-page-id"),
               "digest": fields.get("warc-payload-digest"), "origin_id": fields.get("warc-segment-origin-id"),
               "segment": number("warc-segment-number"), "total_length": number("warc-segment-total-length"), "block": block}


def read_records(spark: SparkSession, folder: str) -> DataFrame:
    """Every record of the archives under ``folder`` (schema ``RECORD``)."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder).select("content")
    schema = pa.schema([("warc_type", pa.string()), ("record_id", pa.string()), ("page_id", pa.int64()), ("url", pa.string()),
                        ("refers_to", pa.int64()), ("digest", pa.string()), ("origin_id", pa.string()), ("segment", pa.int32()),
                        ("total_length", pa.int64()), ("block", pa.binary())])

    def parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for content in batch.column(0):
                for record in parse(content.as_py()):
                    held.append(record)
                    size += len(record["block"])
                    if size >= BATCH_BYTES:
                        yield pa.RecordBatch.from_pylist(held, schema)
                        held, size = [], 0
        if held:
            yield pa.RecordBatch.from_pylist(held, schema)

    return files.mapInArrow(parsed, RECORD)


def reassemble(records: DataFrame) -> DataFrame:
    """One row per response or revisit with its whole block; ``complete`` is false where segments are missing, are
    numbered twice, or have another total length than the last of them states (the block is null then)."""
    columns = ["warc_type", "record_id", "page_id", "url", "refers_to", "digest"]
    whole = records.where("segment is null").select(*columns, "block", F.lit(True).alias("complete"))
    parts = records.where("segment is not null")
    head = lambda c: F.max(F.when(F.col("segment") == 1, F.col(c))).alias(c)
    joined = parts.groupBy(F.coalesce("origin_id", "record_id").alias("origin")).agg(
        *[head(c) for c in columns], F.max("total_length").alias("total"), F.count(F.lit(1)).alias("n"), F.max("segment").alias("last"),
        F.countDistinct("segment").alias("numbers"), F.sort_array(F.collect_list(F.struct("segment", "block"))).alias("parts"))
    # joined as strings, whose bytes Spark leaves as they are: one pass, however many segments there are
    block = F.array_join(F.transform("parts", lambda p: p["block"].cast("string")), "").cast("binary")
    joined = joined.withColumn("block", block)
    good = (F.col("n") == F.col("last")) & (F.col("numbers") == F.col("n")) & F.coalesce(F.octet_length("block") == F.col("total"), F.lit(False))
    joined = joined.where("record_id is not null").select(*columns, F.when(good, F.col("block")).alias("block"), good.alias("complete"))
    return whole.union(joined)


def read(spark: SparkSession, folder: str) -> DataFrame:
    """(page_id, url, record_type, refers_to, payload, payload_bytes, payload_digest, complete) of every page; a
    revisit has no payload, its size and digest are those of the full one."""
    blocks = reassemble(read_records(spark, folder))
    out = "page_id bigint, url string, record_type string, refers_to bigint, payload binary, payload_bytes bigint, payload_digest string, complete boolean"
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
                        ("payload", pa.binary()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("complete", pa.bool_())])

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held, size = [], 0
            for r in batch.to_pylist():
                row = {"page_id": r["page_id"], "url": r["url"], "record_type": r["warc_type"], "refers_to": r["refers_to"],
                       "payload": None, "payload_bytes": None, "payload_digest": None, "complete": False}
                head, _, body = (r["block"] or b"").partition(b"\r\n\r\n")
                stated = base64.b32decode(r["digest"].removeprefix("sha1:")) if r["digest"] else None
                if r["complete"] and r["warc_type"] == "revisit":
                    length = re.search(rb"(?im)^content-length: *(\d+)\r?$", head)
                    row |= {"payload_bytes": int(length[1]) if length else None, "payload_digest": stated.hex() if stated else None, "complete": True}
                elif r["complete"]:
                    payload = unchunked(body) if re.search(rb"(?im)^transfer-encoding: *chunked\r?$", head) else body
                    if payload is not None and hashlib.sha1(payload).digest() == stated:
                        row |= {"payload": payload, "payload_bytes": len(payload), "payload_digest": stated.hex(), "complete": True}
                held.append(row)
                size += len(row["payload"] or b"")
                if size >= BATCH_BYTES:
                    yield pa.RecordBatch.from_pylist(held, schema)
                    held, size = [], 0
            if held:
                yield pa.RecordBatch.from_pylist(held, schema)

    return blocks.mapInArrow(decoded, out)
