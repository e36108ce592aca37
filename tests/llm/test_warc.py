"""WARC archives: exact round trips, segments, framing, damage."""
import hashlib

import pytest

from bankflow.llm import registry, warc
from bankflow.session import work_dir
from tests.conftest import SF_SMALL

SCHEMA = "page_id bigint, url string, html string, payload string, kept int"


def plain(pages):
    bodies = [(p, (h or "").encode()) for p, h in pages]
    last = {}
    for p, b in bodies:
        if len(b) >= 1000 and p is not None:
            last[b] = max(p, last.get(b, p))
    out = []
    for p, b in bodies:
        keep = last.get(b)
        again = keep is not None and p != keep
        out.append((p, len(b), hashlib.sha1(b).hexdigest(), "revisit" if again else "response", keep if again else None))
    return sorted(out, key=str)


def stored(spark, rows):
    folder = work_dir(spark, "warc")
    warc.write(spark.createDataFrame(rows, SCHEMA), folder)
    return folder


def result(spark, folder):
    return sorted(((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in warc.read(spark, folder).collect()), key=str)


ROWS = [(1, "http://a/x", "é" * 600, "p", 1), (2, "http://a/\r\ny", "é" * 600, None, None), (3, None, None, "q", 2), (4, "u", "", None, None),
        (5, "u", "short", None, None), (6, "u", "short", None, None), (7, "u", "x\r\n\r\ny" * 30_000, None, None), (7, "u", "x\r\n\r\ny" * 30_000, None, None),
        (None, "u", "é" * 600, None, None), (8, "u", "WARC/1.1\r\n\r\n" * 2000 + "日", None, None), (9, "u", "a" * 999, None, None), (10, "u", "a" * 999, None, None)]


def test_round_trip(spark):
    folder = stored(spark, ROWS)
    assert result(spark, folder) == plain([(r[0], r[2]) for r in ROWS])
    payloads = {r["page_id"]: bytes(r["payload"]) for r in warc.read(spark, folder).where("record_type = 'response'").collect()}
    assert payloads[8].decode() == ROWS[9][2] and payloads[7].decode() == ROWS[6][2]


def test_segments_are_real(spark):
    records = warc.read_records(spark, stored(spark, ROWS))
    kinds = {r["warc_type"]: r["count"] for r in records.groupBy("warc_type").count().collect()}
    assert kinds["continuation"] > 10 and kinds["revisit"] == 2
    assert records.where("octet_length(block) > 16384").count() == 0


def test_damage_is_reported(spark):
    records = warc.read_records(spark, stored(spark, ROWS[6:7] + ROWS[9:10]))
    for lost, whole in (("segment = 3", {8}), ("segment = 2", set()), ("total_length is not null", set())):
        rows = warc.reassemble(records.where(f"not (page_id is null and ({lost}))")).collect()
        assert {r["page_id"] for r in rows if r["complete"]} == whole
        assert all((r["block"] is None) != r["complete"] for r in rows) and len(rows) == 2
    twice = warc.reassemble(records.union(records.where("segment = 2"))).collect()
    assert not any(r["complete"] for r in twice)
    assert all(r["complete"] for r in warc.reassemble(records.orderBy("record_id")).collect())


@pytest.mark.parametrize("size", [0, 1, 4095, 4096, 4097, 20_000])
def test_chunked_framing(size):
    body = warc.chunked(b"z" * size)
    assert warc.unchunked(body) == b"z" * size
    assert warc.unchunked(body[:-3]) is None and warc.unchunked(b"x" + body) is None
    assert warc.unchunked(b"3;ext=1\r\nabc\r\n0\r\nTrailer: 1\r\n\r\n") == b"abc"


def test_parse_refuses_cut_archives():
    data = b"\r\n\r\n".join(warc.page_records("a", 1, 1, "u", b"hello", None, False)) + b"\r\n\r\n"
    assert len(list(warc.parse(data))) == 1
    with pytest.raises(ValueError):
        list(warc.parse(data[:-10]))
    with pytest.raises(ValueError):
        list(warc.parse(b"junk" + data))


def test_archives_read_together(spark):
    """Record ids are unique over archives: two folders of segmented pages, read as one."""
    folders = [stored(spark, [(n, "u", f"{n} " * 20_000, None, None), (n + 10, "u", f"{n + 10}-" * 9_000, None, None)]) for n in (1, 2)]
    records = warc.read_records(spark, folders[0]).union(warc.read_records(spark, folders[1]))
    assert records.select("record_id").distinct().count() == records.count()
    rows = warc.reassemble(records).collect()
    assert sorted(r["page_id"] for r in rows if r["complete"]) == [1, 2, 11, 12]


def test_a_page_of_many_segments(spark):
    body = "".join(f"{i:07d}\u00e9" for i in range(900_000))
    rows = warc.read(spark, stored(spark, [(1, "u", body, None, None)])).collect()
    assert [bytes(r["payload"]).decode() for r in rows] == [body]


def test_empty_table(spark):
    assert result(spark, stored(spark, [])) == []


def test_query(spark):
    pages = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/pages.parquet").select("page_id", "html").collect()]
    got = sorted(((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in registry.op4_warc(spark, SF_SMALL).collect()), key=str)
    assert got == plain(pages)
