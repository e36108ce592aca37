"""Temporal list join against a plain evaluation."""
import datetime as dt
import random

from bankflow.llm import url_lists


def keys(url):
    scheme, found, rest = (url or "").strip().partition("://")
    if not found or not scheme[:1].isalpha() or not scheme.replace("+", "").replace(".", "").replace("-", "").isalnum():
        return []
    place = rest.replace("\\", "/").split("#")[0].split("?")[0]
    authority, *steps = place.split("/")
    host = authority.split("@")[-1].lower()
    host = (host[:host.index("]") + 1] if host.startswith("[") else host.split(":")[0]).rstrip(".")
    if not host:
        return []
    labels, steps = host.split("."), [s for s in steps if s][:3]
    return [".".join(labels[i:]) for i in range(len(labels) - 1, -1, -1)] + ["/".join([host, *steps[:i]]) for i in range(1, len(steps) + 1)]


def state(entries, name, key, day):
    days = {}
    for lst, k, action, d in entries:
        if (lst, k) == (name, key) and action in ("add", "remove") and d is not None:
            days[d] = max(days.get(d, ""), action)
    since, last = None, None
    for d in sorted(x for x in days if x <= day):
        if days[d] != last:
            since, last = d, days[d]
    return since if last == "add" else None


def plain(url, at, entries):
    if at is None:
        return None, None, None, False
    for key in reversed(keys(url)):
        for name in ("block", "allow"):
            if since := state(entries, name, key, at.date()):
                return key, name, since, name == "block"
    return None, None, None, False


def test_against_plain(spark):
    rng = random.Random(5)
    hosts = ["a.example.com", "b.example.com", "example.org", "x.y.z"]
    day = lambda: dt.date(2024, 1, 1) + dt.timedelta(rng.randrange(120))
    urls = [f"{s}://{h}{p}" for s in ("http", "HTTPS") for h in [*hosts, "A.Example.com:80", "user:pw@a.example.com", "x@example.org.", "me@b@X.y.z.:8080"] for p in ("", "/", "/p/q?r=/z", "/p//q/r/s/t#x", "?q")]
    caps = [(i, rng.choice(urls), dt.datetime.combine(day(), dt.time(rng.randrange(24))), "c") for i in range(400)]
    caps += [(900, None, caps[0][2], None), (901, "nonsense", caps[0][2], None), (902, urls[0], None, None), caps[0], caps[0]]
    named = ["example.com", "com", "a.example.com", "a.example.com/p", "a.example.com/p/q", "x.y.z", "example.org/p", "b.example.com/p/q/r"]
    entries = [(rng.choice(["block", "allow"]), rng.choice(named), rng.choice(["add", "add", "remove"]), day()) for _ in range(120)]
    entries += [("block", None, "add", day()), (None, "com", "add", day()), ("block", "com", None, day()), ("block", "com", "odd", day()), ("block", "x.y.z", "add", None)]
    c = spark.createDataFrame(caps, "page_id bigint, url string, fetched timestamp_ntz, blocked string")
    e = spark.createDataFrame(entries, "list string, key string, action string, day date")
    got = sorted(((r["page_id"], r["matched_key"], r["matched_list"], r["listed_from"], r["blocked"]) for r in url_lists.evaluate(c, e).collect()), key=str)
    assert got == sorted(((i, *plain(u, t, entries)) for i, u, t, _ in caps), key=str)
    assert sum(r[4] for r in got) > 20


def test_empty(spark):
    c = spark.createDataFrame([(1, "http://a.b/", dt.datetime(2024, 1, 1))], "page_id bigint, url string, fetched timestamp_ntz")
    e = spark.createDataFrame([], "list string, key string, action string, day date")
    assert [r["blocked"] for r in url_lists.evaluate(c, e).collect()] == [False]
    full = spark.createDataFrame([("block", "b", "add", dt.date(2023, 1, 1))], "list string, key string, action string, day date")
    assert [r["blocked"] for r in url_lists.evaluate(c, full).collect()] == [True]
    assert url_lists.evaluate(c.limit(0), full).count() == 0


def test_prefixes_of_any_depth(spark):
    path = "/".join(f"s{i}" for i in range(12))
    c = spark.createDataFrame([(i, f"http://A.b.org/{path}?q", dt.datetime(2024, 1, 1 + i)) for i in range(3)], "page_id bigint, url string, fetched timestamp_ntz")
    e = spark.createDataFrame([("block", "b.org", "add", dt.date(2024, 1, 1)), ("allow", "a.b.org/s0/s1/s2/s3", "add", dt.date(2024, 1, 2)),
                               ("block", f"a.b.org/{path}", "add", dt.date(2024, 1, 3))], "list string, key string, action string, day date")
    got = [(r["matched_key"], r["blocked"]) for r in url_lists.evaluate(c, e).orderBy("page_id").collect()]
    assert got == [("b.org", True), ("a.b.org/s0/s1/s2/s3", False), (f"a.b.org/{path}", True)]


def test_hosts(spark):
    """A user, a port, dots at the end, capitals and backslashes hide no host."""
    from pyspark.sql import functions as F

    urls = ["http://user:pw@evil.com/x", "HTTP://x@Evil.com/", "http://evil.com./x", "http://evil.com:/", "http://a@b@evil.com.:80?q", "http://evil.com\\@good.org/x",
            "  https://evil.com", "ftp://evil.com#@good.org"]
    got = spark.createDataFrame([(u,) for u in [*urls, "http://[::1]:80/x", "http:///x", "http://@/x", "evil.com/x"]], "u string").select(url_lists.host_of(F.col("u"))).collect()
    assert [r[0] for r in got] == ["evil.com"] * len(urls) + ["[::1]", "", "", ""]


def test_columns_of_any_type(spark):
    rows = [(1, "http://a.b/", dt.datetime(2024, 1, 1), {"k": 1}, "x", 5)]
    c = spark.createDataFrame(rows, "page_id bigint, url string, fetched timestamp_ntz, capture map<string,int>, verdict string, key int")
    e = spark.createDataFrame([("block", "b", "add", dt.date(2023, 1, 1))], "list string, key string, action string, day date")
    out = url_lists.evaluate(c, e)
    assert out.columns[:6] == c.columns and out.first()["capture"] == {"k": 1} and out.first()["blocked"]
