"""URL filters: temporal list join (operator 6).

List entries are dated: on a day, a key (a domain with all below it, or a host with a path prefix) is added to or
removed from a block or an allow list. Entries become validity intervals [from, to); each capture is judged by the entries active when it
was fetched: the most specific active key decides, and of equal keys the block list.

Entries collapse to one per list, key and day before their order is looked at, so a key with any number of entries
gives at most one row a day. Intervals are dealt out to the months they touch, captures to (key, day); the join is on (key, month) and
looks at 31 days at most per key, however many captures share it. Captures then meet the verdict of their (key, day) in an
equi-join that Spark can split.

Of a url's authority the host counts: without the user before an ``@``, the port, and dots at the end.

Defined cases: a capture without url, host or fetch time matches nothing and is kept; entries without key, list, action or date do
not count; of an addition and a removal on one day the removal counts; repeated captures each get their result; empty
tables give empty or clean results; other columns pass through, and ones named as an added column are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bankflow.session import cut_lineage


SCHEME = r"^\s*[A-Za-z][A-Za-z0-9+.-]*://"     # a backslash ends the host as a slash does: clients take it for one


def host_of(url: Column) -> Column:
    """The host in lower case, without user, port and dots at its end; empty if there is none."""
    authority = F.regexp_extract(url, SCHEME + r"([^/?#\\]*)", 1)
    return F.lower(F.regexp_replace(F.regexp_replace(authority, r"^.*@", ""), r"[.]*(:[0-9]*)?\s*$", ""))


def path_of(url: Column) -> Column:
    return F.regexp_extract(url, SCHEME + r"[^/?#\\]*[/\\]([^?#]*)", 1)


def lookup_keys(url: Column, depth: int) -> Column:
    """Keys under which a list can name the url, from the least specific to the most: domains, host, path prefixes of up to
    ``depth`` segments."""
    host, labels = host_of(url), F.split(host_of(url), r"\.")
    domains = F.transform(F.sequence(F.size(labels), F.lit(1), F.lit(-1)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    steps = F.slice(F.array_remove(F.split(path_of(url), r"[/\\]"), ""), 1, depth)
    prefixes = F.transform(F.sequence(F.lit(1), F.greatest(F.size(steps), F.lit(1))), lambda i: F.concat_ws("/", host, F.array_join(F.slice(steps, 1, i), "/")))
    return F.when(F.length(host) > 0, F.when(F.size(steps) > 0, F.concat(domains, prefixes)).otherwise(domains))


def intervals(entries: DataFrame) -> DataFrame:
    """(list, key, from, to): when each key was on each list; ``to`` is null for one that still is."""
    days = entries.where("list is not null and key is not null and day is not null and action in ('add', 'remove')")
    days = days.groupBy("list", "key", "day").agg(F.max("action").alias("action"))     # 'remove' is the greater
    w = Window.partitionBy("list", "key").orderBy("day")
    changed = days.withColumn("before", F.lag("action").over(w)).where("not (before <=> action)")
    return (changed.withColumn("to", F.lead("day").over(w)).where("action = 'add'")
            .select("list", "key", F.col("day").alias("from"), "to"))


def evaluate(captures: DataFrame, entries: DataFrame, url: str = "url", fetched: str = "fetched") -> DataFrame:
    """Add ``matched_key``, ``matched_list``, ``listed_from`` and ``blocked`` to each capture.

    Entries and looked-up keys are stored once; captures are read for the keys and for the result."""
    base = captures.drop("matched_key", "matched_list", "listed_from", "blocked")
    name = "capture"                                  # a capture's verdict depends on its url and time only
    while name in base.columns:
        name += "_"
    base = base.withColumn(name, F.struct(F.col(url).alias("url"), F.col(fetched).alias("at")))
    entries = cut_lineage(entries.select("list", "key", "action", "day"), "url-entries")
    depth = entries.agg(F.max(F.size(F.split("key", "/")) - 1)).first()[0] or 0      # of the deepest key of the lists
    wanted = base.select(F.col(name).alias("capture"), F.to_date(fetched).alias("day"), F.posexplode(lookup_keys(F.col(url), max(depth, 0))).alias("rank", "key"))
    wanted = cut_lineage(wanted.where("day is not null").distinct(), "url-keys")
    month = lambda d: F.trunc(d, "month")
    last = wanted.agg(F.max("day")).first()[0]
    active = intervals(entries)
    upto = F.least(F.date_sub(F.coalesce("to", F.lit(last)), F.when(F.col("to").isNull(), 0).otherwise(1)), F.lit(last))
    monthly = (active.where(F.col("from") <= F.lit(last))
               .withColumn("month", F.explode(F.sequence(month("from"), F.greatest(month(upto), month("from")), F.expr("interval 1 month")))))
    asked = wanted.select("key", "day").distinct().withColumn("month", month("day"))
    known = (asked.join(monthly, ["key", "month"]).where((F.col("from") <= F.col("day")) & (F.col("to").isNull() | (F.col("day") < F.col("to"))))
             .groupBy("key", "day").agg(F.max(F.struct("list", "from")).alias("hit")))      # 'block' is the greater
    best = wanted.join(known, ["key", "day"]).groupBy(F.col("capture").alias(name)).agg(F.max(F.struct("rank", "key", "hit")).alias("verdict_"))
    out, m = base.join(best, name, "left").drop(name), F.col("verdict_")
    return out.select(*[F.col(f"`{c}`") for c in out.columns if c != "verdict_"], m["key"].alias("matched_key"), m["hit"]["list"].alias("matched_list"),
                      m["hit"]["from"].alias("listed_from"), F.coalesce(m["hit"]["list"] == "block", F.lit(False)).alias("blocked"))
