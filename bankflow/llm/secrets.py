"""Secret scans with a randomness test battery (operator 3). DataFrame functions only.

Base kinds are found by pattern. Beyond them, each run of 20 or more characters that encodings use, with digits and
letters, gets the smallest encoding whose alphabet holds it, and three tests of the hypothesis that it is drawn
uniformly from that alphabet:

* chi-squared statistic of the character counts, upper tail, with its exact mean and variance under the hypothesis;
* number of runs above and below the middle of the alphabet (Wald-Wolfowitz), two tails;
* lag-one serial correlation of the character values, two tails.

Fisher's method combines the three. Random runs have uniform combined p-values, text has small ones. In each class of encoding and
length (powers of two) the runs with p over one half tell how many are random; how far up the p-values of the others reach is
estimated from the class and, where it is thin, from its neighbours. A run is reported if its p is at or over the least threshold
at which the expected share of others among the reported is at most ``FALSE_SHARE``. The p-values are counted in a histogram of fixed
bins over all documents; only thresholds (encodings times length classes, at most 8 * 32) reach the driver.

Spans count code points, the end exclusive. Spans of the battery inside or over a base span are left out.

Defined cases: a null or empty text has no spans; a long text is scanned whole; each row gets its own result, equal
rows equal ones; an empty table gives an empty table; added columns replace ones of the same name.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The base kinds in order, with the group and its least length.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
BASE = {"assign": (ASSIGN, 2, 6), "access": (r"AKIA[A-Z0-9]+", 0, 20), "hex": (r"[0-9a-f]{24,}", 0, 24)}

LEAST = 20               # characters of a run that the battery tests
# A run may stand behind '='; one or two '=' belong to it as padding, unless another run follows them.
RUN = rf"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{{{LEAST},}}+(?:={{1,2}}+(?![A-Za-z0-9+/_-]))?"
FALSE_SHARE = 0.05
FLOOR = 1e-9             # least p-value of one test
BINS = 100
FOLD = 256               # matches of a text whose places are added up at a time
POOL = 20                # runs that the tail of a wider pool counts as
TEXT_TAIL = 0.004        # share of text-like runs with p >= t is this over t where the data say nothing (identifiers of Python's library)

DIGITS, LOWER, UPPER = string.digits, string.ascii_lowercase, string.ascii_uppercase
# Encodings from the smallest alphabet up; values of characters are their places.
ENCODINGS = {"hex": DIGITS + "abcdef", "HEX": DIGITS + "ABCDEF", "base32": UPPER + "234567", "base36": DIGITS + LOWER,
             "BASE36": DIGITS + UPPER, "base62": DIGITS + UPPER + LOWER, "base64": UPPER + LOWER + DIGITS + "+/",
             "base64url": UPPER + LOWER + DIGITS + "-_"}

SPAN = "array<struct<kind:string,start:int,end:int>>"


def let(value: Column, fn) -> Column:
    """``fn(value)``, the value computed once: inside a lambda Spark computes an expression as often as it is written."""
    return F.get(F.transform(F.array(value), fn), F.lit(0))


def matches(text: Column, pattern: str, group: int) -> Column:
    """Array of (start, end, part) of all matches from left to right; ``part`` is the group's text.

    The text between matches and the matches themselves alternate, so places are sums of lengths. They are added up in blocks of
    ``FOLD`` matches, as a fold that appends copies what it has so far."""
    whole, between = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern)
    part = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else whole
    rows = F.arrays_zip(whole.alias("whole"), part.alias("part"), F.slice(between, 1, F.size(whole)).alias("gap"))
    kind = "array<struct<start:int,end:int,part:string>>"
    none, no_block = F.array().cast(kind), F.array().cast(f"array<{kind}>")

    def folded(of: Column, at: Column) -> Column:
        return F.aggregate(of, F.struct(at.alias("at"), none.alias("found")), lambda acc, m: F.struct(
            (acc["at"] + F.length(m["gap"]) + F.length(m["whole"])).alias("at"),
            F.concat(acc["found"], F.array(F.struct(
                (acc["at"] + F.length(m["gap"])).alias("start"),
                (acc["at"] + F.length(m["gap"]) + F.length(m["whole"])).alias("end"),
                m["part"].alias("part")))).alias("found")))

    def one_more(acc: Column, block: Column) -> Column:
        return let(folded(block, acc["at"]), lambda new: F.struct(new["at"].alias("at"), F.concat(acc["blocks"], F.array(new["found"])).alias("blocks")))

    blocks = let(rows, lambda r: F.transform(F.sequence(F.lit(0), F.floor((F.size(r) - 1) / FOLD).cast("int")), lambda i: F.slice(r, i * FOLD + 1, FOLD)))
    all_ = F.aggregate(blocks, F.struct(F.lit(0).alias("at"), no_block.alias("blocks")), one_more, lambda acc: F.flatten(acc["blocks"]))
    return F.when(F.rlike(text, F.lit(pattern)), all_).otherwise(none)


def base_spans(text: Column) -> Column:
    """Spans of the base kinds, by start and then in the order of kinds."""
    parts = []
    for rank, (kind, (pattern, group, least)) in enumerate(BASE.items()):
        found = matches(text, pattern, group)
        if kind == "access":
            found = F.when(F.contains(text, F.lit("AKIA")), found).otherwise(F.array().cast("array<struct<start:int,end:int,part:string>>"))
        long = F.filter(found, lambda m: F.length(m["part"]) >= least)
        parts.append(F.transform(long, lambda m: F.struct(m["start"].alias("start"), F.lit(rank).alias("rank"),  # noqa: B023
                                                          m["end"].alias("end"), F.lit(kind).alias("kind"))))  # noqa: B023
    return F.transform(F.array_sort(F.concat(*parts)), lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))


def upper_tail(z: Column) -> Column:
    """P(Z >= z) of the normal distribution, from the usual rational approximation of erfc."""
    x = F.abs(z) / (2.0 ** 0.5)
    t = 1.0 / (1.0 + 0.3275911 * x)
    poly = t * (0.254829592 + t * (-0.284496736 + t * (1.421413741 + t * (-1.453152027 + t * 1.061405429))))
    half = 0.5 * poly * F.exp(-x * x)
    return F.greatest(F.when(z >= 0, half).otherwise(1.0 - half), F.lit(FLOOR))


def _encoding(body: Column) -> Column:
    """Name of the smallest encoding that holds all characters; null without a digit or a letter."""
    out = F.lit(None).cast("string")
    for name, alphabet in reversed(ENCODINGS.items()):
        out = F.when(F.translate(body, alphabet, "") == "", F.lit(name)).otherwise(out)
    return F.when(F.rlike(body, F.lit("[0-9]")) & F.rlike(body, F.lit("[A-Za-z]")), out)


def tested_runs(text: Column) -> Column:
    """Array of (start, end, enc, class, p) of the runs that have an encoding. ``class`` is the length's log2."""
    runs = F.transform(matches(text, RUN, 0), lambda m: F.struct(
        m["start"].alias("start"), m["end"].alias("end"), F.rtrim(m["part"], F.lit("=")).alias("body")))
    coded = F.filter(F.transform(runs, lambda m: F.struct(
        m["start"].alias("start"), m["end"].alias("end"), m["body"].alias("body"),
        _encoding(m["body"]).alias("enc"))), lambda m: m["enc"].isNotNull())
    alphabets = F.create_map(*[F.lit(x) for kv in ENCODINGS.items() for x in kv])
    valued = F.transform(coded, lambda m: F.struct(
        m["start"].alias("start"), m["end"].alias("end"), m["enc"].alias("enc"),
        F.length(alphabets[m["enc"]]).cast("double").alias("k"),
        F.transform(F.filter(F.split(m["body"], ""), lambda c: c != ""),
                    lambda c: (F.instr(alphabets[m["enc"]], c) - 1).cast("double")).alias("v")))

    def total(of: Column) -> Column:
        return F.aggregate(of, F.lit(0.0), lambda a, x: a + x)

    counted = F.transform(valued, lambda m: F.struct(
        m["start"].alias("start"), m["end"].alias("end"), m["enc"].alias("enc"), m["k"].alias("k"), m["v"].alias("v"),
        F.size(m["v"]).cast("double").alias("n"), (total(m["v"]) / F.size(m["v"])).alias("mean"),
        total(F.transform(F.array_distinct(m["v"]), lambda c: F.pow(F.size(F.filter(m["v"], lambda x: x == c)), F.lit(2.0)))).alias("squares"),
        F.transform(m["v"], lambda x: x >= m["k"] / 2).alias("side")))

    def summed(m: Column) -> Column:
        n, v, side, mean = m["n"], m["v"], m["side"], m["mean"]
        nxt = F.slice(v, 2, F.size(v))
        lag = total(F.zip_with(F.slice(v, 1, F.size(v) - 1), nxt, lambda a, b: (a - mean) * (b - mean)))
        spread = total(F.transform(v, lambda x: (x - mean) * (x - mean)))
        n1 = F.size(F.filter(side, lambda s: s)).cast("double")
        changes = F.size(F.filter(F.zip_with(F.slice(side, 1, F.size(side) - 1), F.slice(side, 2, F.size(side)),
                                             lambda a, b: a != b), lambda d: d)).cast("double")
        return F.struct(m["start"].alias("start"), m["end"].alias("end"), m["enc"].alias("enc"), m["k"].alias("k"), n.alias("n"),
                        m["squares"].alias("squares"), lag.alias("lag"), spread.alias("spread"),
                        (2.0 * n1 * (n - n1)).alias("mixed"), (changes + 1.0).alias("runs"))

    def combined(m: Column) -> Column:
        n, k, mixed = m["n"], m["k"], m["mixed"]
        chi = (k / n * m["squares"] - n - (k - 1.0)) / F.sqrt(2.0 * (k - 1.0) * (n - 1.0) / n)
        spread_runs = F.sqrt(mixed * (mixed - n) / (n * n * (n - 1.0)))
        runs = F.when(mixed > n, F.abs(m["runs"] - mixed / n - 1.0) / spread_runs).otherwise(F.sqrt(n))
        serial = F.when(m["spread"] > 0, F.abs(m["lag"] / m["spread"] + 1.0 / n) * F.sqrt(n)).otherwise(F.sqrt(n))
        half = -(F.log(upper_tail(chi)) + F.log(F.least(2.0 * upper_tail(runs), F.lit(1.0)))
                 + F.log(F.least(2.0 * upper_tail(serial), F.lit(1.0))))
        p = F.exp(-half) * (1.0 + half + half * half / 2.0)      # Fisher: chi-squared with six degrees of freedom
        return F.struct(m["start"].alias("start"), m["end"].alias("end"), m["enc"].alias("enc"),
                        F.floor(F.log2(n)).cast("int").alias("class"), p.alias("p"))

    return F.transform(F.transform(counted, summed), combined)


def _share(counts: list[int], parent: list[float]) -> tuple[float, list[float]]:
    """(others, tail): runs that are not random in a histogram of p-values, and the share of such runs from each bin on.

    Random runs are twice those of the upper half. What the histogram holds beyond them, less the error of that estimate, is
    weighed against ``parent``, the tail of the wider pool, which counts as ``POOL`` runs."""
    upper = sum(counts[BINS // 2:])
    others = max(sum(counts) - 2.0 * upper, 0.0)
    tail = []
    for j in range(BINS):
        left = 1 - j / BINS
        extra = sum(counts[j:]) - 2.0 * upper * left - (2.0 * upper + 4) ** 0.5 * left
        tail.append((min(max(extra, 0.0), others) + POOL * parent[j]) / (others + POOL))
    return others, tail


def limits_of(classes: dict[tuple[str, int], list[int]]) -> dict[tuple[str, int], float]:
    """Least p-value reported in each class, from the histograms of all classes.

    The tail of runs that are not random is that of the class itself, of the other classes of its encoding where it is thin, of
    the other encodings where these are, and ``TEXT_TAIL`` where there are few runs at all."""
    def pool(keys: list[tuple[str, int]]) -> list[int]:
        return [sum(c) for c in zip([0] * BINS, *[classes[k] for k in keys])]

    prior = [1.0, *[min(1.0, TEXT_TAIL * BINS / j) for j in range(1, BINS)]]
    out: dict[tuple[str, int], float] = {}
    for key, counts in classes.items():
        far = _share(pool([k for k in classes if k[0] != key[0]]), prior)[1]
        near = _share(pool([k for k in classes if k[0] == key[0] and k != key]), far)[1]
        others, tail = _share(counts, near)
        for j in range(BINS):
            flagged = sum(counts[j:])
            if flagged and others * tail[j] <= FALSE_SHARE * flagged:
                out[key] = j / BINS
                break
    return out


def thresholds(df: DataFrame, text: str = "text") -> dict[tuple[str, int], float]:
    """Least p-value reported in each class, from the histogram of all documents' runs; at most 8 * 32 entries."""
    runs = df.select(F.explode(tested_runs(F.col(text))).alias("r")).select("r.*")
    bins = runs.groupBy("enc", "class", F.least(F.floor(F.col("p") * BINS), F.lit(BINS - 1)).alias("bin")).count()
    classes: dict[tuple[str, int], list[int]] = {}
    for r in bins.collect():                      # bounded: encodings * length classes * bins
        classes.setdefault((r["enc"], r["class"]), [0] * BINS)[r["bin"]] += r["count"]
    return limits_of(classes)


def find(df: DataFrame, limits: dict[tuple[str, int], float], text: str = "text") -> DataFrame:
    """Add ``base_spans`` and ``spans`` (arrays of kind, start, end; the battery's kind is "random")."""
    whole = F.coalesce(F.col(text), F.lit(""))
    reported = F.lit(False)
    found = df.withColumn("base_spans", base_spans(whole).cast(SPAN))
    if limits:
        table = F.create_map(*[F.lit(x) for (enc, c), p in sorted(limits.items()) for x in (f"{enc}:{c}", p)])
        reported = lambda m: m["p"] >= F.coalesce(table[F.concat_ws(":", m["enc"], m["class"])], F.lit(2.0))
        more = F.filter(tested_runs(whole), lambda m: reported(m) & ~F.exists(
            F.col("base_spans"), lambda b: (b["start"] < m["end"]) & (m["start"] < b["end"])))
        more = F.transform(more, lambda m: F.struct(F.lit("random").alias("kind"), m["start"].alias("start"), m["end"].alias("end")))
        by_start = F.transform(F.concat("base_spans", more.cast(SPAN)), lambda s: F.struct(
            s["start"].alias("start"), F.when(s["kind"] == "assign", 0).when(s["kind"] == "access", 1)
            .when(s["kind"] == "hex", 2).otherwise(3).alias("rank"), s["end"].alias("end"), s["kind"].alias("kind")))
        spans = F.transform(F.array_sort(by_start), lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    else:
        spans = F.col("base_spans")
    return found.withColumn("spans", spans.cast(SPAN))


def scan(df: DataFrame, text: str = "text") -> DataFrame:
    """``find`` with thresholds from ``df`` itself."""
    return find(df, thresholds(df, text), text)


def digest(spans: Column) -> Column:
    """Spans as kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redact(df: DataFrame, text: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """Replace what the ``spans`` cover by ``mark``, overlapping spans once; null texts stay null."""
    pieces = F.aggregate(
        "spans", F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out")),
        lambda acc, s: F.struct(
            F.greatest(acc["at"], s["end"]).alias("at"),
            F.when(s["start"] >= acc["at"], F.concat(acc["out"], F.array(
                F.substring(F.col(text), acc["at"] + 1, s["start"] - acc["at"]), F.lit(mark)))).otherwise(acc["out"]).alias("out")),
        lambda acc: F.concat(F.array_join(acc["out"], ""), F.substring(F.col(text), acc["at"] + 1, F.length(text))))
    return df.withColumn(text, F.when(F.size("spans") > 0, pieces).otherwise(F.col(text)))
