"""URL filters as a sort-merge range join.

Every url host suffix and every rule becomes one string on a single ordered
axis: the labels from the top-level domain downwards, a slash (which no host
holds) and the path, e.g. ``net.example//en/``. A rule is then the interval
of all strings that start with its key, and such intervals nest. The axis is
cut into ranges at sampled keys; a rule goes to every range that its
interval meets. Each range is sorted and swept once with a stack of the
rules that are open at the current key; the top of the stack is the longest
rule that fits it.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airloom.llm.common import ascii_lower, partitions

SAMPLE = 4096  # keys sampled for the range bounds: the most the driver sees
BOUND_CHARS = 256  # a bound may be any string, so long keys are cut here
LAST = "\U0010ffff"


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#``; A-Z lower-cased."""
    return ascii_lower(F.regexp_extract(_rest(url), r"^([^/?#]*)", 1))


def url_path(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def _reversed(host: Column) -> Column:
    return F.reverse(F.split(host, r"\.", -1))


def _bounds(probes: DataFrame, n: int) -> list[str]:
    """Up to ``n - 1`` range bounds from a uniform sample of the keys.

    The row with the least hash of each of SAMPLE hash groups is kept, which
    Spark combines on the map side; the driver gets SAMPLE keys at most.
    """
    h = F.xxhash64("key", "host")
    rows = (
        probes.groupBy(F.pmod(h, F.lit(SAMPLE)).alias("g"))
        .agg(F.min_by(F.substring("key", 1, BOUND_CHARS), h).alias("key"))
        .collect()
    )
    keys = sorted(r["key"] for r in rows)
    return [keys[i * len(keys) // n] for i in range(1, n)] if keys else []


def _sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part, stack = None, []  # open rules, outermost first
    schema = pa.schema([("host", pa.string()), ("path", pa.string()), ("rule", pa.string()), ("verdict", pa.string()), ("chars", pa.int64()), ("host_chars", pa.int64())])
    for b in batches:
        out = []
        c = {n: b.column(i).to_pylist() for i, n in enumerate(b.schema.names)}
        for p, key, kind, host, path, rule, verdict, hc in zip(c["part"], c["key"], c["kind"], c["host"], c["path"], c["rule"], c["verdict"], c["host_chars"]):
            if p != part:
                part, stack = p, []
            while stack and not key.startswith(stack[-1][0]):
                stack.pop()
            if kind == 0:
                stack.append((key, rule, verdict, hc))
            elif stack:
                _, r, v, n = stack[-1]
                out.append((host, path, r, v, len(r), n))
        yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*out) if out else [[]] * 6, schema)], schema=schema)


def match_urls(pages: DataFrame, rules: DataFrame, url_col: str = "url", default: str = "allow") -> DataFrame:
    """Every row of ``pages`` with host, path, the rule that fits and a verdict.

    ``rules`` has host, path and verdict (``allow`` or ``block``). A rule
    fits its host and all subdomains of it when the url's path starts with
    the rule's; the rule with most characters (host and path) wins, the one
    with the longer host among equals. Of equal rules a block wins. Without
    a rule ``rule`` is null and ``verdict`` is ``default``.

    Null urls and urls without ``://`` have an empty host and path and no
    rule. Rules without a host are ignored. Repeated rows keep their count,
    other columns stay; ``host``, ``path``, ``rule`` and ``verdict`` of the
    input, if any, are replaced.
    """
    spark = pages.sparkSession
    pages = pages.drop("rule", "verdict").withColumn("_url", F.col(url_col)).withColumns({"host": url_host(F.col("_url")), "path": url_path(F.col("_url"))}).drop("_url")
    rules = (
        rules.select(ascii_lower(F.col("host")).alias("host"), F.coalesce("path", F.lit("")).alias("path"), "verdict")
        .filter(F.col("host") != "")
        .groupBy("host", "path")
        .agg(F.min_by("verdict", F.when(F.col("verdict") == "block", 0).otherwise(1)).alias("verdict"))
        .withColumn("_rev", _reversed(F.col("host")))
    )
    depth = rules.agg(F.max(F.size("_rev"))).first()[0] or 0
    rules = rules.select(
        F.concat(F.concat_ws(".", "_rev"), F.lit("/"), "path").alias("key"),
        F.lit(0).alias("kind"),
        "host",
        "path",
        F.concat("host", "path").alias("rule"),
        "verdict",
        F.length("host").cast("long").alias("host_chars"),
    )
    probes = (
        pages.filter(F.col("host") != "")
        .select("host", "path")
        .distinct()
        .withColumn("_rev", _reversed(F.col("host")))
        .withColumn("_n", F.explode(F.sequence(F.lit(1), F.greatest(F.lit(1), F.least(F.size("_rev"), F.lit(depth))))))
        .select(
            F.concat(F.concat_ws(".", F.slice("_rev", F.lit(1), F.col("_n"))), F.lit("/"), "path").alias("key"),
            F.lit(1).alias("kind"),
            "host",
            "path",
            F.lit(None).cast("string").alias("rule"),
            F.lit(None).cast("string").alias("verdict"),
            F.lit(None).cast("long").alias("host_chars"),
        )
    )
    n = partitions(spark)
    bounds = _bounds(probes, n)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows, parts = [], []
            for i, (key, kind, host) in enumerate(zip(*(b.column(k).to_pylist() for k in (0, 1, 2)))):
                if kind == 0:  # each range that the rule's interval meets
                    into = range(bisect_left(bounds, key), bisect_right(bounds, key + LAST) + 1)
                else:  # a key that is several bounds at once is spread over their ranges
                    lo, hi = bisect_left(bounds, key), bisect_right(bounds, key)
                    into = (lo if lo == hi else lo + sum(host.encode()) % (hi - lo + 1),)
                rows.extend([i] * len(into))
                parts.extend(into)
            t = b.take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(parts, pa.int32()), *t.columns], names=["part", *b.schema.names])

    fields = "key string, kind int, host string, path string, rule string, verdict string, host_chars long"
    placed = rules.unionByName(probes).mapInArrow(place, f"part int, {fields}")
    found = (
        placed.repartition(n, "part")
        .sortWithinPartitions("part", "key", "kind")
        .mapInArrow(_sweep, "host string, path string, rule string, verdict string, chars long, host_chars long")
        .groupBy("host", "path")
        .agg(F.max_by(F.struct("rule", "verdict"), F.struct("chars", "host_chars")).alias("_best"))
    )
    return (
        pages.join(found, ["host", "path"], "left")
        .withColumn("rule", F.col("_best.rule"))
        .withColumn("verdict", F.coalesce("_best.verdict", F.lit(default)))
        .drop("_best")
    )
