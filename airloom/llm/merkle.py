"""Merkle manifest of a dataset: digests, inclusion proofs and their verification.

Leaves are rows; the leaves of a group (a source) make one tree, and the
groups' roots make the tree above them. A node is labelled with the interval
[lo, hi) of leaf ranks that it covers, ranks counting through all groups in
order. Labels do the rest: a node is below another if its interval lies in
the other's, and a node's siblings are those whose intervals fill the
difference between the parent's interval and its own.

Levels are built and joined in buckets of ``LEVELS``: a slab is a node with
all below it down ``LEVELS`` levels, one row whose arrays have a bounded
size. Ancestors come from the slab above by a containment join, keyed by the
interval's bucket at that level, so a tree of a third of all rows is divided
like any other; the siblings inside a slab come from its interval arithmetic.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airloom.llm.common import save
from airloom.operators.ordering import numbered

FAN = 3
LEVELS = 6  # of a slab: FAN ** LEVELS nodes at most
RANGE = 1 << 16  # ranks that share their group's label in one join key
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def leaf_digest(values: Sequence[Column]) -> Column:
    """Digest of a row: ``-`` for a null, else UTF-8 byte count, ``:`` and the value."""

    def part(c: Column) -> Column:
        s = c.cast("string")
        return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))

    return digest(*(part(v) for v in values))


def leaves(docs: DataFrame, group: str = "source", key: str = "doc_id", columns: Sequence[str] = COLUMNS, changed: dict[str, Column] | None = None) -> DataFrame:
    """(group, key, leaf, now): the digest of each row, and of the row with ``changed`` columns."""
    own = [F.col(c) for c in columns]
    now = [(changed or {}).get(c, F.col(c)) for c in columns]
    return docs.select(F.col(group).alias("group"), F.col(key).alias("key"), leaf_digest(own).alias("leaf"), leaf_digest(now).alias("now"))


@dataclass
class Manifest:
    """``slabs``: the slabs of each bucket of levels, lowest first, of all groups' trees;
    ``tops``: (base, size, digest) of each tree, ``base`` being its first leaf's rank;
    ``above``: the manifest of the tree whose leaves are the tops, None in that one."""

    slabs: list[DataFrame]
    tops: DataFrame
    above: "Manifest | None" = None

    def nodes(self) -> DataFrame:
        """(level, base, lo, hi, digest): every node of the trees with its label."""
        found = None
        for n, slab in enumerate(self.slabs):
            # A slab's top stands in the slab above, if there is one.
            upto = F.when(F.col("single"), F.col("height") + 1).otherwise(F.col("height"))
            each = slab.select("base", "start", "step", "last", F.posexplode(F.slice("levels", F.lit(1), upto)).alias("l", "digests"))
            each = each.select("base", "start", "step", "last", "l", F.posexplode("digests").alias("i", "digest"))
            width = F.col("step") * F.pow(F.lit(FAN), "l").cast("long")
            lo = F.col("start") + F.col("i") * width
            rows = each.select((F.col("l") + n * LEVELS).alias("level"), "base", lo.alias("lo"), F.least(lo + width, F.col("last")).alias("hi"), "digest")
            found = rows if found is None else found.unionByName(rows)
        return found


def _parents(digests: Column) -> Column:
    runs = F.sequence(F.lit(0), F.floor((F.size(digests) - 1) / FAN).cast("int"))
    return F.transform(runs, lambda i: F.sha2(F.array_join(F.slice(digests, i * FAN + 1, F.lit(FAN)), "").cast("binary"), 256))


def _slabs(nodes: DataFrame, level: int) -> DataFrame:
    """Nodes of one level (base, size, lo, digest, and payload columns ``rows``) as slabs:
    (base, size, start, step, last, single, height, levels, rows). ``start`` and ``last``
    bound the slab's interval, ``step`` is its lowest nodes' width, ``single`` says that
    the slab is its whole tree; ``levels`` are its digests by level."""
    step = FAN**level
    wide = step * FAN**LEVELS
    bucket = F.expr(f"(lo - base) div {wide}L")
    item = F.struct("lo", "digest", *(c for c in nodes.columns if c == "row"))
    slabs = nodes.groupBy("base", "size", bucket.alias("bucket")).agg(F.array_sort(F.collect_list(item)).alias("rows"))
    # The levels that its nodes need to become one.
    height = sum((F.when(F.size("rows") > FAN**k, 1).otherwise(0) for k in range(LEVELS)), F.lit(0))
    steps = F.filter(F.sequence(F.lit(1), F.lit(LEVELS)), lambda k: k <= F.col("height"))
    low = F.array(F.col("rows.digest"))
    start = F.col("base") + F.col("bucket") * F.lit(wide)
    single = F.col("size") <= wide
    slabs = slabs.select(
        "base", "size", "rows", start.alias("start"), F.lit(step).cast("long").alias("step"), F.least(start + wide, F.col("base") + F.col("size")).alias("last"), single.alias("single"),
        # One of several slabs has a node at its upper end, however few it covers.
        F.when(single, height).otherwise(LEVELS).alias("height"),
    )
    return slabs.withColumn("levels", F.aggregate(steps, low, lambda done, _: F.concat(done, F.array(_parents(F.element_at(done, -1))))))


def _build(nodes: DataFrame, most: int) -> tuple[list[DataFrame], DataFrame]:
    """Slabs of each bucket of levels and the trees' top digests; ``most`` leaves in a tree."""
    slabs, level, tops = [], 0, None
    while True:
        made = save(_slabs(nodes, level), "merkle-slabs")
        slabs.append(made)
        top = F.element_at(F.element_at("levels", -1), 1).alias("digest")
        done = made.filter("single").select("base", "size", top)
        tops = done if tops is None else tops.unionByName(done)
        if most <= FAN ** (level + LEVELS):
            return slabs, save(tops, "merkle-tops")
        nodes = made.filter("NOT single").select("base", "size", F.col("start").alias("lo"), top)
        level += LEVELS


def _siblings(levels: Column, at: Column, height: Column) -> Column:
    """For the lowest node ``at`` of a slab, level by level: the digests before and after its
    ancestor in that one's run, by the intervals that the parent's has beyond its own."""

    def level(k: Column) -> Column:
        width = F.pow(F.lit(FAN), k - 1).cast("int")
        own = F.floor(at / width).cast("int")  # the ancestor's interval is [own, own + 1) of this width
        first = F.floor(own / FAN).cast("int") * FAN  # the parent's begins here
        digests = F.element_at(levels, k)
        before = F.slice(digests, first + 1, own - first)
        after = F.slice(digests, own + 2, first + FAN - 1 - own)
        return F.struct(F.array_join(before, "").alias("before"), F.array_join(after, "").alias("after"))

    levels_below = F.filter(F.sequence(F.lit(1), F.lit(LEVELS)), lambda k: k <= height)
    return F.transform(levels_below, level)


def _paths(slabs: list[DataFrame], over: DataFrame) -> DataFrame:
    """(base, lo, digest, row, top, path): the siblings on the way up from each leaf.

    ``over`` has (base, top, path) of each tree: what its leaves get besides.
    A tree's single slab takes it from there, every other slab from the node
    above whose interval contains its own.
    """
    given = None
    for n in reversed(range(len(slabs))):
        slab = slabs[n].filter("single").join(over.select("base", "top", F.col("path").alias("upper")), "base")
        if given is not None:
            wide = FAN ** ((n + 1) * LEVELS)
            buckets = F.explode(F.expr(f"sequence(lo div {wide}L, (lo + {wide}L - 1) div {wide}L)"))
            node = given.select(F.col("base").alias("tree"), F.col("lo").alias("node_lo"), "top", F.col("path").alias("upper"), buckets.alias("at"))
            part = slabs[n].filter("NOT single").withColumn("bucket", F.expr(f"start div {wide}L"))
            same = (part["base"] == node["tree"]) & (part["bucket"] == node["at"])
            inside = (part["start"] >= node["node_lo"]) & (part["last"] <= node["node_lo"] + F.lit(wide))
            slab = slab.unionByName(part.join(node, same & inside).select(*slab.columns))
        kept = ("lo", "digest", "row") if n == 0 else ("lo",)

        def with_path(r: Column, i: Column) -> Column:
            path = F.concat(_siblings(F.col("levels"), i, F.col("height")), F.col("upper"))
            return F.struct(*(r[c].alias(c) for c in kept), path.alias("path"))  # noqa: B023

        given = slab.select("base", "top", F.inline(F.transform("rows", with_path)))
    return given


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and the siblings on its way give."""
    return F.aggregate(path, leaf, lambda node, s: digest(s["before"], node, s["after"]))


def proof_digest(path: Column) -> Column:
    return digest(F.array_join(F.transform(path, lambda s: F.concat(s["before"], s["after"])), ""))


def _ranked(rows: DataFrame) -> DataFrame:
    """Rows (group, key, leaf, now, id) with their rank ``lo``, and ``base`` and ``size`` of their group.

    What holds for a group is joined back by group and range of ranks, so a
    group with many rows is never one task's.
    """
    order = [F.col("group").asc_nulls_first(), F.col("key").asc_nulls_first(), F.col("leaf"), F.col("id")]
    ranked = numbered(rows, *order, place="lo").withColumn("part", F.expr(f"lo div {RANGE}L"))
    parts = ranked.groupBy("group", "part").agg(F.min("lo").alias("first"), F.count(F.lit(1)).alias("n"))
    groups = parts.groupBy(F.col("group").alias("g")).agg(F.min("first").alias("base"), F.sum("n").alias("size"))
    labels = save(parts.join(groups, F.col("group").eqNullSafe(F.col("g"))).select("g", F.col("part").alias("p"), "base", "size"), "merkle-groups")
    return ranked.join(labels, F.col("group").eqNullSafe(F.col("g")) & (F.col("part") == F.col("p"))).drop("g", "p", "part")


def build(rows: DataFrame) -> Manifest:
    """The manifest of ``leaves(...)``, written below the shared scratch root."""
    rows = save(rows.withColumn("id", F.monotonically_increasing_id()), "merkle-leaves")
    most = rows.groupBy("group").count().agg(F.coalesce(F.max("count"), F.lit(0))).first()[0]
    row = F.struct("group", "key", "now").alias("row")
    slabs, tops = _build(_ranked(rows).select("base", "size", "lo", F.col("leaf").alias("digest"), row), most)
    # The trees' tops, in the groups' order, which is that of their first ranks.
    upper = numbered(tops.select("digest", F.struct("base").alias("row")), "row", place="lo")
    count = upper.count()
    zero, size = (F.lit(x).cast("long") for x in (0, count))
    above, root = _build(upper.select(zero.alias("base"), size.alias("size"), "lo", "digest", "row"), count)
    return Manifest(slabs, tops, Manifest(above, root))


def proofs(manifest: Manifest) -> DataFrame:
    """Every leaf with its inclusion proof: group, key, leaf, now, subroot, root, path.

    ``path`` has, for each level from the leaf up to the root, the digests of
    the siblings before and after, joined. A group of one leaf has that leaf
    as its subroot, a manifest of one group its subroot as the root. Rows of
    equal key are ordered by digest; equal rows have a place each. Null
    groups and keys come first and are like any others; groups are ordered
    bytewise (UTF-8). An empty table gives an empty result.
    """
    none = F.array().cast("array<struct<before:string,after:string>>").alias("path")
    root = F.col("digest").alias("top")
    over = _paths(manifest.above.slabs, manifest.above.tops.select("base", root, none))
    over = save(over.select(F.col("row.base").alias("base"), F.struct(F.col("digest").alias("subroot"), F.col("top").alias("root")).alias("top"), "path"), "merkle-over")
    return _paths(manifest.slabs, over).select("row.group", "row.key", F.col("digest").alias("leaf"), "row.now", "top.*", "path")


def verified(proven: DataFrame) -> DataFrame:
    """Adds folded_root, from ``now`` and the proof, and whether it is the root."""
    return proven.withColumn("folded_root", folded(F.col("now"), F.col("path"))).withColumn("verified", F.col("folded_root") == F.col("root"))
