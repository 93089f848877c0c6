"""Shards by a k-d tree over document metadata (DataFrame functions only).

A node that stands for k shards is split where its bytes divide as k/2 to
the rest, along the metadata dimension that is widest in it. The weighted
median is found by histograms: all open nodes of a level share each pass,
whose result is one row per node, and the bin that holds the cut is refined
until it holds one coordinate. The finished tree (one cut fewer than
shards) is a nested CASE expression over the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from airloom.llm.common import save

BINS = 4096
CODE_BITS, TIE_BITS = 20, 40
ROWS_PER_WINDOW = 50_000
DIMS = ("source", "lang", "length")


def metadata(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, size, text_crc32 and one coordinate per dimension.

    A coordinate is a code of the metadata value and, below it, a hash of
    the row, so that any number of rows with one value can be divided. Rows
    that agree in everything are told apart by the lowest bits, which come
    from their place in the input.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    size = F.octet_length(text).cast("long") + F.lit(16)
    crc = F.crc32(text.cast("binary"))
    place = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(1 << 14))
    tie = F.shiftleft(F.pmod(F.xxhash64(F.col(id_col), crc, size), F.lit(1 << (TIE_BITS - 14))), 14) + place

    def code(c: Column) -> Column:
        return F.pmod(F.xxhash64(c), F.lit(1 << CODE_BITS))

    def own(name: str) -> Column:
        return F.col(name).cast("string") if name in docs.columns else F.lit(None).cast("string")

    log_size = F.least(F.floor(F.log2(size) * F.lit(1 << 14)), F.lit((1 << CODE_BITS) - 1))
    return docs.select(
        F.col(id_col).alias("doc_id"),
        size.alias("size"),
        crc.alias("text_crc32"),
        tie.alias("tie"),
        code(own("source")).alias("source"),
        code(own("lang")).alias("lang"),
        log_size.alias("length"),
    ).withColumns({d: F.shiftleft(F.col(d).cast("long"), TIE_BITS) + F.col("tie") for d in DIMS})


def _assign(tree: dict, node: int) -> Column:
    if node not in tree:
        return F.lit(node)
    dim, cut, left, right = tree[node]
    return F.when(F.col(dim) < F.lit(cut), _assign(tree, left)).otherwise(_assign(tree, right))


def _rows(spark: SparkSession, names: str, rows: list[tuple]) -> DataFrame:
    """A row per node, from literals; broadcast, as there are fewer than shards."""
    values = ", ".join(f"({', '.join(map(repr, r))})" for r in rows)
    return F.broadcast(spark.sql(f"SELECT * FROM VALUES {values} AS t({names})"))


def kd_tree(meta: DataFrame, shards: int) -> tuple[dict, dict[int, int], int]:
    """(cuts by node, shard by leaf, rows). The driver sees a row per node and pass."""
    spark = meta.sparkSession
    tree: dict[int, tuple] = {}
    span = {0: (0, shards)}  # node -> its shards
    root, rows, nodes = None, 0, 1
    open_nodes = [0] if shards > 1 else []
    if not open_nodes:
        rows = meta.count()
    while open_nodes:
        at = meta.withColumn("node", _assign(tree, 0))
        stats = {
            r["node"]: r
            for r in at.join(_rows(spark, "node", [(n,) for n in open_nodes]), "node")
            .groupBy("node")
            .agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows"), *(f(d).alias(f"{n}_{d}") for d in DIMS for n, f in (("lo", F.min), ("hi", F.max))))
            .collect()
        }
        if root is None:
            if 0 not in stats:
                break
            root = {d: max(1, stats[0][f"hi_{d}"] - stats[0][f"lo_{d}"]) for d in DIMS}
            rows = stats[0]["rows"]
        search = {}
        for node in open_nodes:
            if node in stats:
                s, k = stats[node], span[node][1]
                dim = max(DIMS, key=lambda d: ((s[f"hi_{d}"] - s[f"lo_{d}"]) / root[d], -DIMS.index(d)))
                search[node] = {"dim": dim, "lo": s[f"lo_{dim}"], "hi": s[f"hi_{dim}"], "below": 0, "target": s["bytes"] * (k // 2) / k, "cut": None}
        while todo := {n: s for n, s in search.items() if s["cut"] is None}:
            bins = _rows(
                spark,
                "node, dim, lo, hi, width, below, target",
                [(n, DIMS.index(s["dim"]), s["lo"], s["hi"], (s["hi"] - s["lo"]) // BINS + 1, s["below"], float(s["target"])) for n, s in todo.items()],
            )
            x = F.when(F.col("dim") == 0, F.col(DIMS[0])).when(F.col("dim") == 1, F.col(DIMS[1])).otherwise(F.col(DIMS[2]))
            crossing = (
                at.join(bins, "node")
                .withColumn("x", x)
                .filter(F.col("x").between(F.col("lo"), F.col("hi")))
                .groupBy("node", "below", "target", F.expr("(x - cast(lo as bigint)) div width").alias("bin"))
                .agg(F.sum("size").alias("bytes"), F.min("x").alias("first"), F.max("x").alias("last"))
                .withColumn("upto", F.sum("bytes").over(Window.partitionBy("node").orderBy("bin")))
                .filter(F.col("below") + F.col("upto") >= F.col("target").cast("double"))
                .groupBy("node")
                .agg(F.min_by(F.struct("bytes", "upto", "first", "last"), "bin").alias("c"))
                .collect()
            )
            for r in crossing:
                s, c = search[r["node"]], r["c"]
                before = s["below"] + c["upto"] - c["bytes"]
                if c["first"] == c["last"]:
                    nearer_with = s["below"] + c["upto"] - s["target"] <= s["target"] - before
                    s["cut"] = c["first"] + 1 if nearer_with else c["first"]
                else:
                    s["lo"], s["hi"], s["below"] = c["first"], c["last"], before
        following = []
        for node in open_nodes:
            first, k = span[node]
            s = search.get(node, {"dim": DIMS[0], "cut": 0})
            tree[node] = (s["dim"], s["cut"], nodes, nodes + 1)
            span[nodes], span[nodes + 1] = (first, k // 2), (first + k // 2, k - k // 2)
            following += [n for n in (nodes, nodes + 1) if span[n][1] > 1]
            nodes += 2
        open_nodes = following
    return tree, {n: first for n, (first, _) in span.items() if n not in tree}, rows


def shard(docs: DataFrame, shards: int = 40, target_bytes: int | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row in one of ``shards`` shards of nearly equal bytes.

    Returns doc_id, size, text_crc32, law (``bytes``), shard, slot (its
    gapless place in the shard) and grown_shard (null under this law). With
    ``target_bytes`` the number of shards follows from the bytes instead.
    Size is the text's UTF-8 bytes plus 16; a null text counts as empty. A
    value of a dimension that fills more than a shard, and a group of equal
    texts, are divided where the bytes ask for it. An empty table gives an
    empty result; with fewer rows than shards some shards stay empty. A null
    doc_id, source or lang is a value like any other; other columns are left
    out. Repeated rows each get a slot.
    """
    meta = save(metadata(docs, id_col, text_col), "shard-metadata")
    if target_bytes:
        total = meta.agg(F.sum("size")).first()[0] or 0
        shards = max(1, -(-total // target_bytes))
    tree, leaf, rows = kd_tree(meta, shards)
    split = max(1, rows // (shards * ROWS_PER_WINDOW))
    placed = meta.withColumn("node", _assign(tree, 0)).select(
        "doc_id",
        "size",
        "text_crc32",
        "tie",
        F.create_map(*(F.lit(x) for kv in sorted(leaf.items()) for x in kv))[F.col("node")].cast("int").alias("shard"),
        F.expr(f"cast((tie * {split}) div {1 << TIE_BITS} as int)").alias("sub"),
    )
    counts = placed.groupBy("shard", "sub").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("shard").orderBy("sub").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("_before", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    within = Window.partitionBy("shard", "sub").orderBy("tie", "doc_id")
    return (
        placed.withColumn("_at", F.row_number().over(within) - 1)
        .join(offsets, ["shard", "sub"])
        .select(
            "doc_id",
            "size",
            "text_crc32",
            F.lit("bytes").alias("law"),
            "shard",
            (F.col("_before") + F.col("_at")).cast("long").alias("slot"),
            F.lit(None).cast("int").alias("grown_shard"),
        )
    )
