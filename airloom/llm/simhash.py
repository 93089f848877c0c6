"""SimHash near-duplicates, linked through the anchors of a covering code.

Two fingerprints that differ in at most 3 of 64 bits differ in at most one
bit of one of their 32-bit halves. The anchors of a half are the code words
of the perfect Hamming code on 31 bits with the last bit free: every half
lies within one bit (the covering radius) of its nearest anchor. A half is
sent to every anchor within radius plus one, at most 17 of them. Of two
halves one bit apart, the second reaches the first one's nearest anchor, so
every pair within the distance meets at an anchor where one of them is at
home. Per anchor each home fingerprint is compared with all that came.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airloom.llm.common import grouped_rows, partitions, runs, save, small_batches, text_bytes
from airloom.llm.components import components

SEED = 42
MAX_BITS = 3  # one bit in one half
BYTE_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)
HASHES_AT_ONCE = 1 << 20


def fingerprint(text: bytes, shingle: int = 3) -> int:
    """64-bit SimHash of a text's lower-cased word shingles, repeats included.

    Words are runs of bytes other than ASCII white space; fewer words than a
    shingle make one shingle, none the fingerprint 0. A bit is set when more
    than half of the XXH64 values (seed 42) have it.
    """
    words = text.lower().split()  # bytes: only A-Z change and only ASCII blanks divide
    if not words:
        return 0
    h, n = xxhash.xxh64_intdigest, max(1, len(words) - shingle + 1)
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, n, HASHES_AT_ONCE):
        part = words[at : at + HASHES_AT_ONCE + shingle - 1] if len(words) > shingle else words
        grams = map(b" ".join, zip(*(part[i:] for i in range(shingle)))) if len(words) > shingle else [b" ".join(words)]
        counts += bit_counts(np.array([h(g, SEED) for g in grams], dtype=np.uint64))
    return int(np.packbits(counts * 2 > n, bitorder="little").view(np.uint64)[0])


def bit_counts(hashes: np.ndarray) -> np.ndarray:
    """How many of the values have each of the 64 bits, lowest first."""
    octets = hashes.astype("<u8").view(np.uint8).reshape(-1, 8)
    if len(hashes) < 64:
        return np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return np.concatenate([np.bincount(octets[:, i], minlength=256) @ BYTE_BITS for i in range(8)])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """(doc_id, fp) of every row; fp is the fingerprint as a signed long."""

    small_batches(docs.sparkSession)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.fromiter((fingerprint(t, shingle) for t in text_bytes(b.column(1))), np.uint64, b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp.view(np.int64))], names=["doc_id", "fp"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string")).mapInArrow(work, "doc_id long, fp long")


def print_of(text: Column, shingle: int = 3) -> Column:
    """The fingerprint of a text as a signed long, as ``fingerprints`` gives it."""

    @F.pandas_udf("long")
    def made(texts: pd.Series) -> pd.Series:
        fp = np.fromiter((fingerprint(t.encode() if isinstance(t, str) else b"", shingle) for t in texts), np.uint64, len(texts))
        return pd.Series(fp.view(np.int64))

    return made(text.cast("string"))


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Syndrome of each byte at each place (31 positions; the top bit is free), and
    for each syndrome the 15 pairs of positions whose sum it is, as bit masks."""
    position = np.where(np.arange(32) < 31, np.arange(32) + 1, 0)
    syndrome = np.zeros((4, 256), dtype=np.uint8)
    for place in range(4):
        for value in range(256):
            bits = [position[8 * place + i] for i in range(8) if value >> i & 1]
            syndrome[place, value] = np.bitwise_xor.reduce(bits) if bits else 0
    pairs = np.zeros((32, 15), dtype=np.uint32)
    for s in range(1, 32):
        pairs[s] = [(1 << (i - 1)) | (1 << (i ^ s) - 1) for i in range(1, 32) if i < i ^ s]
    return syndrome, pairs


COMPARISONS = 1 << 26  # of one block of an anchor
SYNDROME, PAIRS = _tables()
TOP = np.uint32(1 << 31)


def anchors(half: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, anchor) for all anchors within 2 bits of each 32-bit value; the first len(half) are the nearest ones."""
    o = half.astype("<u4").view(np.uint8).reshape(-1, 4)
    s = SYNDROME[0][o[:, 0]] ^ SYNDROME[1][o[:, 1]] ^ SYNDROME[2][o[:, 2]] ^ SYNDROME[3][o[:, 3]]
    fix = np.where(s > 0, np.uint32(1) << (np.maximum(s, 1) - 1).astype(np.uint32), np.uint32(0)).astype(np.uint32)
    nearest = half ^ fix
    rows = np.arange(len(half))
    off = rows[s > 0]
    far = (half[off][:, None] ^ PAIRS[s[off]]).ravel()
    return np.concatenate([rows, rows, np.repeat(off, 15)]), np.concatenate([nearest, nearest ^ TOP, far])


def _replicate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        fp = b.column(0).to_numpy().view(np.uint64)
        for at in range(0, len(fp), 4096):
            part = fp[at : at + 4096]
            for side in (0, 1):
                rows, anchor = anchors(((part >> np.uint64(32 * side)) & np.uint64(0xFFFFFFFF)).astype(np.uint32))
                home = np.arange(len(rows)) < len(part)
                key = anchor.astype(np.int64) | (side << 32)
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(part[rows].view(np.int64)), pa.array(home)], names=["key", "fp", "home"])


def _links(fp: np.ndarray, home: np.ndarray, bits: int) -> tuple[list, list]:
    """A spanning forest of the links within one anchor's fingerprints."""
    label = np.arange(len(fp))
    for i in np.flatnonzero(home):
        near = np.bitwise_count(fp ^ fp[i]) <= bits
        found = np.unique(label[near])
        if len(found) > 1:
            label[np.isin(label, found[1:])] = found[0]
    other = np.flatnonzero(label != np.arange(len(fp)))
    return fp[label[other]], fp[other]


def near_links(fps: DataFrame, bits: int = 3) -> DataFrame:
    """(u, v) links that connect all fingerprints at ``bits`` or fewer differing bits.

    ``fps`` holds each fingerprint once (column fp). The result connects the
    same fingerprints as all links would, with at most one row per
    fingerprint and block of an anchor. A task holds one block: the anchor's
    fingerprints, some of them at home, of which each is compared with all.
    An anchor has as many blocks as its comparisons need at COMPARISONS each,
    so a large group of lightly edited copies is spread over tasks.
    """
    if not 0 <= bits <= MAX_BITS:
        raise ValueError(f"bits must be 0 to {MAX_BITS}")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in grouped_rows(batches, "key"):
            key, fp, home = (t.column(i).to_numpy() for i in range(3))
            fp = fp.view(np.uint64)
            bounds = runs(key)
            shared = np.flatnonzero(np.diff(bounds) > 1)
            left, right = [], []
            for i in shared:
                at = slice(bounds[i], bounds[i + 1])
                if home[at].any():
                    u, v = _links(fp[at], home[at], bits)
                    left.append(u)
                    right.append(v)
            if left:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x).view(np.int64)) for x in (left, right)], names=["u", "v"])

    n = partitions(fps.sparkSession)
    spread = fps.mapInArrow(_replicate, "key long, fp long, home boolean")
    work = F.count(F.lit(1)) * F.count_if("home")
    large = spread.groupBy("key").agg(F.ceil(work / COMPARISONS).alias("blocks")).filter("blocks > 1")
    divided = spread.join(save(large, "large-anchors"), "key", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    own = F.pmod(F.xxhash64("fp"), "blocks")
    each = divided.withColumn("own", own).withColumn("block", F.explode(F.expr("sequence(0L, blocks - 1)")))
    # The block's number stands above the 33 bits of the anchor.
    key = F.col("key") + F.shiftleft("block", 34)
    return (
        each.select(key.alias("key"), "fp", (F.col("home") & (F.col("block") == F.col("own"))).alias("home"))
        .repartition(n, "key")
        .sortWithinPartitions("key")
        .mapInArrow(compare, "u long, v long")
        .distinct()
    )


def clusters(docs: DataFrame, bits: int = 3, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fp, root and component_id of every row, as ``near_duplicates`` states them.

    ``root`` is a component's own key: components of rows that share a
    doc_id may have the same component_id.
    """
    prints = save(fingerprints(docs, id_col, text_col, shingle), "simhash-prints")
    first = save(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash-classes")
    roots = components(near_links(first.select("fp"), bits)).select(F.col("node").alias("fp"), "root")
    named = first.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = named.groupBy("root").agg(F.min("first").alias("component_id"))
    classes = named.join(least, "root").select("fp", "root", "component_id")
    return prints.join(classes, "fp").select("doc_id", "fp", "root", "component_id")


def near_duplicates(docs: DataFrame, bits: int = 3, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id of every row.

    Rows whose fingerprints differ in at most ``bits`` bits are linked;
    component_id is the least doc_id that links reach. A null text counts as
    empty, and all texts without words share the fingerprint 0 and are
    linked like any others. A row with a null doc_id keeps its place in its
    component but never names it: a component of such rows alone has a null
    component_id. Repeated rows are returned as often as they come; other
    columns are left out; an empty table gives an empty result.
    """
    rows = clusters(docs, bits, shingle, id_col, text_col)
    return rows.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
