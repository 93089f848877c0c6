"""Benchmark decontamination by greedy string tiling.

Documents and benchmark items are compared as lower-cased word tokens. A
pair is a candidate when it shares a seed of ``min_match`` tokens; the seeds
of an item that are rarest in the benchmark suffice, as too few others
remain to reach the threshold without them. Each candidate pair is tiled: the
longest matches that do not overlap in either text are marked again and
again, found by running Karp-Rabin hashing. Coverage is the tiled share of
the item, so a reordered passage is caught as well.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from airloom.llm.common import save, small_batches

FILTER_BITS = 26  # size of the seed filter in every task: 2**26 bits, whatever the benchmark
FIRST_LENGTH = 20  # first search length of the tiling
BASE = np.uint64(0x9E3779B97F4A7C15)
_TOKEN = re.compile(r"\w+")


def tokens(text: str | None) -> list[str]:
    return _TOKEN.findall((text or "").lower())


def token_hashes(words: list[str]) -> np.ndarray:
    h = xxhash.xxh3_64_intdigest
    return np.array([h(w) for w in words], dtype=np.uint64)


def rolling(h: np.ndarray, length: int) -> np.ndarray:
    """Karp-Rabin hashes of all windows of ``length`` values."""
    n = len(h) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for i in range(length):
        out = out * BASE + h[i : i + n]
    return out ^ (out >> np.uint64(29))


class Tiling:
    """Greedy string tiling of one pattern and one text (arrays of token hashes)."""

    def __init__(self, pattern: np.ndarray, text: np.ndarray, min_match: int):
        self.p, self.t, self.least = pattern, text, min_match
        self.free_p, self.free_t = np.ones(len(pattern), bool), np.ones(len(text), bool)
        self.tiles: list[tuple[int, int, int]] = []

    @staticmethod
    def _windows(h: np.ndarray, free: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Starts and hashes of the windows without a marked token."""
        r = rolling(h, length)
        taken = np.concatenate(([0], np.cumsum(~free)))
        starts = np.flatnonzero(taken[length : length + len(r)] == taken[: len(r)])
        return starts, r[starts]

    def _scan(self, length: int) -> list[tuple[int, int, np.ndarray]]:
        """Longest matches of at least ``length`` as (length, place in pattern, places in text).

        Windows of equal hash on one diagonal, one after another, are one
        match. The pattern's places are taken from the last to the first, each
        with all its places in the text at once, so the work is one array
        operation for each of them, on repetitive texts too.
        """
        at_p, hash_p = self._windows(self.p, self.free_p, length)
        at_t, hash_t = self._windows(self.t, self.free_t, length)
        order = np.argsort(hash_t, kind="stable")
        at_t, hash_t = at_t[order], hash_t[order]
        left, right = np.searchsorted(hash_t, hash_p), np.searchsorted(hash_t, hash_p, side="right")
        run = np.zeros(len(self.t) + 1, np.int64)  # windows that follow at each place of the text
        last, last_i, found = np.zeros(0, np.int64), -1, []

        def begins(i: int, here: np.ndarray) -> None:
            found.extend((int(n) + length - 1, i, here[run[here] == n]) for n in np.unique(run[here]))

        for k in np.flatnonzero(right > left)[::-1]:
            i, here = int(at_p[k]), at_t[left[k] : right[k]]
            if i + 1 == last_i:
                follow = run[here + 1] + 1
                continued = np.zeros(len(self.t) + 1, bool)
                continued[here + 1] = True
                begins(last_i, last[~continued[last]])
            else:
                begins(last_i, last)
                follow = np.ones(len(here), np.int64)
            run[last] = 0
            run[here] = follow
            last, last_i = here, i
        begins(last_i, last)
        return found

    def _mark(self, found: list[tuple[int, int, np.ndarray]]) -> bool:
        marked = False
        for n, i, places in sorted(found, key=lambda x: (-x[0], x[1])):
            if not self.free_p[i : i + n].all():
                continue
            taken = np.concatenate(([0], np.cumsum(~self.free_t)))
            free = places[taken[places + n] == taken[places]]
            if len(free):
                j = int(free[0])
                self.free_p[i : i + n] = self.free_t[j : j + n] = False
                self.tiles.append((i, j, n))
                marked = True
        return marked

    def run(self) -> list[tuple[int, int, int]]:
        """Tiles as (place in pattern, place in text, length)."""
        length = max(self.least, min(FIRST_LENGTH, len(self.p)))
        while True:
            found = self._scan(length)
            longest = max((n for n, _, _ in found), default=0)
            if longest > 2 * length:
                length = longest
                continue
            marked = self._mark(found)
            if length > 2 * self.least:
                length //= 2
            elif length > self.least:
                length = self.least
            elif not marked:
                return self.tiles


def _item_seeds(items: DataFrame, min_match: int, threshold: float) -> DataFrame:
    """(item_id, seed) of the rarest seeds that every sufficient match must touch."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for item, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                h = token_hashes(tokens(text))
                need = -(-threshold * len(h) // min_match)
                keep = len(h) - min_match + 1 - max(1, int(need)) + 1
                rows += [(item, i, int(s), keep) for i, s in enumerate(rolling(h, min_match).view(np.int64))]
            columns = list(zip(*rows)) if rows else [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["item_id", "at", "seed", "keep"])

    seeds = items.mapInArrow(work, "item_id long, at long, seed long, keep long")
    seeds = seeds.join(seeds.groupBy("seed").agg(F.count(F.lit(1)).alias("df")), "seed")
    rank = F.row_number().over(Window.partitionBy("item_id").orderBy("df", "at"))
    return save(seeds.withColumn("rank", rank).filter("rank <= keep").select("item_id", "seed").distinct(), "benchmark-seeds")


def _seed_filter(seeds: DataFrame) -> np.ndarray:
    """A bitmap of the seeds: two bits each, of a size that does not depend on their number."""
    at = F.explode(F.array(F.expr(f"seed & {2**FILTER_BITS - 1}"), F.expr(f"shiftrightunsigned(seed, 32) & {2**FILTER_BITS - 1}")))
    words = seeds.select(at.alias("b")).groupBy(F.expr("b div 8").alias("i")).agg(F.expr("bit_or(shiftleft(1, cast(b % 8 as int)))").alias("bits")).toArrow()
    bitmap = np.zeros(2**FILTER_BITS // 8, np.uint8)
    bitmap[words.column("i").to_numpy()] = words.column("bits").to_numpy()
    return bitmap


def contaminated(docs: DataFrame, benchmark: DataFrame, min_match: int = 5, threshold: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per document and benchmark item whose coverage reaches ``threshold``.

    Returns doc_id, item_id, item_tokens, matched_tokens, coverage, tiles
    and longest (tokens of the longest tile). Items of fewer than
    ``min_match`` tokens cannot be judged and match nothing. Null texts
    count as empty and match nothing; a document without match has no row. A
    null doc_id or item_id is returned as null. Repeated rows are reported
    as often as they come, each item once per row; other columns are left
    out; empty tables give an empty result.
    """
    spark = docs.sparkSession
    small_batches(spark)
    items = benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string").alias("item_text")).withColumn("item_key", F.xxhash64("item_id", "item_text"))
    seeds = _item_seeds(items.select("item_key", "item_text").distinct(), min_match, threshold)
    bitmap = spark.sparkContext.broadcast(_seed_filter(seeds))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, mask = bitmap.value, np.uint64(2**FILTER_BITS - 1)
        row = TaskContext.get().partitionId() << 40

        def has(at: np.ndarray) -> np.ndarray:
            return (bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1

        for b in batches:
            rows = []
            for doc, text in zip(b.column(0).to_pylist(), b.column(1)):
                row += 1
                text = text.as_py()
                r = rolling(token_hashes(tokens(text)), min_match)
                hit = r[has(r & mask)]
                hit = np.unique(hit[has((hit >> np.uint64(32)) & mask)])
                if len(hit):
                    rows.append((row, doc, text, hit.view(np.int64).tolist()))
            columns = list(zip(*rows)) if rows else [[]] * 4
            types = (pa.int64(), pa.int64(), pa.string(), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["row", "doc_id", "text", "seeds"])

    found = save(
        docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(find, "row long, doc_id long, text string, seeds array<long>"),
        "seeded-documents",
    )
    pairs = found.select("row", F.explode("seeds").alias("seed")).join(seeds, "seed").select("row", F.col("item_id").alias("item_key")).distinct()

    def tile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows, held = [], (None, None)
            for row, doc, text, item, item_text in zip(*(b.column(i).to_pylist() for i in range(5))):
                if held[0] != row:
                    held = (row, token_hashes(tokens(text)))
                p = token_hashes(tokens(item_text))
                tiles = Tiling(p, held[1], min_match).run()
                n = sum(x[2] for x in tiles)
                if n >= threshold * len(p):
                    rows.append((doc, item, len(p), n, n / len(p), len(tiles), max(x[2] for x in tiles)))
            columns = list(zip(*rows)) if rows else [[]] * 7
            kinds = (pa.int64(),) * 4 + (pa.float64(), pa.int32(), pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["doc_id", "item_id", "item_tokens", "matched_tokens", "coverage", "tiles", "longest"])

    return (
        found.select("row", "doc_id", "text")
        .join(pairs, "row")
        .join(items.distinct(), "item_key")
        .select("row", "doc_id", "text", "item_id", "item_text")
        .mapInArrow(tile, "doc_id long, item_id long, item_tokens long, matched_tokens long, coverage double, tiles int, longest int")
    )
