"""Substring search over the station catalogue by posting lists.

The index lists, for every character sequence of one to three characters,
the stations whose name or locality has it. A search reads the lists of the
needle's trigrams only (a shorter needle is a sequence itself), keeps the
stations that are in all of them, and tests those literally, so its result
is that of the scan.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airloom.operators.search import find_locations
from airloom.options import PARAMETER_ID
from airloom.storage import exists

GRAM = 3
BITS = 21  # of a code point
POSTINGS = "gram string, ids array<long>"


def _keys(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(key, number of the text) of all sequences of 1 to GRAM characters, repeats included;
    a key packs the code points, each plus one."""
    lengths = np.array([len(t) for t in texts], np.int64)
    points = np.frombuffer("".join(texts).encode("utf-32-le"), "<u4").astype(np.uint64) + np.uint64(1)
    text = np.repeat(np.arange(len(texts)), lengths)
    left = np.repeat(np.cumsum(lengths), lengths) - np.arange(len(points))  # characters from here on
    keys, key = [], np.zeros(len(points), np.uint64)
    for size in range(1, GRAM + 1):
        key = key << np.uint64(BITS)
        key[: len(points) - size + 1] |= points[size - 1 :]
        keys.append((key[left >= size], text[left >= size]))
    return np.concatenate([k for k, _ in keys]), np.concatenate([t for _, t in keys])


def _gram(key: int) -> str:
    points = [(key >> BITS * i) & ((1 << BITS) - 1) for i in reversed(range(GRAM))]
    return "".join(chr(p - 1) for p in points if p)


def _lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The posting lists of every batch of (id, name, locality); an id is in a list once per row."""
    for b in batches:
        if not b.num_rows:
            continue
        text = lambda c: [t.decode("utf-8", "replace") for t in b.column(c).cast(pa.binary()).to_pylist()]
        (names, of_name), (places, of_place) = _keys(text(1)), _keys(text(2))
        keys, place = np.unique(np.concatenate([names, places]), return_inverse=True)
        pairs = np.unique(place * b.num_rows + np.concatenate([of_name, of_place]))
        of, row = pairs // b.num_rows, pairs % b.num_rows
        offsets = np.searchsorted(of, np.arange(len(keys) + 1)).astype(np.int32)
        ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(b.column(0).to_numpy()[row]))
        yield pa.RecordBatch.from_arrays([pa.array([_gram(k) for k in keys.tolist()], pa.string()), ids], names=["gram", "ids"])


def postings(catalogue: DataFrame) -> DataFrame:
    """(gram, ids): for every short sequence of the lowered names and localities, the stations
    that have it, in lists of one batch of stations each."""
    texts = [F.lower(F.coalesce(F.col(c), F.lit(""))).alias(c) for c in ("name", "locality")]
    rows = catalogue.select(F.col("id").cast("bigint").alias("id"), *texts).where("id IS NOT NULL")
    tasks = int(catalogue.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartitionByRange(tasks, "id").mapInArrow(_lists, POSTINGS)


def write_postings(catalogue: DataFrame, root: str) -> None:
    """Write the index sorted by sequence, so that a search skips the lists of others.

    Stations are divided by id ranges, a file each: a sequence that a third
    of the stations have is spread over files, and no list is shuffled.
    """
    postings(catalogue).sortWithinPartitions("gram").write.mode("overwrite").parquet(root)


def _needed(needle: str) -> list[str]:
    text = needle.lower()
    if len(text) <= GRAM:
        return [text]
    return sorted({text[i : i + GRAM] for i in range(len(text) - GRAM + 1)})


def candidates(spark: SparkSession, root: str, needle: str) -> DataFrame:
    """(id): stations whose lists hold all sequences of ``needle`` (not empty)."""
    grams = _needed(needle)
    index = spark.read.schema(POSTINGS).parquet(root) if exists(spark, root) else spark.createDataFrame([], POSTINGS)
    lists = index.where(F.col("gram").isin(grams))  # the statistics of row groups and pages skip the rest
    hits = lists.select(F.explode("ids").alias("id"))
    return hits.groupBy("id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") == len(grams)).select("id")


def find_indexed(
    catalogue: DataFrame,
    root: str,
    country: str,
    search: str | None = None,
    limit: int | None = None,
    parameter_id: int = PARAMETER_ID,
) -> DataFrame:
    """``search.find_locations`` with the postings of ``catalogue`` at ``root``.

    The index must be of this catalogue; without a needle it is not read.
    """
    if not search:
        return find_locations(catalogue, country, search, limit, parameter_id)
    near = catalogue.join(candidates(catalogue.sparkSession, root, search), "id", "left_semi")
    return find_locations(near, country, search, limit, parameter_id)
