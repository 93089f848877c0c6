"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from airloom.session import scratch_path

FILTER_BITS = 26  # size of an id filter in every task, whatever the input
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def save(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once below ``spark.checkpoint.dir`` and read it back.

    The written table cuts the lineage and is visible to every executor, so
    a lost executor costs only its running tasks.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


# Rows of an Arrow batch of texts: a batch is held in a task's memory several times over.
BATCH_ROWS = 1000


def small_batches(spark: SparkSession) -> None:
    """Hand texts to Python in batches of BATCH_ROWS rows (a setting of the session)."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def partitions(spark: SparkSession) -> int:
    """The session's number of shuffle partitions."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(col):
    """A-Z to a-z; every other character stays."""
    return F.translate(col, UPPER, LOWER)


def text_bytes(array: pa.Array) -> list[bytes]:
    """A string column as UTF-8 bytes; null counts as empty."""
    return [x or b"" for x in array.cast(pa.binary()).to_pylist()]


def grouped_rows(batches: Iterable[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Runs of equal ``key`` from batches sorted by it, whole runs at a time.

    Yields tables that hold one or more complete runs; only the run that a
    batch breaks off is held until the next batch.
    """
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(batch.schema.get_field_index(key)).to_numpy(zero_copy_only=False)
        first = held[0].column(held[0].schema.get_field_index(key))[0].as_py() if held else None
        if held and keys[-1] == first:
            held.append(batch)
            continue
        last = int(np.flatnonzero(keys != keys[-1])[-1]) + 1 if keys[0] != keys[-1] else 0
        done = [*held, batch.slice(0, last)] if last else held
        if done:
            yield pa.Table.from_batches(done)
        held = [batch.slice(last)]
    if held:
        yield pa.Table.from_batches(held)


def runs(keys: np.ndarray) -> np.ndarray:
    """Bounds of the runs of equal neighbours: run i is [b[i], b[i + 1])."""
    if not len(keys):
        return np.zeros(1, dtype=np.int64)
    return np.concatenate(([0], np.flatnonzero(keys[1:] != keys[:-1]) + 1, [len(keys)]))


def id_filter(ids: DataFrame, doc_id: Column) -> Column:
    """A condition on ``doc_id`` that holds for all of ``ids`` (one column, doc_id) and for few others.

    A bitmap of fixed size: it grows with nothing and only saves shuffles,
    the joins behind it decide. Null ids do not hold.
    """

    def bit(c: Column) -> Column:
        return F.pmod(F.xxhash64(c), F.lit(1 << FILTER_BITS))

    words = ids.select(bit(F.col("doc_id")).alias("b")).groupBy(F.expr("b div 64").alias("i")).agg(F.expr("bit_or(shiftleft(1L, cast(b % 64 as int)))").alias("bits")).toArrow()
    bitmap = np.zeros(1 << (FILTER_BITS - 6), np.int64)
    bitmap[words.column("i").to_numpy()] = words.column("bits").to_numpy()
    sent = ids.sparkSession.sparkContext.broadcast(bitmap)

    @F.pandas_udf("boolean")
    def test(b: pd.Series) -> pd.Series:
        at = b.to_numpy()
        return pd.Series((sent.value[at >> 6] >> (at & 63)) & 1 == 1)

    return test(bit(doc_id)) & doc_id.isNotNull()


def blocks(rows: int, size: int) -> int:
    return max(1, math.ceil(rows / size))
