"""Places of rows in a total order, without bringing them into one task."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from airloom.session import scratch_path

_ROWS = (1 << 33) - 1  # the low bits of monotonically_increasing_id: the row in its partition


def _sorted(df: DataFrame, ways: Sequence[Column | str]) -> DataFrame:
    """``df`` sorted by ranges and written once below the shared scratch root, so that
    places do not change when a task is run again; with ``_at``, which numbers the rows
    of a partition in its low bits and the partitions in the others."""
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = scratch_path(spark, "ordered")
    ranged = df.repartitionByRange(n, *ways).sortWithinPartitions(*ways)
    at = ranged.withColumn("_at", F.monotonically_increasing_id())
    at.write.parquet(path)
    return spark.read.schema(at.schema).parquet(path).withColumn("_part", F.shiftright("_at", 33).cast("int"))


def _with_offsets(at: DataFrame, amount: Column) -> DataFrame:
    """Adds ``_first``: what all partitions before this one hold of ``amount``.

    The driver sees one number per partition, at most ``spark.sql.shuffle.partitions``.
    """
    held = dict(at.groupBy("_part").agg(amount.alias("n")).collect())
    last = max(held, default=-1)
    firsts = accumulate((held.get(i) or 0 for i in range(last + 1)), initial=0)
    offsets = at.sparkSession.createDataFrame(list(enumerate(firsts))[: last + 1], "_part int, _first long")
    return at.join(F.broadcast(offsets), "_part")


def numbered(df: DataFrame, *order: Column | str, place: str = "place") -> DataFrame:
    """``df`` with each row's place (BIGINT from 0) in the given order.

    Rows are range-partitioned and sorted, which numbers them within their
    partition; a partition's first place is the sum of the counts before it.
    Rows that the order does not tell apart are numbered in any way, and
    those of one range stay together: to spread a frequent value over tasks,
    give a further column that divides it.
    """
    at = _with_offsets(_sorted(df, order), F.count(F.lit(1)))
    row = F.col("_first") + F.col("_at").bitwiseAND(F.lit(_ROWS))
    return at.withColumn(place, row).drop("_part", "_first", "_at")


def with_sum_before(df: DataFrame, value: str, *order: Column | str, out: str = "before") -> DataFrame:
    """``df`` with the sum of ``value`` over all rows before each row in the given order (0
    for the first): prefix sums within the ranges, and of the ranges' sums."""
    at = _with_offsets(_sorted(df, order), F.sum(value))
    inside = Window.partitionBy("_part").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    before = F.col("_first") + F.coalesce(F.sum(value).over(inside), F.lit(0))
    return at.withColumn(out, before).drop("_part", "_first", "_at")
