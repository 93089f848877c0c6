"""Readers for landed API page envelopes ``{"results": [...]}``.

The HTTP pager is not rebuilt; its pages are data. A page frame has one
row per fetched page: the page number, optional fetch-group columns (run,
sensor, location) and the page text or parsed envelope.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airloom.operators.ordering import with_sum_before
from airloom.options import PAGE_SIZE_CAP
from airloom.sources.raw import JSON_OPTIONS


def parse_envelope(df: DataFrame, text_col: str, schema: T.StructType, alias: str = "env"):
    """Parse page text into the declared envelope struct (never inferred)."""
    return df.withColumn(alias, F.from_json(F.col(text_col), schema, JSON_OPTIONS)).drop(text_col)


def read_landed_pages(
    spark: SparkSession, root: str, envelope: T.StructType, keys: list[tuple[str, T.DataType]]
) -> DataFrame:
    """Landed pages, one JSON object per line: ``{<keys>..., "results": [...]}``.

    Returns the key columns and the envelope as JSON text, the shape the
    page operators take (``parse_envelope`` parses it with its schema).
    """
    schema = T.StructType([T.StructField(k, t) for k, t in keys] + envelope.fields)
    df = spark.read.options(**JSON_OPTIONS).schema(schema).json(root)
    return df.select(*(k for k, _ in keys), F.to_json(F.struct("results")).alias("text"))


def explode_pages(
    pages: DataFrame,
    results: str = "env.results",
    page_col: str = "page",
    group_cols: Sequence[str] = (),
    page_size: int | None = None,
    limit: int | None = None,
) -> DataFrame:
    """Concatenate page results in (page, position) order.

    ``page_size``: a fetch stops at its first page holding fewer results
    than ``page_size`` (that page is kept) or at an empty page; later pages
    of the same fetch are ignored. Pages are numbered 1..n without gaps, as
    a fetch lands them. ``limit``: keep the first ``limit``
    results of each fetch. Output: group columns, ``page``, ``pos``,
    ``result``.
    """
    group_cols = list(group_cols)
    n = F.size(F.col(results))
    if page_size is not None:
        short = F.when(n < F.lit(page_size), F.col(page_col))
        if group_cols:
            stops = pages.groupBy(*group_cols).agg(F.min(short).alias("_stop"))
            pages = pages.join(stops, group_cols).where(
                F.col("_stop").isNull() | (F.col(page_col) <= F.col("_stop"))
            ).drop("_stop")
        else:
            # One value for the whole input: a scalar subquery, no join.
            stop = pages.agg(F.min(short)).scalar()
            pages = pages.where(stop.isNull() | (F.col(page_col) <= stop))
    rows = pages.select(
        *group_cols,
        F.col(page_col).alias("page"),
        F.posexplode(F.col(results)).alias("pos", "result"),
    ).withColumn("pos", F.col("pos").cast("bigint"))
    if limit is None:
        return rows
    if group_cols:
        # row_number() <= limit gets a partial WindowGroupLimit before the
        # shuffle, so a large fetch group ships at most ``limit`` rows per task.
        w = Window.partitionBy(*group_cols).orderBy("page", "pos")
        return rows.withColumn("_rn", F.row_number().over(w)).where(
            F.col("_rn") <= limit
        ).drop("_rn")
    return rows.orderBy("page", "pos").limit(limit)


def results_of(texts: DataFrame, envelope: T.StructType, limit: int | None = None) -> DataFrame:
    """Results of one fetch from its page texts (page, text), as ``explode_pages``.

    All up to the short or empty page, or the first ``limit``. With a limit
    the pages are counted by the lengths of their arrays, without building a
    result; prefix sums over the pages in order tell which of them the limit
    reaches, and only those are parsed. Pages of a limited fetch hold
    ``min(limit, PAGE_SIZE_CAP)`` results.
    """
    if limit is None:
        return latest_readings(parse_envelope(texts, "text", envelope))
    size = min(limit, PAGE_SIZE_CAP)
    n = F.coalesce(F.json_array_length(F.get_json_object("text", "$.results")), F.lit(0))
    counts = texts.select("page", n.cast("bigint").alias("n"))
    placed = with_sum_before(counts, "n", "page")
    stop = placed.where(F.col("n") < size).agg(F.min("page")).first()[0]
    if stop is not None:
        placed = placed.where(F.col("page") <= stop)
    last = placed.where(F.col("before") < limit).agg(F.max_by(F.struct("page", "before"), "page")).first()[0]
    if last is None:  # no page, or a limit of nothing
        return explode_pages(parse_envelope(texts.limit(0), "text", envelope))
    reached = parse_envelope(texts.where(F.col("page") <= last["page"]), "text", envelope)
    rest = limit - last["before"]
    return explode_pages(reached).where((F.col("page") < last["page"]) | (F.col("pos") < rest))


def latest_readings(pages: DataFrame, limit: int | None = None) -> DataFrame:
    """Results of a latest-readings fetch, up to its short or empty page.

    All results without a ``limit``; with one the first ``limit``, fetched in
    pages of ``min(limit, PAGE_SIZE_CAP)`` (the API cap).
    """
    return explode_pages(pages, page_size=min(limit or PAGE_SIZE_CAP, PAGE_SIZE_CAP), limit=limit)
