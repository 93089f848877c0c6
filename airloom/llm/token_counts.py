"""Token counts as rollups that signed deltas maintain.

A batch of inserts (+1), deletes (-1) and revised counts (a delete of the
old count and an insert of the new) is reduced to one delta row per key
(source, language, tokenizer version) and committed once under its batch id.
Totals are the sums of the committed deltas; they never read the documents
again.
"""

from __future__ import annotations

import re
import time
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from airloom.llm.common import small_batches
from airloom.llm.tokens import default_vocabulary, encoder, parts
from airloom.storage import delete, exists, folders

KEYS = ["source", "lang", "tokenizer"]
WORD = r"[^\x20\x09-\x0D]+"


def count_tokens(docs: DataFrame, vocabulary: str | None = None, text_col: str = "text", out: str = "tokens") -> DataFrame:
    """``docs`` with the number of BPE ids of the whole text; null counts as empty."""
    small_batches(docs.sparkSession)
    vocabulary = vocabulary or default_vocabulary()
    kept = [c for c in docs.columns if c not in (out, text_col)]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary)
        for b in batches:
            n = [encode.count(t) for _, texts in parts(b.column(len(kept))) for t in texts]
            yield pa.RecordBatch.from_arrays([*b.columns[: len(kept)], pa.array(n, pa.int64())], names=[*kept, out])

    schema = docs.select(*kept).withColumn(out, F.lit(0).cast("long")).schema
    return docs.select(*kept, F.col(text_col).cast("string")).mapInArrow(work, schema)


def count_words(text: Column) -> Column:
    """Words divided by ASCII white space."""
    words = F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD))
    return words.cast("long")


def deltas(rows: DataFrame, sign: int | Column, tokenizer: str | Column, tokens: str = "tokens") -> DataFrame:
    """(source, lang, tokenizer, documents, tokens): one signed delta per key.

    A null source or language is a key of its own; a null count adds nothing.
    """
    sign = F.lit(sign) if isinstance(sign, int) else sign
    tokenizer = F.lit(tokenizer) if isinstance(tokenizer, str) else tokenizer
    return (
        rows.select("source", "lang", tokenizer.alias("tokenizer"), sign.cast("long").alias("_sign"), (F.coalesce(F.col(tokens), F.lit(0)) * sign).alias("_tokens"))
        .groupBy(*KEYS)
        .agg(F.sum("_sign").alias("documents"), F.sum("_tokens").alias("tokens"))
    )


class Rollup:
    """A table of committed deltas below ``path``, one folder per batch id.

    A batch counts when its folder holds the writer's _SUCCESS mark, which
    Spark writes last; what a failed commit left behind is overwritten by
    the next try. Committing an id that is there already changes nothing.
    One writer at a time commits a given id. ``compact`` sums the batches up
    to now in a snapshot, which lists their ids: later totals read it and the
    batches after it only, and the ids stay known.
    """

    SUMS = "source string, lang string, tokenizer string, documents long, tokens long"

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _done(self, kind: str) -> list[str]:
        """Names of the finished folders ``<kind>=<name>``."""
        names = [f for f in folders(self.spark, self.path) if f.startswith(f"{kind}=")]
        return sorted(f.removeprefix(f"{kind}=") for f in names if exists(self.spark, f"{self.path}/{f}/_SUCCESS"))

    def _snapshot(self) -> tuple[str | None, set[str]]:
        """The last whole snapshot and the batch ids that it holds."""
        done = self._done("snapshot")
        if not done:
            return None, set()
        rows = self.spark.read.schema("batch string").parquet(f"{self.path}/snapshot={done[-1]}").collect()
        return done[-1], {r["batch"] for r in rows}  # ids, not counts

    def batches(self) -> list[str]:
        """Ids of the committed batches."""
        return sorted({*self._done("batch"), *self._snapshot()[1]})

    def commit(self, batch_id: str, *changes: DataFrame) -> bool:
        """Commit the sum of ``changes`` (rows as ``deltas`` gives them); False if the id is there."""
        if not re.fullmatch(r"[A-Za-z0-9_.-]+", batch_id):
            raise ValueError("a batch id has letters, digits, _ . - only")
        if batch_id in self.batches():
            return False
        total = changes[0]
        for c in changes[1:]:
            total = total.unionByName(c)
        self._sums(total).write.mode("overwrite").parquet(f"{self.path}/batch={batch_id}")
        return True

    def _sums(self, rows: DataFrame) -> DataFrame:
        return rows.groupBy(*KEYS).agg(F.sum("documents").alias("documents"), F.sum("tokens").alias("tokens"))

    def _rows(self) -> tuple[DataFrame, list[str]]:
        """Sums of the snapshot and the batches after it, and the ids of all."""
        last, held = self._snapshot()
        new = [b for b in self._done("batch") if b not in held]
        paths = [f"{self.path}/batch={b}" for b in new] + ([f"{self.path}/sums={last}"] if last else [])
        rows = self.spark.read.schema(self.SUMS).parquet(*paths) if paths else self.spark.createDataFrame([], self.SUMS)
        return rows, sorted({*held, *new})

    def compact(self) -> None:
        """Sum up what is committed; its batches' folders go once the snapshot is whole.

        The sums are written first and the list of ids last, which makes the
        snapshot; a reader that began before keeps its files only until the
        folders go, so compact when no totals are being read.
        """
        rows, ids = self._rows()
        name = new_name()
        self._sums(rows).write.parquet(f"{self.path}/sums={name}")
        self.spark.createDataFrame([(i,) for i in ids], "batch string").coalesce(1).write.parquet(f"{self.path}/snapshot={name}")
        for b in self._done("batch"):
            if b in ids:
                delete(self.spark, f"{self.path}/batch={b}")

    def totals(self) -> DataFrame:
        """Documents and tokens per key; keys whose documents and tokens are all gone are left out."""
        return self._sums(self._rows()[0]).filter("documents <> 0 OR tokens <> 0")


def new_name() -> str:
    """A name that sorts after all earlier ones."""
    return f"{time.time_ns():020d}"
