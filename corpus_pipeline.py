"""Corpus pipeline: from raw documents to packed token sequences.

Every stage takes (spark, docs, sf_dir) and works on all rows its
predecessor kept. All but the last return the columns of ``documents``.
Documents that a stage does not touch pass through it without a shuffle of
their text. Rows are judged one by one, whatever their doc_id: rows that
share one by their own texts, and a row without one as if it came after all
that have one (its key is a hash of its values), so its repeats and leaks go
like those of others. Its doc_id stays null.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from airloom.llm import decontamination, packing, quality, simhash, substring_dedup, tokens
from airloom.llm.common import id_filter, save, table


AFTER_ALL = 1 << 62  # keys of rows without doc_id begin here


def keyed(docs: DataFrame) -> DataFrame:
    """``docs`` with a doc_id in every row; ``_own_id`` keeps the rows' own."""
    values = F.xxhash64(*[F.col(c) for c in docs.columns if c != "doc_id"])
    key = values.bitwiseAND(F.lit(AFTER_ALL - 1)) + F.lit(AFTER_ALL)
    return docs.withColumns({"_own_id": F.col("doc_id"), "doc_id": F.coalesce(F.col("doc_id").cast("long"), key)})


def with_own_ids(rows: DataFrame, columns: list[str]) -> DataFrame:
    return rows.drop("doc_id").withColumnRenamed("_own_id", "doc_id").select(columns)


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, trained on the labelled ones, accepts."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates one row, of the least doc_id.

    A row is judged by its own text: rows that share a doc_id may belong to
    different groups, and a group may be named by the id of another, too.
    """
    columns, docs = docs.columns, keyed(docs)
    groups = save(simhash.clusters(docs), "near-duplicates")
    named = F.col("component_id") == F.col("doc_id")
    odd = groups.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"), F.max(named).alias("names")).filter("n > 1 OR NOT names")
    dropped = odd.filter("NOT names").select("doc_id")
    places = groups.filter(named).groupBy("doc_id", F.col("fp").alias("_fp")).agg(F.min("root").alias("_root"))
    tested = docs.withColumn("_odd", id_filter(odd.select("doc_id"), F.col("doc_id")))
    rest = tested.filter("_odd").drop("_odd").join(dropped, "doc_id", "left_anti").withColumn("_fp", simhash.print_of(F.col("text")))
    first = F.row_number().over(Window.partitionBy("doc_id", "_root").orderBy(*[c for c in docs.columns if c != "doc_id"]))
    kept = rest.join(places, ["doc_id", "_fp"]).withColumn("_n", first).filter("_n = 1")
    return with_own_ids(tested.filter("NOT _odd").select(docs.columns).unionByName(kept.select(docs.columns)), columns)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the words of passages that an earlier document holds; emptied documents go."""
    columns = docs.columns
    rows = substring_dedup.dedup(keyed(docs)).filter("n_removed = 0 OR kept <> ''")
    changed = F.col("n_removed") > 0
    text = F.when(changed, F.col("kept")).otherwise(F.col("text"))
    chars = F.when(changed, F.char_length("kept").cast("long")).otherwise(F.col("n_chars"))
    return with_own_ids(rows.withColumns({"text": text, "n_chars": chars}), columns)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    # The key of a row is a hash of its id and text, so rows that share an id are judged apart.
    rows = docs.withColumn("_row", F.xxhash64("doc_id", "text"))
    found = decontamination.contaminated(rows, table(spark, sf_dir, "benchmark"), id_col="_row")
    leaks = save(found.select(F.col("doc_id").alias("_row")).distinct(), "leaks")
    tested = rows.withColumn("_leak", id_filter(leaks.select(F.col("_row").alias("doc_id")), F.col("_row")))
    kept = tested.filter("_leak").join(leaks, "_row", "left_anti")
    return tested.filter("NOT _leak").select(docs.columns).unionByName(kept.select(docs.columns))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of at most 1024 token ids."""
    return packing.pack(docs, capacity=1024, vocabulary=tokens.tokenizer_file())


STAGES = [
    ("quality classifier", quality_filter),
    ("simhash near-dedup", near_dedup),
    ("substring dedup", cut_repeats),
    ("benchmark decontamination", drop_leaks),
    ("packing", pack_sequences),
]

# Fingerprints, tokens and the classifier are not SQL: tests/llm holds a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what each but the last returns is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = save(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
