"""Ids of the registered queries against the unmodified tokenizers file."""

import zlib
from collections import Counter

import numpy as np
import pytest
from helpers import doc, frame, prose

import corpus_pipeline
from airloom.llm import queries, token_counts, tokens

TEXTS = ["a <|endoftext|> b", "<|endoftext|><|endoftext|>", prose(1, 40), "x" + " " * 1_200_000 + "y", "\n" * 1_200_000, "a" + "\r\n\t " * 300_000, " " * 99_999 + "z"]


@pytest.fixture(scope="module")
def ids():
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return [t.encode(x, add_special_tokens=False).ids for x in TEXTS]


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("long-runs")
    rows = frame(spark, [doc(i, t) for i, t in enumerate(TEXTS)])
    rows.select("doc_id", "text", "lang", "source", "n_chars").write.parquet(str(path / "documents.parquet"))
    return str(path)


def test_encoder(ids):
    encode = tokens.encoder(tokens.tokenizer_file())
    assert [list(encode.ids(t)) for t in TEXTS] == ids
    assert [encode.count(t) for t in TEXTS] == [len(x) for x in ids]
    ordinary = tokens.encoder(tokens.default_vocabulary())
    assert 50256 in ids[0] and 50256 not in ordinary.ids(TEXTS[0]) and list(ordinary.ids(TEXTS[3])) == ids[3]


def pieces(ids, capacity=1024):
    own = [np.array([*x, 0], "<u4") for x in ids]
    return Counter((i, s, x[s : s + capacity].tobytes(), len(x)) for i, x in enumerate(own) for s in range(0, len(x), capacity))


def test_packing(spark, sf_dir, ids):
    rows = queries.op3_packing(spark, sf_dir).collect()
    want = Counter((i, s, zlib.crc32(x), n) for i, s, x, n in pieces(ids).elements())
    assert Counter((r.doc_id, r.start, r.ids_crc32, r.doc_tokens) for r in rows) == want
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = corpus_pipeline.pack_sequences(spark, docs, sf_dir).collect()
    assert Counter((r.doc_id, r.start, bytes(r.ids), r.doc_tokens) for r in rows) == pieces(ids)


def test_token_counts(spark, sf_dir, ids):
    (row,) = queries.op9_token_counts(spark, sf_dir).filter("tokenizer = 'byte_bpe_50k-distinct'").collect()
    assert (row.documents, row.tokens) == (len(ids), sum(map(len, ids)))


def test_texts_of_null_ids_count(spark, tmp_path):
    nobody, shared = prose(2, 30), prose(3, 20)
    rows = [doc(None, nobody, "fr", "t"), doc(None, nobody, "en", "t"), doc(None, shared, "de"), doc(5, shared, "en"), doc(5, shared, "aa")]
    frame(spark, rows).select("doc_id", "text", "lang", "source", "n_chars").write.parquet(str(tmp_path / "documents.parquet"))
    count = tokens.encoder(tokens.tokenizer_file()).count
    got = {(r.source, r.lang, r.documents, r.tokens) for r in queries.op9_token_counts(spark, str(tmp_path)).filter("tokenizer LIKE '%-distinct'").collect()}
    assert got == {("t", "en", 1, count(nobody)), ("s", "aa", 1, count(shared))}


def test_compacted_rollup_has_the_same_totals_and_knows_its_batches(spark, tmp_path):
    rollup = token_counts.Rollup(spark, str(tmp_path / "compacted"))
    one = spark.createDataFrame([("s", "en", "t", 1, 5), ("s", None, "t", 1, 2)], "source string, lang string, tokenizer string, documents long, tokens long")
    gone = one.selectExpr("source", "lang", "tokenizer", "-documents AS documents", "-tokens AS tokens")
    totals = lambda: sorted((str(r.lang), r.documents, r.tokens) for r in rollup.totals().collect())
    rollup.compact()
    assert rollup.commit("a", one) and rollup.commit("b", one)
    rollup.compact()
    assert totals() == [("None", 2, 4), ("en", 2, 10)] and rollup.batches() == ["a", "b"]
    assert not rollup.commit("a", one) and rollup.commit("c", gone, gone.filter("lang IS NULL"))
    assert totals() == [("en", 1, 5)]
    rollup.compact()
    assert totals() == [("en", 1, 5)] and rollup.batches() == ["a", "b", "c"]
    # A snapshot without its list of ids does not count.
    one.write.parquet(f"{rollup.path}/sums=9")
    assert totals() == [("en", 1, 5)]
