"""Registered queries that SQL cannot express, against brute force over the whole small tables."""

import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from test_llm_decontamination import slow_tiles
from test_llm_simhash import roots, slow_print

from airloom.llm import decontamination, queries

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs():
    sql = f"SELECT doc_id, coalesce(text, ''), source, lang FROM '{SF_DIR}/documents.parquet' ORDER BY doc_id"
    return {r[0]: r[1:] for r in duckdb.sql(sql).fetchall()}


@pytest.fixture(scope="module")
def token_ids(docs):
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return {i: t.encode(d[0], add_special_tokens=False).ids for i, d in docs.items()}


def test_sharding(spark, docs):
    rows = queries.op2_sharding(spark, SF_DIR).collect()
    text = {i: d[0].encode() for i, d in docs.items()}
    assert sorted((r.doc_id, r.size, r.text_crc32) for r in rows) == sorted((i, len(t) + 16, zlib.crc32(t)) for i, t in text.items())
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    assert all(0 <= k < 40 and sorted(v) == list(range(len(v))) for k, v in slots.items())


def test_shards_have_near_equal_bytes(spark):
    rows = queries.op2_sharding(spark, SF_DIR.replace("0.001", "0.01")).collect()
    size = Counter()
    for r in rows:
        size[r.shard] += r.size
    mean = sum(size.values()) / 40
    assert len(size) == 40 and {r.law for r in rows} == {"bytes"}
    # No further from the mean than rows are large: a shard has some 25 of them here.
    assert max(abs(n - mean) for n in size.values()) <= min(0.15 * mean, max(r.size for r in rows))


def test_packing(spark, docs, token_ids):
    rows = queries.op3_packing(spark, SF_DIR).collect()
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append((r.offset, r.length))
    assert set(by_doc) == set(docs)
    for i, own in by_doc.items():
        ids, at = np.array([*token_ids[i], 0], "<u4"), 0
        for r in sorted(own, key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(ids))
            assert r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    used = 0
    for pieces in by_sequence.values():
        at = 0
        for offset, n in sorted(pieces):
            assert offset == at
            at += n
        assert at <= 1024
        used += at
    assert used > 0.95 * 1024 * (len(by_sequence) - 1)


def test_simhash(spark, docs):
    prints = {i: slow_print(d[0]) for i, d in docs.items()}
    ids = sorted(docs)
    root = roots(ids, [(a, b) for n, a in enumerate(ids) for b in ids[:n] if (prints[a] ^ prints[b]).bit_count() <= 3])
    rows = queries.op4_simhash(spark, SF_DIR).collect()
    assert sorted(map(tuple, rows)) == [(i, f"{prints[i]:016x}", root[i]) for i in ids]


def test_quality(spark, docs):
    labels = dict(duckdb.sql(f"SELECT doc_id, quality FROM '{SF_DIR}/labels.parquet'").fetchall())
    rows = queries.op6_quality(spark, SF_DIR).collect()
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    judged = [r for r in rows if r.doc_id in labels]
    assert sum(r.predicted == labels[r.doc_id] for r in judged) >= 0.95 * len(judged)


def test_decontamination(spark, docs):
    items = {i: decontamination.tokens(t) for i, t in duckdb.sql(f"SELECT item_id, text FROM '{SF_DIR}/benchmark.parquet'").fetchall()}
    want = set()
    for i, d in docs.items():
        words = decontamination.tokens(d[0])
        grams = {tuple(words[k : k + 5]) for k in range(len(words) - 4)}
        for item, p in items.items():
            # A tile covers only tokens of the item that lie in five shared ones; pairs with enough of them are tiled.
            covered = {k + j for k in range(len(p) - 4) if tuple(p[k : k + 5]) in grams for j in range(5)}
            if len(covered) >= 0.8 * len(p) and (n := slow_tiles(p, words, 5)) >= 0.8 * len(p):
                want.add((i, item, n))
    got = [(r.doc_id, r.item_id, r.matched_tokens) for r in queries.op7_decontamination(spark, SF_DIR).collect()]
    assert want and sorted(got) == sorted(want)


def test_token_counts(spark, docs, token_ids):
    first, totals = {}, Counter()
    for i in sorted(docs):
        text, source, lang = docs[i]
        seen = first.setdefault(text, i) == i
        words = len(text.encode().split())
        for tokenizer, n, counts in (("words-1", words, True), ("byte_bpe_50k", len(token_ids[i]), True), ("byte_bpe_50k-distinct", len(token_ids[i]), seen)):
            totals[source, lang, tokenizer, "documents"] += counts
            totals[source, lang, tokenizer, "tokens"] += n * counts
    rows = queries.op9_token_counts(spark, SF_DIR).collect()
    got = {(r.source, r.lang, r.tokenizer): (r.documents, r.tokens) for r in rows}
    keys = {k[:3] for k in totals if totals[k]}
    assert got == {k: (totals[*k, "documents"], totals[*k, "tokens"]) for k in keys}
    assert sum(r.documents for r in rows if r.tokenizer == "words-1") == len(docs)
