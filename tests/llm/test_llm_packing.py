from collections import Counter, defaultdict

import numpy as np
import pytest
from helpers import DOC_SCHEMA, doc, frame, odd_docs, prose

from airloom.llm import packing, token_counts, tokens


@pytest.fixture(scope="module")
def reference():
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return t


def test_ids_equal_the_tokenizer_file(reference):
    encode = tokens.encoder(tokens.default_vocabulary())
    texts = [r[1] or "" for r in odd_docs()] + [" a  b\n\n c ", "don't 12 34", "\r\n\t x"]
    assert [list(encode.ids(t)) for t in texts] == [e.ids for e in reference.encode_batch(texts, add_special_tokens=False)]


@pytest.mark.parametrize("capacity", [16, 1024])
def test_every_id_in_exactly_one_piece(spark, reference, capacity):
    rows = packing.pack(frame(spark), capacity=capacity, open_windows=4).collect()
    sequences, docs = defaultdict(list), Counter()
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
        assert len(r.ids) == 4 * r.length > 0
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= capacity
    ids = {}
    for i, text, *_ in odd_docs():
        ids.setdefault(i, []).append([*reference.encode(text or "", add_special_tokens=False).ids, 0])
    for i, wanted in ids.items():
        own = Counter((r.start, r.ids, r.doc_tokens) for r in rows if r.doc_id == i)
        expected = Counter((s, np.array(w[s : s + capacity], "<u4").tobytes(), len(w)) for w in wanted for s in range(0, len(w), capacity))
        assert own == expected
        docs[i] += 1


def test_leftovers_are_merged(spark):
    rows = [doc(i, prose(i, 3)) for i in range(200)]
    got = packing.pack(frame(spark, rows, parts=20), capacity=1024).collect()
    used = sum(r.length for r in got)
    assert len({r.sequence_id for r in got}) == -(-used // 1024)


def test_bounded_space():
    w = packing.Windows(10, 2, 0)
    for i, n in enumerate([6, 7, 8, 3, 10, 2]):
        w.place((i, 0, b"", n, n))
    assert len(w.by_room) <= 2
    w.close()
    assert sorted(x[0] for x in w.out) == list(range(6))
    # 8 came when neither window had room, so the fullest (7) was emitted before the 3 could join it
    assert {x[0]: x[5] for x in w.out}[1] != {x[0]: x[5] for x in w.out}[3]


def test_empty_table(spark):
    assert packing.pack(spark.createDataFrame([], DOC_SCHEMA)).count() == 0


def test_rollup_follows_signed_deltas(spark, tmp_path, reference):
    docs = frame(spark)
    counted = token_counts.count_tokens(docs.select("doc_id", "source", "lang", "text"))
    exact = Counter()
    for _, text, lang, source, *_ in odd_docs():
        n = len(reference.encode(text or "", add_special_tokens=False).ids)
        exact[source, lang, "n"] += 1
        exact[source, lang, "t"] += n
    roll = token_counts.Rollup(spark, str(tmp_path / "roll"))
    assert roll.totals().count() == 0
    load = token_counts.deltas(counted, 1, "v1")
    assert roll.commit("b1", load) and not roll.commit("b1", load)
    got = {(r.source, r.lang): (r.documents, r.tokens) for r in roll.totals().collect()}
    assert got == {(s, g): (exact[s, g, "n"], exact[s, g, "t"]) for s, g, _ in exact}
    french = counted.filter("lang = 'fr'")
    roll.commit("b2", token_counts.deltas(french, -1, "v1"))
    rest = counted.filter("lang IS NULL")
    roll.commit("b3", token_counts.deltas(rest, -1, "v1"), token_counts.deltas(rest, 1, "v2"))
    after = {(r.source, r.lang, r.tokenizer): (r.documents, r.tokens) for r in roll.totals().collect()}
    assert ("s", "fr", "v1") not in after and (None, None, "v1") not in after
    assert after[None, None, "v2"] == (exact[None, None, "n"], exact[None, None, "t"])
    assert roll.batches() == ["b1", "b2", "b3"]


def test_failed_commit_does_not_count(spark, tmp_path):
    import os

    counted = spark.createDataFrame([("s", "en", 5)], "source string, lang string, tokens long")
    roll = token_counts.Rollup(spark, str(tmp_path / "roll"))
    roll.commit("b1", token_counts.deltas(counted, 1, "v1"))
    os.makedirs(tmp_path / "roll" / "batch=b2")
    (tmp_path / "roll" / "batch=b2" / "part-0.parquet").write_bytes(b"half")
    assert roll.batches() == ["b1"] and roll.totals().first().tokens == 5
    assert roll.commit("b2", token_counts.deltas(counted, 1, "v1")) and roll.totals().first().tokens == 10
    with pytest.raises(ValueError):
        roll.commit("../x", counted)


def test_counts_of_an_empty_table(spark):
    empty = spark.createDataFrame([], DOC_SCHEMA)
    assert token_counts.deltas(token_counts.count_tokens(empty), 1, "v").count() == 0
