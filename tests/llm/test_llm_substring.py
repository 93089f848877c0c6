import random
import re

import numpy as np
import pytest
from helpers import DOC_SCHEMA, doc, frame, odd_docs, prose

from airloom.llm import substring_dedup as S
from airloom.llm.fm_index import FMIndex


def slow(rows, window):
    """(doc_id, n_words, n_removed, kept) of every row, over all windows of all rows."""
    words = [re.findall("[^\x20\x09-\x0d]+", r[1] or "") for r in rows]
    first = {}
    for r, w in zip(rows, words):
        if r[0] is not None:
            for k in range(len(w) - window + 1):
                g = tuple(w[k : k + window])
                first[g] = min(r[0], first.get(g, r[0]))
    out = []
    for r, w in zip(rows, words):
        gone = [False] * len(w)
        if r[0] is not None:
            for k in range(len(w) - window + 1):
                if first[tuple(w[k : k + window])] < r[0]:
                    gone[k : k + window] = [True] * window
        out.append((str(r[0]), len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g)))
    return sorted(out)


def run(spark, rows, window=13):
    got = S.dedup(frame(spark, rows), window=window)
    assert got.columns[:-3] == frame(spark, rows[:1]).columns
    return sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept) for r in got.collect())


def test_odd_documents(spark):
    assert run(spark, odd_docs()) == slow(odd_docs(), 13)


def shared_passages(seed):
    r = random.Random(seed)
    passages = [prose(900 + i, r.randint(5, 60)) for i in range(12)]
    rows = []
    for i in r.sample(range(1000), 120):
        parts = [r.choice(passages) if r.random() < 0.5 else prose(r.randrange(10**6), r.randint(1, 40)) for _ in range(r.randint(1, 6))]
        rows.append(doc(i, r.choice([" ", "\n", "  "]).join(parts)))
    return rows


@pytest.mark.parametrize("window", [6, 13])
def test_shared_passages(spark, window):
    rows = shared_passages(window)
    assert run(spark, rows, window) == slow(rows, window)


def test_packed_bytes_round_trip():
    h = np.array([0, 1, 2**40 - 1, 2**63], np.uint64)
    assert S.from_low_bytes(S.low_bytes(h, 5), 5).tolist() == [0, 1, 2**40 - 1, 0]


def test_few_words_repeat_often(spark):
    r = random.Random(7)
    rows = [doc(i, " ".join(r.choice("ab") for _ in range(r.randint(10, 60)))) for i in range(60)]
    assert run(spark, rows) == slow(rows, 13)


@pytest.mark.parametrize("at_once, known", [(1 << 20, 200_000), (500, 3), (500, 200_000)])
def test_passages_in_very_many_documents(spark, monkeypatch, at_once, known):
    # Batches of some documents, so that copies meet in a batch, in a task and between tasks.
    monkeypatch.setattr(S, "BYTES_AT_ONCE", at_once)
    monkeypatch.setattr(S, "SEGMENTS_KNOWN", known)
    monkeypatch.setattr(S, "SHARD_BYTES", 1000)
    rows = shared_passages(99) + [doc(2000 - i, prose(i, 9) + " " + prose(5, 25) + " " + prose(i + 500, 9)) for i in range(40)]
    assert run(spark, rows) == slow(rows, 13)


def test_word_hashes_follow_words():
    texts = ["a bb  a\tccc", "", " \n", "bb a", "é x é"]
    h, bounds = S.words_of([t.encode() for t in texts])
    words = [w for t in texts for w in t.encode().split()]
    assert bounds.tolist() == [0, 4, 4, 4, 6, 8]
    assert len(set(zip(words, h.tolist()))) == len(set(words)) == len(set(h.tolist()))


def test_backward_search_against_scanning():
    rng = np.random.default_rng(0)
    text = rng.integers(1, 4, 500)
    text[rng.integers(0, 500, 20)] = 0
    text[-1] = 0
    index = FMIndex(text, 7)
    starts = np.flatnonzero([0 not in text[i : i + 7] and i + 7 <= 500 for i in range(500)])
    lo, hi = index.search(starts, 7)
    for i, a, b in zip(starts, lo, hi):
        places = {int(j) for j in range(494) if (text[j : j + 7] == text[i : i + 7]).all()}
        assert b - a <= 1 if len(places) == 1 else set(index.suffixes[a:b].tolist()) == places


def test_empty_table(spark):
    assert S.dedup(spark.createDataFrame([], DOC_SCHEMA)).count() == 0
