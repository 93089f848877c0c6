import random
import time

import numpy as np
import pytest
from helpers import DOC_SCHEMA, doc, frame, odd_docs, prose

from airloom.llm import decontamination as D

ITEMS = "item_id long, text string, seed long, row long"


def slow_tiles(p, t, least):
    """Greedy string tiling by scanning all pairs of places."""
    free_p, free_t, total = [True] * len(p), [True] * len(t), 0
    while True:
        best = (least - 1, 0, 0)
        for i in range(len(p)):
            for j in range(len(t)):
                n = 0
                while i + n < len(p) and j + n < len(t) and p[i + n] == t[j + n] and free_p[i + n] and free_t[j + n]:
                    n += 1
                if n > best[0]:
                    best = (n, i, j)
        n, i, j = best
        if n < least:
            return total
        for x in range(n):
            free_p[i + x] = free_t[j + x] = False
        total += n


def passages(seed):
    r = random.Random(seed)
    items = [(i, prose(300 + i, r.randint(8, 45)).replace(" ", ", ", 2)) for i in range(15)]
    rows = []
    for i in range(60):
        words = r.choice(items)[1].split()
        kind = r.randrange(5)
        if kind == 1:  # reordered
            cut = r.randint(5, max(5, len(words) - 5))
            words = words[cut:] + [prose(i, 2)] + words[:cut]
        elif kind == 2:
            words = words[: len(words) // 2]
        elif kind == 3:
            words = [w.upper() + "!" for w in words]
        elif kind == 4:
            words = [w if r.random() < 0.8 else "other" for w in words]
        rows.append(doc(i, prose(i + 50, r.randint(0, 40)) + " " + " ".join(words) + " " + prose(i + 90, r.randint(0, 40))))
    return items, rows


def expected(items, rows):
    out = []
    for r in rows:
        for i, text in items:
            p = D.tokens(text)
            n = slow_tiles(p, D.tokens(r[1]), 5) if len(p) >= 5 else 0
            if p and n >= 0.8 * len(p):
                out.append((str(r[0]), str(i), len(p), n))
    return sorted(out)


def run(spark, items, rows):
    items = spark.createDataFrame([(i, t, 1, 2) for i, t in items], ITEMS)
    return sorted((str(r.doc_id), str(r.item_id), r.item_tokens, r.matched_tokens) for r in D.contaminated(frame(spark, rows), items).collect())


def test_against_scanning_all_pairs(spark):
    items, rows = passages(1)
    want = expected(items, rows)
    assert len(want) > 20 and run(spark, items, rows) == want


def test_odd_documents_and_items(spark):
    items = [(1, prose(2, 40)), (1, prose(2, 40)), (2, None), (3, ""), (4, "one"), (None, prose(8, 13)), (5, prose(8, 13)), (6, "same " * 20)]
    rows = odd_docs()
    want = [x for x in expected(list(dict.fromkeys(items)), rows)]
    assert {x[1] for x in want} >= {"1", "None", "5", "6"} and run(spark, items, rows) == want


def test_tiles_do_not_overlap():
    r = np.random.default_rng(5)
    for _ in range(100):
        p, t = r.integers(0, 3, r.integers(1, 40)).astype(np.uint64), r.integers(0, 3, r.integers(0, 80)).astype(np.uint64)
        tiles = D.Tiling(p, t, 5).run()
        taken_p, taken_t = np.zeros(len(p), int), np.zeros(len(t), int)
        for i, j, n in tiles:
            assert n >= 5 and (p[i : i + n] == t[j : j + n]).all()
            taken_p[i : i + n] += 1
            taken_t[j : j + n] += 1
        assert taken_p.max(initial=0) <= 1 and taken_t.max(initial=0) <= 1
        free_p = [int(x) if not k else -1 for x, k in zip(p, taken_p)]
        free_t = [int(x) if not k else -2 for x, k in zip(t, taken_t)]
        assert slow_tiles(free_p, free_t, 5) == 0  # nothing that could still be marked


@pytest.mark.parametrize("n_p, n_t", [(40, 200_000), (400, 50_000)])
def test_long_repetitive_texts_take_no_product_of_lengths(n_p, n_t):
    p, t = np.ones(n_p, np.uint64), np.ones(n_t, np.uint64)
    start = time.process_time()
    assert sum(x[2] for x in D.Tiling(p, t, 5).run()) == n_p
    t[::7] = 2  # runs of six
    assert sum(x[2] for x in D.Tiling(p, t, 5).run()) == n_p - (n_p % 6 if n_p % 6 < 5 else 0)
    assert time.process_time() - start < 20


def test_very_long_document(spark):
    item = prose(77, 30)
    rows = [doc(1, prose(5, 50_000) + " " + item + " " + prose(6, 50_000))]
    assert run(spark, [(9, item)], rows) == [("1", "9", 30, 30)]


def test_empty_tables(spark):
    none = spark.createDataFrame([], ITEMS)
    assert D.contaminated(frame(spark), none).count() == 0
    assert D.contaminated(spark.createDataFrame([], DOC_SCHEMA), spark.createDataFrame([(1, prose(1, 20), 1, 1)], ITEMS)).count() == 0
