import random
import re

import numpy as np
import pytest
import xxhash
from helpers import DOC_SCHEMA, doc, frame, odd_docs, prose
from pyspark.sql import functions as F

from airloom.llm import simhash
from airloom.llm.components import components


def slow_print(text, k=3):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall("[^\x20\x09-\x0d]+", text)
    if not w:
        return 0
    grams = [" ".join(w[i : i + k]) for i in range(len(w) - k + 1)] if len(w) >= k else [" ".join(w)]
    h = [xxhash.xxh64(g.encode(), seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def roots(nodes, linked):
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in linked:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_fingerprint_and_components_against_all_pairs(spark):
    r = random.Random(1)
    rows = odd_docs()
    for i in range(100, 130):
        words = prose(i, 400).split()
        for j in range(3):
            rows.append(doc(i * 10 + j, " ".join(words)))
            words[r.randrange(400)] = "changed"
    prints = [slow_print(x[1]) for x in rows]
    root = roots(range(len(rows)), [(i, j) for i in range(len(rows)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 3])
    least = {}
    for i, x in enumerate(rows):
        if x[0] is not None:
            least[root[i]] = min(x[0], least.get(root[i], x[0]))
    expected = sorted((str(x[0]), f"{prints[i]:016x}", least[root[i]]) for i, x in enumerate(rows))
    got = simhash.near_duplicates(frame(spark, rows)).collect()
    assert sorted((str(x.doc_id), x.fingerprint, x.component_id) for x in got) == expected


def test_hash_is_that_of_spark(spark):
    row = spark.createDataFrame([("a b é",)], "t string").select(F.xxhash64("t")).first()
    assert row[0] % 2**64 == xxhash.xxh64("a b é".encode(), seed=42).intdigest()


def test_anchors_cover():
    rng = np.random.default_rng(0)
    half = rng.integers(0, 2**32, 300, dtype=np.uint32)
    rows, anchor = simhash.anchors(half)
    sets = [set(anchor[rows == i].tolist()) for i in range(len(half))]
    assert all(int(a ^ half[i]).bit_count() <= 2 for i, a in zip(rows, anchor)) and max(map(len, sets)) <= 17
    for i in range(len(half)):
        home = int(anchor[i])
        assert int(home ^ int(half[i])).bit_count() <= 1
        for bit in range(32):  # every neighbour reaches the home of the value
            r, a = simhash.anchors(np.array([half[i] ^ np.uint32(1 << bit)], np.uint32))
            assert home in a.tolist()


@pytest.mark.parametrize("comparisons", [1 << 26, 60])
def test_links_of_planted_distances(spark, monkeypatch, comparisons):
    monkeypatch.setattr(simhash, "COMPARISONS", comparisons)
    rng = np.random.default_rng(2)
    base = rng.integers(0, 2**63, 60, dtype=np.uint64)
    fps = set(base.tolist())
    for b in base.tolist():
        for flips in (1, 2, 3, 4):
            bits = rng.choice(64, flips, replace=False)
            fps.add(b ^ sum(1 << int(x) for x in bits))
    # One anchor with very many: unlike in one half, alike in the other.
    for other in rng.integers(0, 2**32, 150, dtype=np.uint64).tolist():
        fps |= {(7 << 32) | other, (7 << 32) | (other ^ 1), (15 << 32) | (other ^ 6)}
    fps = sorted(fps)
    expected = roots(fps, [(a, b) for i, a in enumerate(fps) for b in fps[:i] if (a ^ b).bit_count() <= 3])
    signed = [x - 2**64 if x >= 2**63 else x for x in fps]
    links = simhash.near_links(spark.createDataFrame([(x,) for x in signed], "fp long").repartition(3)).collect()
    got = roots(fps, [(u % 2**64, v % 2**64) for u, v in links])
    assert got == expected


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(30)}}


def test_empty_table_and_null_ids_alone(spark):
    assert simhash.near_duplicates(spark.createDataFrame([], DOC_SCHEMA)).count() == 0
    row = simhash.near_duplicates(frame(spark, [doc(None, "x y z w")])).first()
    assert row.component_id is None


def test_long_texts_in_parts(monkeypatch):
    text = prose(3, 1000).encode()
    whole = simhash.fingerprint(text)
    monkeypatch.setattr(simhash, "HASHES_AT_ONCE", 7)
    assert simhash.fingerprint(text) == whole == slow_print(text.decode())
