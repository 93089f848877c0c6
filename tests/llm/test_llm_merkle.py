"""The manifest against trees built from lists."""

import hashlib
from collections import defaultdict

import pytest
from helpers import doc, frame, odd_docs
from pyspark.sql import functions as F

from airloom.llm import merkle as M


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(*values):
    return H(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def slow_tree(leaves):
    """(top, path of each leaf) of one list of digests."""
    paths, members, level = [[] for _ in leaves], [[i] for i in range(len(leaves))], list(leaves)
    while len(level) > 1:
        runs = [range(i, min(i + 3, len(level))) for i in range(0, len(level), 3)]
        for run in runs:
            for j in run:
                for m in members[j]:
                    paths[m].append(("".join(level[k] for k in run if k < j), "".join(level[k] for k in run if k > j)))
        level, members = [H(*(level[j] for j in run)) for run in runs], [[m for j in run for m in members[j]] for run in runs]
    return level[0], paths


def slow(rows):
    """Sorted (key, leaf, subroot, root, path) of rows (key, group, lang, n_chars, text)."""
    groups = defaultdict(list)
    for i, group, lang, n, text in rows:
        groups[group].append((i is not None, i or 0, leaf_of(i, group, lang, n, text), i))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = [slow_tree([r[2] for r in sorted(groups[g])]) for g in names]
    root, over = slow_tree([top for top, _ in trees])
    return sorted((str(r[3]), r[2], top, root, p + o) for g, (top, paths), o in zip(names, trees, over) for r, p in zip(sorted(groups[g]), paths))


def proven(spark, rows):
    manifest = M.build(M.leaves(rows))
    return manifest, M.verified(M.proofs(manifest))


def as_rows(df):
    return sorted((str(r.key), r.leaf, r.subroot, r.root, [tuple(p) for p in r.path]) for r in df.collect())


@pytest.mark.parametrize("levels", [1, 2, 6])
def test_proofs_of_several_slabs(spark, monkeypatch, levels):
    monkeypatch.setattr(M, "LEVELS", levels)
    monkeypatch.setattr(M, "RANGE", 16)
    sizes = {None: 1, "": 2, "a": 3, "b": 4, "é": 10, "B": 28, "hot": 95}
    rows = [(1000 * n + i, g, "en", i, f"text {i}") for n, (g, size) in enumerate(sizes.items()) for i in range(size)]
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").repartition(5)
    manifest, got = proven(spark, df)
    assert as_rows(got) == slow(rows)
    assert got.filter("NOT verified OR folded_root <> root").count() == 0
    # The labels: a tree's nodes of one level cover its leaves once, in order.
    covered = defaultdict(list)
    for r in manifest.nodes().collect():
        covered[r.base, r.level].append((r.lo, r.hi))
    for (base, _), spans in covered.items():
        spans.sort()
        assert spans[0][0] == base and all(a[1] == b[0] for a, b in zip(spans, spans[1:]))
    assert {b: max(h for (x, _), s in covered.items() if x == b for _, h in s) - b for b, _ in covered} == dict(zip([0, 1, 3, 31, 34, 38, 133], [1, 2, 28, 3, 4, 95, 10]))


def test_tampering_shows_in_its_own_row(spark):
    rows = frame(spark, [doc(i, f"line {i}\nmore") for i in range(40)])
    changed = {"text": F.when(F.col("doc_id") == 17, F.lit("other")).otherwise(F.col("text"))}
    got = M.verified(M.proofs(M.build(M.leaves(rows, changed=changed)))).collect()
    assert [r.key for r in got if not r.verified] == [17]
    assert len({r.root for r in got}) == 1


def test_odd_documents(spark):
    rows = odd_docs()
    _, got = proven(spark, frame(spark, rows))
    assert as_rows(got) == slow([(r[0], r[3], r[2], r[4], r[1]) for r in rows])
    one = M.proofs(M.build(M.leaves(frame(spark, rows[:1], parts=1)))).collect()[0]
    assert one.leaf == one.subroot == one.root and one.path == []
    assert proven(spark, frame(spark, rows).limit(0))[1].collect() == []
