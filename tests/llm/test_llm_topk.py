import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from airloom.llm import topk

SCHEMA = "vec_id long, embedding array<float>, score long, rank int, qb int"


def slow(rows, k, modulo):
    ok = {}
    for i, v, *_ in rows:
        if i is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        q = [math.floor(64 * float(np.float32(x))) for x in v]
        ok[i] = min(ok.get(i, q), q)
    out = []
    for i, q in ok.items():
        if i % modulo == 0:
            best = sorted((-sum(a * b for a, b in zip(q, x)), j) for j, x in ok.items() if j != i)[:k]
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(best)]
    return sorted(out)


def run(spark, rows, k=5, modulo=3):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    return sorted(map(tuple, topk.top_k(df, F.col("vec_id") % modulo == 0, k).collect()))


@pytest.mark.parametrize("spread", [1.0, 0.02, 3e3])
def test_against_all_pairs(spark, monkeypatch, spread):
    monkeypatch.setattr(topk, "ROWS", 60)
    monkeypatch.setattr(topk, "QUERIES", 20)
    monkeypatch.setattr(topk, "FEW", 50)
    rng = np.random.default_rng(4)
    rows = [(i, (spread * rng.normal(size=8)).tolist(), 0, 0, 0) for i in range(300)]
    assert run(spark, rows) == slow(rows, 5, 3)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [1.0, -0.5], 0, 0, 0) for i in range(40)] + [(50, None, 0, 0, 0), (51, [1.0, None], 0, 0, 0), (54, [nan, 1.0], 0, 0, 0), (57, [inf, 1.0], 0, 0, 0), (None, [1.0, 1.0], 0, 0, 0)]
    rows += [(60, [0.0, 0.0], 0, 0, 0), (63, [-1.0], 0, 0, 0), (66, [2.0, 1.0, 5.0], 0, 0, 0), (69, [], 0, 0, 0), (3, [0.5, 0.5], 0, 0, 0), (3, [0.5, 0.5], 0, 0, 0), (72, [3e38, 1.0], 0, 0, 0)]
    big = [r for r in rows if r[0] != 72]
    assert run(spark, big) == slow(big, 5, 3)
    assert len(run(spark, rows)) > 0


def test_few_rows_and_none(spark):
    rows = [(0, [1.0], 0, 0, 0), (1, [2.0], 0, 0, 0)]
    assert run(spark, rows) == [(0, 1, 1, 64 * 128)]
    assert run(spark, rows[:1]) == [] == run(spark, [])


def test_stops_early_and_stays_exact():
    rng = np.random.default_rng(0)
    x = rng.integers(-3, 3, (2000, 4))
    x[:3] = 50
    found = topk.threshold_topk(np.array([9999]), np.array([[1, 2, 1, 1]]), np.arange(2000), x, 3)
    assert found[0][0].tolist() == [0, 1, 2]


def test_narrowest_integers():
    assert [topk._narrowest(*x) for x in ((-128, 127), (-129, 0), (0, 40_000), (0, 2**31), (0, 0))] == [np.int8, np.int16, np.int32, np.int64, np.int8]
