import zlib

import numpy as np
from helpers import DOC_SCHEMA, doc, frame, odd_docs, prose

from airloom.llm import quality

LABELS = "doc_id long, quality int, x string, y int, score double"


def corpus():
    good = [doc(i, prose(i, 80 + i % 60).capitalize() + ".") for i in range(1000, 1240)]
    bad = [doc(i, " ".join(["Again"] * (60 + i % 40)) if i % 2 else prose(i, 90).upper().replace(" ", "!! ")) for i in range(2000, 2080)]
    labels = [(r[0], 1, "x", 0, 0.0) for r in good] + [(r[0], 0, "x", 1, 1.0) for r in bad]
    return good + bad, labels


def test_held_out_accuracy_and_odd_rows(spark):
    rows, labels = corpus()
    rows = rows + odd_docs()
    labels += [(1000, 0, "x", 0, 0.0), (None, 1, "x", 0, 0.0), (13, None, "x", 0, 0.0), (999999, 1, "x", 0, 0.0)]
    got = quality.classify(frame(spark, rows), spark.createDataFrame(labels, LABELS)).collect()
    assert len(got) == len(rows)
    truth = dict(x[:2] for x in labels[: len(labels) - 4])
    held = [r for r in got if r.held_out and r.doc_id in truth]
    assert len(held) > 30 and all(r.predicted == truth[r.doc_id] for r in held)
    for r in got:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0)


def test_score_is_the_posterior_of_the_shrunk_gaussians(spark):
    rows, labels = corpus()
    x = {r[0]: np.array(quality.statistics(r[1].encode())) for r in rows}
    y = {i: q for i, q, *_ in labels if zlib.crc32(str(i).encode()) % 5}
    data = np.array([x[i] for i in y])
    center, scale = data.mean(axis=0), np.sqrt(np.maximum(data.var(axis=0), 1e-6))
    z = {i: (v - center) / scale for i, v in x.items()}
    group = {c: np.array([z[i] for i in y if y[i] == c]) for c in (0, 1)}
    cov = {c: np.cov(g.T, bias=True) for c, g in group.items()}
    pooled = sum(cov[c] * len(group[c]) for c in (0, 1)) / len(y)
    density = {}
    for c, g in group.items():
        s = 0.98 * (0.9 * cov[c] + 0.1 * pooled) + 0.02 * np.eye(quality.D)
        prior = np.log((len(g) + 1) / (len(y) + 2))
        density[c] = {i: prior - 0.5 * (np.linalg.slogdet(s)[1] + (v - g.mean(axis=0)) @ np.linalg.inv(s) @ (v - g.mean(axis=0))) for i, v in z.items()}
    got = quality.classify(frame(spark, rows), spark.createDataFrame(labels, LABELS)).collect()
    for r in got:
        expected = 1 / (1 + np.exp(np.clip(density[0][r.doc_id] - density[1][r.doc_id], -700, 700)))
        assert abs(r.score - expected) < 1e-6


def test_keep_good_agrees_with_classify(spark):
    rows, labels = corpus()
    labels = spark.createDataFrame(labels, LABELS)
    accepted = {r.doc_id for r in quality.classify(frame(spark, rows), labels).filter("predicted = 1").collect()}
    kept = quality.keep_good(frame(spark, rows), labels)
    assert kept.schema == frame(spark, rows).schema and {r.doc_id for r in kept.collect()} == accepted


def test_without_labels_or_rows(spark):
    none = spark.createDataFrame([], LABELS)
    assert {r.score for r in quality.classify(frame(spark), none).collect()} == {0.5}
    one = spark.createDataFrame([(1, 1, "x", 0, 0.0)], LABELS)
    assert all(0 <= r.score <= 1 for r in quality.classify(frame(spark), one).collect())
    assert quality.classify(spark.createDataFrame([], DOC_SCHEMA), none).count() == 0
