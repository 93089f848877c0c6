"""The pipeline's near-dedup stage on rows that share a doc_id."""

from collections import Counter

from helpers import doc, frame, prose

import corpus_pipeline

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def kept(spark, rows):
    docs = frame(spark, rows).select(COLUMNS)
    return Counter((r.doc_id, r.text) for r in corpus_pipeline.near_dedup(spark, docs, "").collect())


def test_unlike_rows_of_one_id_stay(spark):
    a, b = prose(6, 50), prose(7, 50)
    assert kept(spark, [doc(13, a), doc(13, a), doc(13, b), doc(14, b), doc(15, None), doc(15, "")]) == Counter([(13, a), (13, b), (15, None)])


def test_every_group_keeps_a_row(spark):
    a, b, c = prose(6, 50), prose(7, 50), prose(8, 50)
    # 2 has a row in the group of 1, and names the groups of b and of c
    rows = [doc(1, a), doc(2, a), doc(2, b), doc(3, b), doc(3, c), doc(2, c), doc(4, c), doc(4, prose(9, 50)), doc(None, prose(10, 50))]
    assert kept(spark, rows) == Counter([(1, a), (2, b), (2, c), (4, prose(9, 50)), (None, prose(10, 50))])
