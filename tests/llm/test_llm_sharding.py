import zlib
from collections import Counter, defaultdict

import pytest
from helpers import DOC_SCHEMA, doc, frame, prose

from airloom.llm import sharding


def columns(rows):
    for r in rows:
        text = (r[1] or "").encode()
        yield r[0], len(text) + 16, zlib.crc32(text)


@pytest.mark.parametrize("shards", [1, 3, 40])
def test_rows_sizes_and_slots(spark, shards):
    from helpers import odd_docs

    got = sharding.shard(frame(spark), shards).collect()
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == Counter(columns(odd_docs()))
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
        assert (r.law, r.grown_shard) == ("bytes", None)
    assert all(0 <= k < shards and sorted(v) == list(range(len(v))) for k, v in slots.items())


def test_bytes_are_near_equal_with_a_hot_text(spark):
    rows = [doc(i, prose(i, 30 + i % 7), source=f"s{i % 9}") for i in range(2000)] + [doc(5000 + i, "hot text " * 30) for i in range(1000)]
    size = Counter()
    for r in sharding.shard(frame(spark, rows), 10).collect():
        size[r.shard] += r.size
    assert len(size) == 10 and max(size.values()) - min(size.values()) < 0.02 * sum(size.values()) / 10 + 2000


def test_repeated_rows_are_divided(spark):
    size = Counter(r.shard for r in sharding.shard(frame(spark, [doc(1, "same")] * 900, parts=1), 3).collect())
    assert len(size) == 3 and max(size.values()) < 400


def test_target_bytes_and_empty_table(spark):
    rows = [doc(i, "x" * 84) for i in range(100)]
    assert {r.shard for r in sharding.shard(frame(spark, rows), target_bytes=2500).collect()} == {0, 1, 2, 3}
    assert sharding.shard(spark.createDataFrame([], DOC_SCHEMA), 40).count() == 0
