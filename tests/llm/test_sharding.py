import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F
from tenderlake.llm import sharding


def held(rows, shards):
    by = defaultdict(list)
    for r in rows:
        by[r.shard].append(r)
    assert set(by) <= set(range(shards))
    for own in by.values():
        assert sorted(r.slot for r in own) == list(range(len(own)))
    return [sum(r.size for r in by[s]) for s in range(shards)]


def test_documents(corpus, no_docs, odd_docs):
    docs, rows = corpus
    texts = {i: (t or "").encode() for i, t in rows}
    found = sharding.shard(sharding.text_records(docs), 4).collect()
    assert {r.id: (r.size, r.text_crc32) for r in found} == {i: (len(t) + 8, zlib.crc32(t)) for i, t in texts.items()}
    held(found, 4)
    assert sharding.shard(sharding.text_records(no_docs)).count() == 0
    odd = sharding.shard(sharding.text_records(odd_docs), 3).collect()
    assert len(odd) == 6
    held(odd, 3)


@pytest.mark.parametrize("hot", [0, 3000])
def test_sizes_are_near_equal_and_groups_stay(spark, hot):
    rows = [(i % 700 * 7919, i, 50 + i * 31 % 400) for i in range(8000)] + [(123, 10_000 + i, 200) for i in range(hot)]
    records = spark.createDataFrame(rows, "h long, id long, size long").repartition(5)
    found = sharding.shard(records, 6).collect()
    assert len(found) == len(rows)
    sizes = held(found, 6)
    assert max(sizes) - min(sizes) < 0.03 * sum(sizes) / 6
    of_group = defaultdict(set)
    for r in found:
        of_group[r.h].add(r.shard)
    limit = sharding.WHOLE_GROUP * sum(sizes) / 6
    weight = defaultdict(int)
    for h, _, size in rows:
        weight[h] += size
    assert all(len(s) == 1 for h, s in of_group.items() if weight[h] <= limit)


def test_order_of_shards_is_that_of_keys(spark):
    records = spark.range(500).select(F.xxhash64("id").alias("h"), "id", F.lit(10).cast("long").alias("size"))
    found = sorted(sharding.shard(records, 5).collect(), key=lambda r: (r.h, r.id))
    assert [(r.shard, r.slot) for r in found] == [(i // 100, i % 100) for i in range(500)]
