import random
import zlib

import pytest

from rowgate.llm import sharding
from rowgate.llm.queries import QUERIES

from llm_cases import SMALL, edge_rows


def spread(sums, found, k):
    total = [0] * k
    for parts, to in zip(sums, found):
        for size, part in zip(parts, to):
            total[part] += size
    return max(total) - min(total)


def test_a_known_partition():
    numbers = [8, 7, 6, 5, 4]  # differencing two ways leaves 2
    assert spread([[n] for n in numbers], sharding.differencing([[n] for n in numbers], 2), 2) == 2


@pytest.mark.parametrize("k", [2, 3, 8])
def test_many_numbers_come_out_even(k):
    rng = random.Random(k)
    sums = [[rng.randrange(1, 10_000)] for _ in range(2000)]
    assert spread(sums, sharding.differencing(sums, k), k) <= 5


def test_partial_partitions_keep_their_parts_apart():
    rng = random.Random(1)
    sums = [[rng.randrange(100) for _ in range(4)] for _ in range(50)]
    found = sharding.differencing(sums, 4)
    assert all(sorted(parts) == [0, 1, 2, 3] for parts in found)
    assert spread(sums, found, 4) <= 3
    assert sharding.differencing([], 4) == []


def check(rows, expected):
    assert len(rows) == len(expected)
    by_text, slots = {}, {}
    texts = {}
    for doc_id, text, _ in expected:
        data = (text or "").encode()
        texts.setdefault((doc_id, len(data) + 1, zlib.crc32(data)), data)
    for r in rows:
        data = texts[r.id, r.size, r.text_crc32]
        assert by_text.setdefault(data, r.shard) == r.shard
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_edge_rows(edge, empty, area):
    check(sharding.assign(edge, 3, area).collect(), edge_rows())
    assert sharding.assign(empty, 3, area).count() == 0


def test_more_blocks_and_levels_still_balance(spark, small, area, monkeypatch):
    monkeypatch.setattr(sharding, "PER_BLOCK", 20)
    monkeypatch.setattr(sharding, "PER_MERGE", 3)
    docs = spark.createDataFrame(small, "doc_id bigint, text string, source string")
    rows = sharding.assign(docs, 4, area).collect()
    check(rows, small)
    totals = [sum(r.size for r in rows if r.shard == s) for s in range(4)]
    assert max(totals) - min(totals) < 0.02 * sum(totals) / 4


def test_query_balances_bytes(spark, small):
    rows = QUERIES["op1_karmarkar_karp_shards"](spark, SMALL).withColumnRenamed("doc_id", "id").collect()
    check(rows, small)
    totals = [sum(r.size for r in rows if r.shard == s) for s in range(8)]
    assert max(totals) - min(totals) < 0.01 * sum(totals) / 8
    assert {(r.law, r.grown_shard) for r in rows} == {("bytes", None)}


def test_written_shards_hold_their_texts(spark, edge, area):
    assigned = sharding.assign(edge, 3, area)
    sharding.write_shards(edge.select("doc_id", "text"), assigned, f"{area.path}/shards")
    back = spark.read.parquet(f"{area.path}/shards")
    assert back.count() == edge.count()
    assert back.groupBy("shard").count().count() <= 3


def test_repeated_rows_are_spread_over_tasks(spark, area):
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    rows = [(None, "same", "a")] * 4000
    spark.conf.set(name, "false")
    try:
        check(sharding.assign(spark.createDataFrame(rows, "doc_id bigint, text string, source string"), 3, area).collect(), rows)
    finally:
        spark.conf.unset(name)
    per_task = [r["count"] for r in area.tables["numbered"].groupBy("task").count().collect()]
    assert len(per_task) > 4 and max(per_task) < 1500
