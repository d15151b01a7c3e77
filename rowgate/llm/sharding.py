"""Balanced shards of indivisible groups by Karmarkar-Karp differencing.

Equal texts form a group that must not be torn apart. Groups are dealt into blocks by a hash;
each block is partitioned into k parts by differencing: of all partial partitions the two
with the largest spread are combined, largest part with smallest, until one is left. Its k
sums are one partial partition of the next level, where blocks are combined in the same
way. A block and a level's group hold a bounded number of entries, so nothing large meets in
one task, and the levels are as many as the logarithm of the number of blocks.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.staging import StagingArea
from .common import column, fresh, running_blocks

#: Groups per block, about, and partial partitions that one task combines at a higher level.
PER_BLOCK = 1 << 15
PER_MERGE = 1 << 10


def differencing(sums: list[list[int]], k: int) -> list[list[int]]:
    """Combine partial partitions into one: for each, the final part of each of its parts.

    ``sums`` has the sizes of the parts of each partial partition, at most k; a single number
    is a partition with one part. Ties are broken by position, so equal input gives equal
    output.
    """
    joins: list[tuple[int, int]] = []  # inner nodes; leaf (i, j) is i * k + j
    leaves = len(sums) * k
    heap = []
    for i, parts in enumerate(sums):
        entry = sorted((size, i * k + j) for j, size in enumerate(parts))
        entry = [(0, -1)] * (k - len(entry)) + entry
        heap.append((entry[0][0] - entry[-1][0], i, entry))
    heapq.heapify(heap)
    tie = len(sums)
    while len(heap) > 1:
        _, _, a = heapq.heappop(heap)
        _, _, b = heap[0]
        entry = []
        for (x, p), (y, q) in zip(a, reversed(b)):
            if p < 0 or q < 0:
                entry.append((x + y, max(p, q)))
            else:
                joins.append((p, q))
                entry.append((x + y, leaves + len(joins) - 1))
        entry.sort()
        heapq.heapreplace(heap, (entry[0][0] - entry[-1][0], tie, entry))
        tie += 1
    part_of = np.full(leaves + len(joins), -1, dtype=np.int32)
    if heap:
        for part, (_, node) in enumerate(heap[0][2]):
            if node >= 0:
                part_of[node] = part
    for at in range(len(joins) - 1, -1, -1):  # parents come after their children
        for child in joins[at]:
            part_of[child] = part_of[leaves + at]
    return [[int(p) for p in part_of[i * k : i * k + len(parts)]] for i, parts in enumerate(sums)]


def _split_block(k: int):
    def split(table: pa.Table) -> pa.Table:
        table = table.sort_by([("digest", "ascending")])  # the same order in every run
        sizes = table.column("bytes").to_pylist()
        parts = [p[0] for p in differencing([[s] for s in sizes], k)]
        return table.append_column("part", pa.array(parts, pa.int32()))

    return split


def _merge_parts(k: int):
    def merge(table: pa.Table) -> pa.Table:
        table = table.sort_by([("node", "ascending")])
        found = differencing(table.column("sums").to_pylist(), k)
        return table.select(["node", "into"]).append_column("parts", pa.array(found, pa.list_(pa.int32())))

    return merge


def _block_sums(parts: DataFrame, node: str, k: int) -> DataFrame:
    return parts.groupBy(F.col(node).alias("node")).agg(
        F.array(*(F.sum(F.when(F.col("part") == p, F.col("bytes")).otherwise(0)) for p in range(k))).alias("sums")
    )


def split_groups(groups: DataFrame, k: int, area: StagingArea) -> DataFrame:
    """``digest, bytes, shard`` of each group, the shards' bytes as equal as differencing gets them.

    ``groups`` has one row ``digest, bytes`` per group.
    """
    blocks = max(1, -(-groups.count() // PER_BLOCK))
    parts = area.stage(
        groups.withColumn("block", F.pmod(F.xxhash64("digest"), F.lit(blocks)))
        .groupBy("block")
        .applyInArrow(_split_block(k), "digest binary, bytes bigint, block bigint, part int"),
        "parts",
    )
    # From block to block of blocks: where each part of each node of a level ends up.
    shard = parts.select("digest", "bytes", "block", "part", F.col("block").alias("node"))
    level, sums, nodes = 0, _block_sums(parts, "block", k), blocks
    while nodes > 1:
        found = area.stage(
            sums.withColumn("into", F.floor(F.col("node") / PER_MERGE).cast("bigint"))
            .groupBy("into")
            .applyInArrow(_merge_parts(k), "node bigint, into bigint, parts array<int>"),
            f"level-{level}",
        )
        shard = shard.join(found, "node").select(
            "digest", "bytes", "block", F.element_at("parts", F.col("part") + 1).alias("part"),
            F.col("into").alias("node"),
        )
        sums = _block_sums(shard, "node", k)
        level, nodes = level + 1, -(-nodes // PER_MERGE)
    return shard.select("digest", "bytes", F.col("part").alias("shard"))


def _numbered(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Add this task's number and, per shard, the running number of the row in the task."""
    task, counts = TaskContext.get().partitionId(), {}
    for batch in batches:
        shards = batch.column(batch.schema.get_field_index("shard")).to_numpy()
        local = np.zeros(len(shards), dtype=np.int64)
        for shard in np.unique(shards):
            own = shards == shard
            n = int(own.sum())
            local[own] = counts.get(shard, 0) + np.arange(n)
            counts[shard] = counts.get(shard, 0) + n
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(np.full(len(shards), task), pa.int32()), pa.array(local)],
            names=[*batch.schema.names, "task", "local"],
        )


def assign(docs: DataFrame, shards: int, area: StagingArea, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per document: ``id, digest, size, text_crc32, shard, slot``.

    The size is the UTF-8 bytes of the text plus one. Equal texts share a shard; a null text
    equals an empty one. ``slot`` counts the rows of a shard without gaps from 0, by id with
    null first. Rows that repeat each other get slots of their own. Other columns, whatever
    their names, are not looked at; an empty table gives an empty one.

    A group larger than a shard's share fills a shard of its own: it cannot be split. Its
    rows are spread over tasks all the same, also where they share one id or have none.
    """
    text_or_empty = F.coalesce(column(text), F.lit(""))
    rows = area.stage(
        docs.select(
            column(doc_id).cast("bigint").alias("id"),
            F.unhex(F.sha2(text_or_empty, 256)).alias("digest"),
            (F.octet_length(text_or_empty) + 1).cast("bigint").alias("size"),
            F.crc32(text_or_empty.cast("binary")).alias("text_crc32"),
            F.monotonically_increasing_id().alias("place"),
        ),
        "rows",
    )
    groups = area.stage(rows.groupBy("digest").agg(F.sum("size").alias("bytes")), "groups")
    placed = area.stage(split_groups(groups, shards, area).drop("bytes"), "placed")
    numbered = area.stage(
        rows.join(placed, "digest")
        .repartitionByRange("id", "digest", "place")
        .sortWithinPartitions("id", "digest", "place")
        .drop("place")
        .mapInArrow(
            _numbered, "digest binary, id bigint, size bigint, text_crc32 bigint, shard int, task int, local bigint"
        ),
        "numbered",
    )
    counts = numbered.groupBy("task", "shard").agg(F.count(F.lit(1)).alias("n"))
    before = area.stage(running_blocks(counts, "task", "task", {"before": "n"}, ["shard"]), "before")
    return numbered.join(before, ["task", "shard"]).select(
        "id", "digest", "size", "text_crc32", "shard", (F.col("before") + F.col("local")).alias("slot")
    )


def write_shards(docs: DataFrame, assigned: DataFrame, path: str, text: str = "text") -> None:
    """Write the documents to one folder per shard."""
    key, at = fresh(docs, "digest"), fresh(docs, "shard")
    places = assigned.select(F.col("digest").alias(key), F.col("shard").alias(at)).distinct()
    marked = docs.withColumn(key, F.unhex(F.sha2(F.coalesce(column(text), F.lit("")), 256)))
    marked.join(places, key).drop(key).write.partitionBy(at).parquet(path)
