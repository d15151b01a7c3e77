"""Links between documents of similar word shingles, found by MinHash bands.

Each of several trees has a sequence of MinHash values of its own; documents meet in a tree where a
prefix of that sequence agrees. In an LSH forest the prefix would be shortened on the data. Here
its length is fixed beforehand, from the threshold, the number of trees and the target probability
to meet in some tree: that is banding, and a forest that is to reach the same recall for two
documents at the threshold ends at the same length. All that meet are verified by their exact
shingle sets, so no link is wrong.

Documents with equal shingle sets are one class and compared once. Classes that meet, directly
or by others, form a candidate component. A component of bounded weight is verified in one task.
A larger one is cut into blocks by a hash, one task per two blocks; where that would send a
class to more tasks than there are trees, one task per tree node and two of its blocks instead. Tasks
count the common shingles of all their pairs at once and return a row per class: pairs are
never rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.staging import StagingArea
from .common import column, encoded, flush_sorted, fresh
from .components import components
from .marks import mark, may_have
from .shingles import set_digest, shingle_set, tree_labels

THRESHOLD = 0.8
TREES, LONGEST, RECALL = 20, 8, 0.999
#: Weight of a block, in shingles, and classes in a block, about.
BLOCK_SHINGLES, BLOCK_CLASSES = 1 << 19, 1 << 10
#: Shingles that more classes of a task share are counted by matrix products.
FEW = 16


def matching_depth(threshold: float, trees: int, longest: int, recall: float) -> int:
    """The longest prefix with which the chance to meet at the threshold reaches the recall."""
    for depth in range(longest, 0, -1):
        if 1 - (1 - threshold**depth) ** trees >= recall:
            return depth
    raise ValueError(f"{trees} trees do not reach a recall of {recall} at similarity {threshold}")


def _sketch(trees: int, depth: int):
    def sketch(texts: pa.Array) -> pa.Array:
        digests, sizes, labels = [], [], []
        for text in encoded(texts):
            shingles = shingle_set(text)
            digests.append(set_digest(shingles) if len(shingles) else None)
            sizes.append(len(shingles))
            labels.append(tree_labels(shingles, trees, depth) if len(shingles) else None)
        return pa.StructArray.from_arrays(
            [pa.array(digests, pa.binary()), pa.array(sizes, pa.int64()), pa.array(labels, pa.list_(pa.int64()))],
            names=["digest", "n", "labels"],
        )

    return sketch


def _shingles(texts: pa.Array) -> pa.Array:
    digests, sets = [], []
    for text in encoded(texts):
        shingles = shingle_set(text)
        digests.append(set_digest(shingles) if len(shingles) else None)
        sets.append(shingles.tobytes())
    return pa.StructArray.from_arrays(
        [pa.array(digests, pa.binary()), pa.array(sets, pa.large_binary()).cast(pa.binary())], names=["digest", "shingles"]
    )


def _digests(texts: pa.Array) -> pa.Array:
    sets = map(shingle_set, encoded(texts))
    return pa.array([set_digest(s) if len(s) else None for s in sets], pa.binary())


def common_counts(sets: list[np.ndarray]) -> np.ndarray:
    """How many shingles each two sets have in common."""
    n = len(sets)
    common = np.zeros((n, n), dtype=np.int32)
    rows = np.repeat(np.arange(n), [len(s) for s in sets])
    values = np.concatenate(sets) if sets else np.empty(0, np.uint64)
    order = np.argsort(values, kind="stable")
    rows, values = rows[order], values[order]
    starts = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]])) if len(values) else np.empty(0, int)
    counts = np.diff(np.append(starts, len(values)))
    code = np.repeat(np.arange(len(counts)), counts)

    few = np.repeat((counts > 1) & (counts <= FEW), counts)
    r, c = rows[few], code[few]
    for apart in range(1, FEW):  # in each run of a shingle, all rows so far apart
        same = c[:-apart] == c[apart:]
        if not same.any():
            break
        np.add.at(common, (r[:-apart][same], r[apart:][same]), 1)
        np.add.at(common, (r[apart:][same], r[:-apart][same]), 1)

    many = np.flatnonzero(counts > FEW)
    for first in range(0, len(many), 512):
        some = many[first : first + 512]
        held = np.zeros((n, len(some)), dtype=np.float32)
        place = np.full(len(counts), -1)
        place[some] = np.arange(len(some))
        at = place[code]
        held[rows[at >= 0], at[at >= 0]] = 1
        common += (held @ held.T).astype(np.int32)
    np.fill_diagonal(common, [len(s) for s in sets])
    return common


def linked(sets: list[np.ndarray], threshold: float) -> np.ndarray:
    """Which two different sets are at least so similar."""
    common = common_counts(sets)
    sizes = np.array([len(s) for s in sets])
    links = np.zeros(common.shape, dtype=bool)
    for first in range(0, len(sets), 128):
        rows = slice(first, first + 128)
        union = sizes[rows, None] + sizes[None, :] - common[rows]
        links[rows] = common[rows] / np.maximum(union, 1) >= threshold
    np.fill_diagonal(links, False)
    return links


def _roots(links: np.ndarray) -> np.ndarray:
    """The least member of each one's component."""
    root = np.full(len(links), -1)
    for i in range(len(links)):
        if root[i] < 0:
            root[i], todo = i, [i]
            while todo:
                near = np.flatnonzero(links[todo.pop()] & (root < 0))
                root[near] = i
                todo.extend(near.tolist())
    return root


def _verify_task(task: pa.Table, threshold: float) -> dict[str, list]:
    """Links and a spanning forest of the pairs that this task is to compare."""
    cid = np.array(task.column("cid").to_pylist(), dtype=np.int64)
    _, firsts = np.unique(cid, return_index=True)  # repeated rows of a document come once
    task = task.take(pa.array(firsts))
    cid = cid[firsts]
    sets = [np.frombuffer(s.as_py(), dtype=np.uint64) for s in task.column("shingles")]
    links = linked(sets, threshold)
    first, second = (task.column(c)[0].as_py() for c in ("first", "second"))
    if first != second:
        block = np.array(task.column("block").to_pylist())
        links &= block[:, None] != block[None, :]
    tree = task.column("tree")[0].as_py()
    if tree:  # a pair is counted where it meets first
        labels = np.array(task.column("labels").to_pylist(), dtype=np.int64)
        for t in range(tree):
            links &= labels[:, t][:, None] != labels[:, t][None, :]
    copies = np.array(task.column("copies").to_pylist(), dtype=np.int64)
    return {
        "u": cid.tolist(), "v": cid[_roots(links)].tolist(),
        "links": (links @ copies).tolist(),
    }


def _verify(threshold: float):
    schema = pa.schema([("u", pa.int64()), ("v", pa.int64()), ("links", pa.int64())])

    def verify(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for task in flush_sorted(batches, "task"):
            yield pa.RecordBatch.from_pydict(_verify_task(task, threshold), schema=schema)

    return verify


def _blocks(shingles: Column, classes: Column, block_shingles: int, block_classes: int) -> Column:
    wanted = F.greatest(shingles / block_shingles, classes / block_classes)
    return F.when(wanted <= 2, 1).otherwise(F.ceil(wanted)).cast("int")


def _tasks(classes: DataFrame, nodes: DataFrame, found: DataFrame, area: StagingArea, trees: int, block_shingles: int, block_classes: int) -> DataFrame:
    """``cid`` and every task that it belongs to: ``task, tree, first, second, block``."""
    sized = found.join(classes.select(F.col("cid").alias("node"), "n"), "node")
    of = area.stage(
        sized.groupBy("component").agg(F.sum("n").alias("shingles"), F.count(F.lit(1)).alias("members"))
        .withColumn("blocks", _blocks(F.col("shingles"), F.col("members"), block_shingles, block_classes)),
        "weights",
    )
    placed = found.join(of, "component").select(F.col("node").alias("cid"), "component", "blocks")
    whole = placed.where(F.col("blocks") <= trees).select(
        "cid", F.col("component").alias("place"), F.lit(0).alias("tree"), "blocks"
    )
    # Components of more blocks than trees: by the nodes of the trees, cut where they are large.
    large = placed.where(F.col("blocks") > trees).select("cid")
    entries = nodes.join(large, "cid")
    weights = (
        entries.join(classes.select("cid", "n"), "cid").groupBy("node")
        .agg(F.sum("n").alias("shingles"), F.count(F.lit(1)).alias("members"))
        .withColumn("blocks", _blocks(F.col("shingles"), F.col("members"), block_shingles, block_classes))
    )
    by_node = entries.join(weights.select("node", "blocks"), "node").select(
        "cid", F.col("node").alias("place"), "tree", "blocks"
    )
    own = F.pmod(F.xxhash64("cid", "place"), F.col("blocks")).cast("int")
    spread = (
        whole.unionByName(by_node).withColumn("block", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumn("first", F.least("block", "other")).withColumn("second", F.greatest("block", "other"))
    )
    # Pairs within a block are compared by its own task, pairs of two blocks by theirs.
    return spread.withColumn("task", F.xxhash64("place", "tree", "first", "second")).drop("other", "place", "blocks")


def link(
    docs: DataFrame,
    area: StagingArea,
    text: str = "text",
    doc_id: str = "doc_id",
    threshold: float = THRESHOLD,
    trees: int = TREES,
    longest: int = LONGEST,
    recall: float = RECALL,
    block_shingles: int = BLOCK_SHINGLES,
    block_classes: int = BLOCK_CLASSES,
) -> DataFrame:
    """One row per document: ``id, digest, class_id, rep_digest, n_shingles, n_links``.

    Shingles are five words in a row, words being runs without white space; a text of one to
    four words is one shingle. ``n_links`` is the number of other documents whose shingle
    sets have a Jaccard similarity of ``threshold`` at least, copies included. ``class_id`` is the
    least id of all documents that links connect, ``rep_digest`` the digest of that one's
    shingles. A document without words has no links, a null digest and its own id as class.
    Null ids are never a class id where another one is there. Rows that repeat each other link
    each other. Other columns are not looked at; an empty table gives an empty one.
    """
    depth = matching_depth(threshold, trees, longest, recall)
    sketched = area.stage(
        docs.select(
            column(doc_id).cast("bigint").alias("id"),
            F.arrow_udf(_sketch(trees, depth), "digest binary, n bigint, labels array<bigint>")(column(text)).alias("s"),
        ).select("id", "s.*"),
        "sketches",
    )
    classes = area.stage(
        sketched.where("n > 0").groupBy("digest")
        .agg(F.count(F.lit(1)).alias("copies"), F.min("id").alias("rep_id"), F.first("n").alias("n"), F.first("labels").alias("labels"))
        .withColumn("cid", F.monotonically_increasing_id()),
        "classes",
    )
    entries = classes.select("cid", F.posexplode("labels").alias("tree", "node"))
    shared = area.stage(
        entries.groupBy("node").agg(F.count(F.lit(1)).alias("members"), F.min("cid").alias("v")).where("members > 1"),
        "shared",
    )
    nodes = area.stage(entries.join(shared.select("node", "v"), "node"), "nodes")
    found = area.stage(components(nodes.select(F.col("cid").alias("u"), "v"), area, "candidates"), "found")
    tasks = _tasks(classes, nodes.drop("v"), found, area, trees, block_shingles, block_classes)

    # The texts of one document per class that is in a task, read and cut once more. Others are left
    # out by a bitmap of the ids before anything is shuffled.
    wanted = area.stage(
        classes.join(found.select(F.col("node").alias("cid")), "cid").select("cid", "digest", "rep_id", "copies", "labels"),
        "wanted",
    )
    texts = docs.select(column(doc_id).cast("bigint").alias("id"), column(text).alias("text"))
    bitmap = mark(wanted, F.xxhash64("rep_id"))
    texts = texts.where(may_have(docs.sparkSession, bitmap, F.xxhash64("id")))
    cut = F.arrow_udf(_shingles, "digest binary, shingles binary")(F.col("text"))
    sets = (
        texts.join(wanted, F.col("id").eqNullSafe(F.col("rep_id")))
        .withColumn("s", cut).where(F.col("s.digest") == F.col("digest"))
        .select("cid", "copies", "labels", F.col("s.shingles").alias("shingles"))
    )
    verified = area.stage(
        tasks.join(sets, "cid").repartition("task").sortWithinPartitions("task")
        .select("task", "tree", "first", "second", "block", "cid", "copies", "labels", "shingles")
        .mapInArrow(_verify(threshold), "u bigint, v bigint, links bigint"),
        "verified",
    )
    joined = area.stage(components(verified.select("u", "v"), area, "links"), "joined")
    counted = verified.groupBy(F.col("u").alias("cid")).agg(F.sum("links").alias("links"))
    named = (
        classes.select("cid", "digest", "rep_id", "copies")
        .join(joined.withColumnRenamed("node", "cid"), "cid", "left")
        .join(counted, "cid", "left")
        .withColumn("component", F.coalesce("component", "cid"))
    )
    first = F.min(F.struct(F.col("rep_id").isNull().alias("unknown"), "rep_id", "digest")).alias("first")
    heads = named.groupBy("component").agg(first)
    decided = area.stage(
        named.join(heads, "component").select(
            "digest", F.col("first.rep_id").alias("class_id"), F.col("first.digest").alias("rep_digest"),
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        ),
        "decided",
    )
    with_words = sketched.where("n > 0").join(decided, "digest").select(
        "id", "digest", "class_id", "rep_digest", F.col("n").alias("n_shingles"), "n_links"
    )
    without = sketched.where("n = 0").select(
        "id", "digest", F.col("id").alias("class_id"), F.col("digest").alias("rep_digest"),
        F.col("n").alias("n_shingles"), F.lit(0).cast("bigint").alias("n_links"),
    )
    return with_words.unionByName(without)


def keep_one(docs: DataFrame, area: StagingArea, text: str = "text", doc_id: str = "doc_id", **options) -> DataFrame:
    """The documents with all their columns, one of each class: that with the least id.

    Documents without words all stay. Of rows that agree in id and shingles one stays.
    """
    linked_docs = link(docs, area, text, doc_id, **options)
    heads = linked_docs.where(F.col("id").eqNullSafe(F.col("class_id")) & (F.col("digest") == F.col("rep_digest")))
    winners = area.stage(heads.groupBy("id", "digest").agg(F.count(F.lit(1)).alias("rows")), "winners")
    into, key, again = fresh(docs, "shingle_digest"), fresh(docs, "kept_key"), fresh(docs, "rows_of_key")
    marked = docs.withColumn(into, F.arrow_udf(_digests, "binary")(column(text)))
    right = winners.select(F.struct("id", "digest").alias(key), F.col("rows").alias(again))
    own = F.struct(column(doc_id).cast("bigint"), F.col(into))
    joined = marked.where(F.col(into).isNotNull()).join(right, own.eqNullSafe(F.col(key)))
    columns = [column(c) for c in docs.columns]
    once = joined.where(F.col(again) == 1).select(*columns)
    repeated = joined.where(F.col(again) > 1).dropDuplicates([key]).select(*columns)
    return once.unionByName(repeated).unionByName(marked.where(F.col(into).isNull()).select(*columns))
