"""Resample documents towards a target by hashed n-gram features.

A table of 256 bytes lower-cases A-Z and blanks every byte that separates words, in UTF-8, so
``bytes.split`` yields the words. The CRC of a run of words continues the CRC of the run
without its last word, so each feature costs one call over one word. Tasks count buckets in
Counters, which one aggregation adds up: what is shuffled and what goes to the workers has a
row per bucket, whatever the corpus. Draws are Gumbel top-k: highest of weight plus noise.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from zlib import crc32

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.staging import StagingArea
from .common import column, encoded, parts_for, running_blocks

BUCKETS = 10_000
#: Words of the longest features.
LONGEST = 3
#: Gains and noise are whole thousandths.
SCALE = 1000
MIN_WORDS, PERCENT, SEED = 20, 5, 42
#: Bytes of text that are split into words at once.
_BLOCK = 1 << 20
#: Rows that a task of the ranking sorts.
_PER_SORT = 1 << 20

_SEPARATORS = {*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)}
_TABLE = bytes(b + 32 if 65 <= b <= 90 else 32 if b in _SEPARATORS else b for b in range(256))


def word_blocks(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text in lists of some ``_BLOCK`` bytes; a longer word is in a list whole."""
    folded = text.translate(_TABLE)
    first = 0
    while first < len(folded):
        end = folded.find(b" ", first + _BLOCK)
        end = len(folded) if end < 0 else end
        yield folded[first:end].split()
        first = end


def feature_crcs(text: bytes, longest: int = LONGEST) -> Iterator[tuple[int, list[int]]]:
    """For each block, how many words are new in it, and the CRCs of the runs that end in them."""
    before: list[bytes] = []
    for new in word_blocks(text):
        words = before + new
        follow = [b" " + w for w in words]
        crcs = list(map(crc32, words))
        found = crcs[len(before) :]
        for k in range(1, min(longest, len(words))):
            crcs = list(map(crc32, follow[k:], crcs))
            found += crcs[max(0, len(before) - k) :]
        yield len(new), found
        before = words[-(longest - 1) :] if longest > 1 else []


def _counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter[int] = Counter()
    for batch in batches:
        for text in encoded(batch.column(0)):
            for _, crcs in feature_crcs(text):
                counts.update([c % BUCKETS for c in crcs])
    yield pa.RecordBatch.from_arrays(
        [pa.array(list(counts), pa.int64()), pa.array(list(counts.values()), pa.int64())], names=["bucket", "n"]
    )


def bucket_counts(texts: DataFrame, text: str = "text") -> DataFrame:
    """``bucket, n``: the features of all texts per bucket that has any."""
    counted = texts.select(column(text)).mapInArrow(_counted, "bucket bigint, n bigint")
    return counted.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(source: DataFrame, target: DataFrame) -> DataFrame:
    """``bucket, gain``: for every bucket, how much likelier the target is to use it, in thousandths of e."""
    totals = source.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("s_all")).crossJoin(  # one row each
        target.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("t_all"))
    )
    every = source.sparkSession.range(BUCKETS).withColumnRenamed("id", "bucket")
    counts = every.join(source.withColumnRenamed("n", "s"), "bucket", "left").join(
        target.withColumnRenamed("n", "t"), "bucket", "left"
    )

    def smoothed(c: str, by: int) -> Column:
        return F.coalesce(F.col(c), F.lit(0)).cast("double") + by

    ratio = smoothed("t", 1) * smoothed("s_all", BUCKETS) / (smoothed("s", 1) * smoothed("t_all", BUCKETS))
    return counts.crossJoin(totals).select("bucket", F.floor(SCALE * F.log(ratio)).alias("gain"))


def weigh(texts: Column, table: list[int], spark) -> Column:
    """``n_words, n_features, weight`` of a text: the sum of the gains of its features."""
    shared = spark.sparkContext.broadcast(table)

    def weighed(column_of: pa.Array) -> pa.Array:
        gain, rows = shared.value, []
        for text in encoded(column_of):
            words = features = weight = 0
            for new, crcs in feature_crcs(text):
                words += new
                features += len(crcs)
                weight += sum([gain[c % BUCKETS] for c in crcs])
            rows.append((words, features, weight))
        return pa.StructArray.from_arrays(
            [pa.array([row[i] for row in rows], pa.int64()) for i in range(3)], names=["n_words", "n_features", "weight"]
        )

    return F.arrow_udf(weighed, "n_words bigint, n_features bigint, weight bigint")(texts)


def noise(doc_id: Column, seed: int = SEED) -> Column:
    """Gumbel noise in whole thousandths, from a hash of the id; a null id counts as empty."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-SCALE * F.log(-F.log((h + 0.5) / 4294967296.0)))


def score(docs: DataFrame, target: DataFrame, area: StagingArea, text: str = "text", doc_id: str = "doc_id",
          target_text: str = "text") -> DataFrame:
    """``place, id, n_words, n_features, weight, score`` of every document, as a written table.

    A null text has no words and weighs 0. Rows that repeat each other score alike; ``place``
    tells them apart. Other columns, whatever their names, are not looked at; an empty table of
    documents gives an empty one, an empty target equal gains for equal counts.
    """
    source = area.stage(bucket_counts(docs, text), "source-counts")
    wanted = area.stage(bucket_counts(target, target_text), "target-counts")
    table = [0] * BUCKETS
    for row in gains(source, wanted).collect():  # BUCKETS rows
        table[row["bucket"]] = row["gain"]
    rows = docs.select(
        column(doc_id).cast("bigint").alias("id"), weigh(column(text), table, docs.sparkSession).alias("w")
    ).select("id", "w.*")
    return area.stage(
        rows.select(
            F.monotonically_increasing_id().alias("place"), "*", (F.col("weight") + noise(F.col("id"))).alias("score")
        ),
        "scores",
    )


def draw(scores: DataFrame, area: StagingArea, percent: int = PERCENT, min_words: int = MIN_WORDS) -> DataFrame:
    """``scores`` with ``rank``: 1, 2, 3 ... for the drawn documents, null for all others.

    Of the documents with ``min_words`` or more, ``percent`` in a hundred are drawn, rounded
    down, by highest score, then smallest id, null last. Ranks come from counts per range of
    scores, so no task holds all rows; equal scores and ids are dealt over tasks by place.
    """
    able = scores.where(F.col("n_words") >= min_words)
    n = able.count()
    order = [F.col("score").desc(), F.col("id").asc_nulls_last(), F.col("place")]
    sorted_rows = able.repartitionByRange(parts_for(scores.sparkSession, n, _PER_SORT), *order).sortWithinPartitions(*order)
    placed = area.stage(sorted_rows.withColumn("at", F.monotonically_increasing_id()), "sorted")
    placed = placed.withColumn("task", F.shiftright("at", 33))
    counts = placed.groupBy("task").agg(F.count(F.lit(1)).alias("n"))
    before = area.stage(running_blocks(counts, "task", "task", {"before": "n"}), "before")
    rank = F.col("before") + F.col("at").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    ranked = placed.join(before, "task").select(
        *scores.columns, F.when(rank <= percent * n // 100, rank).alias("rank")
    )
    rest = scores.where(F.col("n_words") < min_words).withColumn("rank", F.lit(None).cast("bigint"))
    return ranked.unionByName(rest)


def resample(docs: DataFrame, target: DataFrame, area: StagingArea, percent: int = PERCENT, min_words: int = MIN_WORDS,
             **names) -> DataFrame:
    """Every document with its score and, if it is drawn, its rank."""
    return draw(score(docs, target, area, **names), area, percent, min_words)
