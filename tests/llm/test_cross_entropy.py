import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from rowgate.llm import cross_entropy
from rowgate.llm.queries import QUERIES

from llm_cases import SMALL, edge_rows


def word_pairs(text):
    words = [None, *(w for w in re.split("[\x20\x09-\x0d]+", text or "") if w), None]
    return list(zip(words, words[1:]))


def plain_scores(docs, wanted, delta=0.1):
    """Scores by counting words and pairs of all and of the wanted documents."""
    pairs = [word_pairs(t) for _, t in docs]
    models = []
    for own in (pairs, [p for p, (d, _) in zip(pairs, docs) if d is not None and d in wanted]):
        second = Counter(p for ps in own for p in ps)
        first, word = Counter(), Counter()
        for (a, b), n in second.items():
            first[a] += n
            word[b] += n
        models.append((second, first, word, word.total()))
    size = len(models[0][2])

    def loss(model, a, b):
        second, first, word, total = model
        alone = (word[b] + delta) / (total + delta * size)
        after = (second[a, b] + delta) / (first[a] + delta * size)
        return -(math.log2(alone) + math.log2(after)) / 2

    return [sum(loss(models[1], *p) - loss(models[0], *p) for p in ps) / len(ps) for ps in pairs]


def rounded(rows):
    return Counter((d, n, round(s, 6)) for d, n, s in rows)


def expected(docs, wanted):
    return rounded((d, len(word_pairs(t)), s) for (d, t), s in zip(docs, plain_scores(docs, wanted)))


def found_rows(df, key="id"):
    return rounded((r[key], r.n_tokens, r.score) for r in df.collect())


def test_query_agrees_with_counting(spark, small):
    labels = spark.read.parquet(f"{SMALL}/labels.parquet").where("quality = 1")
    wanted = {r.doc_id for r in labels.collect()}
    found = found_rows(QUERIES["op5_cross_entropy"](spark, SMALL), "doc_id")
    assert found == expected([(d, t) for d, t, _ in small], wanted)


def test_scores_part_held_out_documents(spark, area):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").select("doc_id", "quality")
    held_out = F.xxhash64("doc_id") % 2 == 0
    scores = cross_entropy.score_by_labels(docs, labels.where(~held_out), area)
    rows = scores.join(labels.where(held_out), F.col("id") == F.col("doc_id")).select("score", "quality").collect()
    good, bad = ([r.score for r in rows if r.quality == q] for q in (1, 0))
    assert np.mean([g < b for g in good for b in bad]) > 0.98


@pytest.mark.parametrize("block_tokens, per_bucket", [(1, 3), (100, 50), (1 << 20, 1 << 21)])
def test_edge_rows_in_blocks_and_buckets_of_any_size(spark, edge, empty, area, block_tokens, per_bucket):
    labels = spark.createDataFrame([(4, 1), (4, 0), (8, 0), (None, 1), (99, 1), (5, 1)], "doc_id bigint, quality int")
    docs = [(d, t) for d, t, _ in edge_rows()]
    if block_tokens < 100:
        edge, docs = edge.where("doc_id is null or doc_id <> 8"), [d for d in docs if d[0] != 8]
    wanted = labels.where("quality = 1").select("doc_id")
    sizes = {"block_tokens": block_tokens, "per_bucket": per_bucket}
    assert found_rows(cross_entropy.score(edge, wanted, area, **sizes)) == expected(docs, {4, 5})
    assert cross_entropy.score(empty, wanted, area, **sizes).count() == 0


def test_no_wanted_documents_leave_the_uniform_model(spark, edge, area):
    none = spark.createDataFrame([], "doc_id bigint, quality int")
    docs = [(d, t) for d, t, _ in edge_rows() if d in (4, 9)]
    rows = cross_entropy.score_by_labels(edge.where("doc_id in (4, 9)"), none, area)
    assert found_rows(rows) == expected(docs, set())


def test_words_tell_texts_of_the_same_letters_apart(spark, area):
    rows = [(i, "  1zzz1  2zzz2  " if i < 10 else "  1zzz2  2zzz1  ") for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, 1) for i in range(5)], "doc_id bigint, quality int")
    found = {r.id: r for r in cross_entropy.score_by_labels(docs, labels, area).collect()}
    assert found[7].score < 0 < found[17].score


def test_a_pair_of_all_documents_is_asked_for_once_per_block(spark, area):
    """What is shuffled does not grow with the documents that share it, but with the words and pairs there are."""
    def entries(text, n):
        docs = spark.range(n).selectExpr("id as doc_id", f"{text} as text").coalesce(1)
        blocks = area.stage(docs.select("doc_id", "text").mapInArrow(cross_entropy._encode(1 << 20), cross_entropy._BLOCKS), "b")
        asked = blocks.withColumn("wanted", F.lit(None).cast("binary")).mapInArrow(cross_entropy._requests(2, 1), cross_entropy._REQUESTS)
        return sum(len(cross_entropy.unpack(row["keys"], "<u8")) for row in asked.select("keys").collect())

    assert entries("'of the'", 500) == entries("'of the'", 5000) == 3
    assert entries("concat('w', id, ' v', id)", 4000) == 10 * entries("concat('w', id, ' v', id)", 400) == 3 * 4000


def test_numbers_come_back_from_their_bytes():
    for kind in ("<u8", "<u4", "<i8"):
        for values in ([], [1], [0, 3, 2**31 - 1, 7]):
            numbers = np.array(values, kind)
            assert cross_entropy.unpack(cross_entropy.pack(numbers), kind).tolist() == values
