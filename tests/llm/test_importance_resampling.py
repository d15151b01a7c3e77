import hashlib
import math
import re
import zlib
from collections import Counter

import pytest

from rowgate.llm import importance_resampling as resampling
from rowgate.llm.queries import QUERIES

from llm_cases import SMALL, edge_rows


def words_of(text):
    folded = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", folded)


def buckets(text):
    words = words_of(text)
    return [zlib.crc32(" ".join(words[i : i + n]).encode()) % 10000 for n in (1, 2, 3) for i in range(len(words) - n + 1)]


def plain(docs, target, percent=5, min_words=20):
    s, t = (Counter(b for text in texts for b in buckets(text)) for texts in ([x for _, x in docs], target))
    s_all, t_all = s.total(), t.total()
    rows = []
    for doc_id, text in docs:
        found = buckets(text)
        weight = sum(math.floor(1000 * math.log((t[b] + 1) * (s_all + 10000) / ((s[b] + 1) * (t_all + 10000)))) for b in found)
        h = int(hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        noise = math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([doc_id, len(words_of(text)), len(found), weight, weight + noise, None])
    able = [r for r in rows if r[1] >= min_words]
    able.sort(key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    for rank, row in enumerate(able[: percent * len(able) // 100], 1):
        row[5] = rank
    return Counter(map(tuple, rows))


def found_rows(df, key="id"):
    return Counter((r[key], r.n_words, r.n_features, r.weight, r.score, r["rank"]) for r in df.collect())


@pytest.mark.parametrize("folder", [SMALL, SMALL.replace("0.001", "0.01")])
def test_query_agrees_with_a_plain_version(spark, folder):
    docs = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    target = [r.text for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    assert found_rows(QUERIES["op12_importance_resampling"](spark, folder), "doc_id") == plain(docs, target)


def test_edge_rows(spark, edge, empty, area):
    target = ["word1 word2 word3 one", None, "", "É two"]
    wanted = spark.createDataFrame([(t,) for t in target], "text string")
    docs = [(d, t) for d, t, _ in edge_rows()]
    found = found_rows(resampling.resample(edge, wanted, area, percent=50))
    assert found == plain(docs, target, percent=50)
    assert resampling.resample(empty, wanted, area).count() == 0
    assert found_rows(resampling.resample(edge, wanted.where("false"), area)) == plain(docs, [])


def test_ties_go_to_the_smaller_id_and_repeats_have_ranks_of_their_own(spark, area):
    text = " ".join(f"w{i}" for i in range(30))
    docs = [(i % 7, text) for i in range(300)] + [(None, text)] * 300
    rows = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(5)
    found = resampling.resample(rows, spark.createDataFrame([(text,)], "text string"), area, percent=50)
    assert found_rows(found) == plain(docs, [text], percent=50)


def test_ranks_do_not_depend_on_the_ranges(spark, area, monkeypatch):
    folder = SMALL.replace("0.001", "0.01")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    scores = resampling.score(docs, spark.read.parquet(f"{folder}/benchmark.parquet"), area)
    before = found_rows(resampling.draw(scores, area))
    monkeypatch.setattr(resampling, "_PER_SORT", 17)
    assert found_rows(resampling.draw(scores, area)) == before


@pytest.mark.parametrize("block", [1, 5, 64])
def test_long_texts_are_read_in_blocks(monkeypatch, block):
    text = "One two, three-four; five\nsix " * 3
    monkeypatch.setattr(resampling, "_BLOCK", block)
    blocks = list(resampling.feature_crcs(text.encode()))
    assert sum(n for n, _ in blocks) == len(words_of(text))
    assert Counter(c % 10000 for _, crcs in blocks for c in crcs) == Counter(buckets(text))
