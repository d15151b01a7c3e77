import hashlib
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from agreement import connect, difference

from rowgate.llm import marks, winnowing
from rowgate.llm.queries import ORACLES, QUERIES

from llm_cases import SMALL, edge_rows


def words_of(text):
    folded = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", folded)


def plain(docs, items):
    """``doc_id, n_words, hit words, item ids`` by comparing every window."""
    windows = {}
    for item, text in items:
        words = words_of(text)
        n = min(10, len(words))
        for i in range(len(words) - n + 1 if n else 0):
            windows.setdefault(tuple(words[i : i + n]), set()).add("" if item is None else str(item))
    rows = []
    for doc_id, text in docs:
        words, hit, found = words_of(text), set(), set()
        for n in {len(w) for w in windows}:
            for i in range(len(words) - n + 1):
                if (of := windows.get(tuple(words[i : i + n]))) is not None:
                    hit |= set(range(i, i + n))
                    found |= of
        rows.append((doc_id, len(words), tuple(sorted(hit)), tuple(sorted(found))))
    return Counter(rows)


def found_rows(df):
    return Counter(
        (r.id, r.n_words, tuple(i for s in r.spans for i in range(s.start, s.end)), tuple(r.items)) for r in df.collect()
    )


def check(spark, area, docs, items, parts=3):
    d = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(parts)
    b = spark.createDataFrame(items, "item_id bigint, text string").repartition(parts)
    assert found_rows(winnowing.contamination(d, b, area)) == plain(docs, items)


def test_query_agrees_with_sql_on_more_rows(spark):
    folder = SMALL.replace("0.001", "0.01")
    assert difference(QUERIES["op11_winnowing"](spark, folder), connect(folder), ORACLES["op11_winnowing"]) == ""


def test_every_shared_span_of_ten_words_is_found(spark, area):
    """Few words, so grams and windows repeat and overlap; passages at all places and of all lengths."""
    rng = random.Random(3)
    items = [(i, " ".join(rng.choice("abc") for _ in range(rng.randrange(0, 40)))) for i in range(30)]
    docs = []
    for i in range(120):
        text = [rng.choice("abcdefgh") for _ in range(rng.randrange(0, 60))]
        at, item = rng.randrange(0, len(text) + 1), rng.choice(items)[1].split()
        first = rng.randrange(0, len(item) + 1)
        text[at:at] = item[first : first + rng.randrange(1, 25)]
        docs.append((i, " ".join(text)))
    check(spark, area, docs, items)


def test_short_items_cases_and_marks(spark, area):
    items = [(1, "One, TWO three!"), (2, "solo"), (3, "été 42 naïve"), (4, ""), (5, None), (6, "--- !"), (None, "two three")]
    docs = [(1, "x one-two;three y"), (2, "SOLO"), (3, "Été 42 naïve"), (4, "été 42\x00naïve solo"), (5, "one two, three two three"),
            (6, None), (7, ""), (8, "?!"), (None, "solo"), (None, "solo"), (9, "É 42 naïve")]
    check(spark, area, docs, items)


def test_edge_rows(spark, edge, empty, area):
    items = [(4, edge_rows()[3][1]), (5, edge_rows()[3][1]), (8, edge_rows()[8][1][:5000]), (9, "one two")]
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    docs = [(d, t) for d, t, _ in edge_rows()]
    assert found_rows(winnowing.contamination(edge, benchmark, area)) == plain(docs, items)
    assert winnowing.contamination(empty, benchmark, area).count() == 0
    assert found_rows(winnowing.contamination(edge, benchmark.where("false"), area)) == plain(docs, [])


def test_a_passage_of_many_documents_and_items_makes_no_pairs(spark, area):
    passage = " ".join(f"p{i}" for i in range(12))
    docs = spark.range(3000).selectExpr("id as doc_id", f"concat('d', id, ' {passage} e', id) as text")
    items = spark.range(300).selectExpr("id as item_id", f"concat('i', id, ' {passage} j', id) as text")
    rows = winnowing.contamination(docs, items, area).select("spans", "items").distinct().collect()
    assert len(rows) == 1 and len(rows[0]["items"]) == 300 and [tuple(s) for s in rows[0]["spans"]] == [(1, 13)]
    hits = area.tables["hits"]
    assert hits.selectExpr("max(size(sets))").first()[0] == 1 and hits.select("signature").distinct().count() == 1


def test_bitmap_has_a_fixed_size_and_all_fingerprints(spark, area):
    items = spark.createDataFrame([(i, f"w{i} x{i}") for i in range(500)], "item_id bigint, text string")
    table = winnowing.item_windows(items)
    bitmap = marks.mark(table, table.fingerprint)
    prints = np.array([r.fingerprint for r in table.collect()], np.int64).view(np.uint64)
    assert len(bitmap) == 1 << 23 and marks.marked(bitmap, prints).all()
    assert int(np.unpackbits(bitmap).sum()) <= 500


@pytest.mark.parametrize("segment", [1, 7, 1 << 22])
def test_long_texts_are_hashed_in_segments(monkeypatch, segment):
    texts = pa.array(["Ab cd ef" * 5, None, "", "ab", " é"])
    whole, starts = winnowing.folded_words(texts)
    monkeypatch.setattr(winnowing, "_SEGMENT", segment)
    parts, again = winnowing.folded_words(texts)
    assert (whole == parts).all() and (starts == again).all()
    assert np.diff(starts).tolist() == [len(words_of(t)) for t in texts.to_pylist()]


def test_hashes_of_items_are_as_stated(spark):
    rows = QUERIES["op11_winnowing"](spark, SMALL).collect()
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    items = spark.read.parquet(f"{SMALL}/benchmark.parquet").select("item_id", "text").collect()
    expected = {d: (n, len(h), len(i), hashlib.sha256(",".join(i).encode()).hexdigest(), bool(h)) for d, n, h, i in plain(docs, items)}
    assert {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in rows} == expected
    assert any(r.contaminated for r in rows)
