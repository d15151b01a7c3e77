import hashlib
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from rowgate.llm import exact_dedup as dedup


def digests(n, seed=0):
    return np.stack([np.frombuffer(hashlib.sha256(f"{seed}-{i}".encode()).digest(), np.uint8) for i in range(n)])


@pytest.mark.parametrize("n", [1, 2, 7, 100, 5000])
def test_the_hash_is_minimal_and_perfect(n):
    keys = digests(n)
    pilots, slots = dedup.build_slots(keys)
    assert sorted(slots.tolist()) == list(range(n))
    assert (dedup.find_slots(keys, pilots, n) == slots).all()


def plain(rows):
    """keep_id and group size per row, by sorting."""
    groups = {}
    for doc_id, text, _ in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", text or ""), []).append((doc_id, len(text or "")))
    out = []
    for doc_id, text, _ in rows:
        key = re.sub(r"[\x20\x09-\x0D]", "", text or "")
        best = min(groups[key], key=lambda x: (-x[1], x[0] is None, x[0] or 0))
        out.append((doc_id, hashlib.sha256(key.encode()).hexdigest(), best[0], len(groups[key])))
    return sorted(out, key=str)


@pytest.mark.parametrize("history", ["false", "true", "doc_id <= 5", "doc_id > 5", "text is null or doc_id % 2 = 0"])
def test_any_history_gives_the_same_groups(edge, area, history):
    from llm_cases import edge_rows

    rows = dedup.decide(edge, F.expr(history), area).collect()
    found = sorted(((r.id, bytes(r.digest).hex(), r.keep_id, r.group_size) for r in rows), key=str)
    assert found == plain(edge_rows())


def test_slots_are_those_of_the_history(edge, area):
    rows = dedup.decide(edge, F.expr("doc_id = 4"), area).collect()
    assert {r.slot for r in rows if r.group_size == 6} == {0}
    assert all(r.slot is None for r in rows if r.group_size != 6)


def test_a_nonmember_is_told_by_its_bytes():
    known, asked = digests(50), digests(50, seed=1)
    table = pa.table({"digest": [d.tobytes() for d in known], "bucket": [0] * 50, "winner": list(range(50)),
                      "n_chars": [1] * 50, "copies": [1] * 50})
    probe = pa.table({"digest": [d.tobytes() for d in np.concatenate([asked, known[:3]])], "bucket": [0] * 53,
                      "copies": [1] * 53, "winner": [0] * 53, "n_chars": [1] * 53})
    found = dedup._probe(dedup._build(table), probe)
    assert found.column("slot").null_count == 50
    assert found.column("old_winner").to_pylist()[-3:] == [0, 1, 2]


def test_survivors_have_all_columns_and_come_once(edge, empty, area):
    kept = dedup.drop_duplicates(edge, F.expr("doc_id < 6"), area)
    assert kept.columns == edge.columns
    ids = sorted((r.doc_id for r in kept.collect()))
    # Of equal texts the longest (6), of those without words the blank one; equal rows once.
    assert ids == [3, 6, 8, 9, 11, 12, 13]
    assert dedup.drop_duplicates(empty, F.lit(True), area).count() == 0


def test_a_repeated_winner_stays_once(spark, area):
    rows = [(1, "same"), (1, "same"), (2, "same"), (None, "other"), (None, "other")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    kept = dedup.drop_duplicates(docs, dedup.older_half(docs), area).collect()
    assert sorted(map(tuple, kept), key=str) == [(1, "same"), (None, "other")]
