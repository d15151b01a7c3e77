from collections import Counter

import pytest
from pyspark.sql import functions as F

from rowgate.llm import quality_ledger as ledger


def plain_repeats(words):
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    counts = Counter(windows)
    return len({i + k for i, w in enumerate(windows) if counts[w] > 1 for k in range(3)})


@pytest.mark.parametrize("text", ["", "a b c", "a a a a", "a b c x a b c", "a b a b a b", "x y z y z y z q x y z"])
def test_repeated_words_agree_with_counting(text):
    assert ledger.measure(text.encode())[5] == plain_repeats(text.split())


def test_measures():
    text = "Ünï | #1\nsame line\nsame line\n\n  \nsame line "
    n_words, chars, symbols, n_lines, dup, _ = ledger.measure(text.encode())
    assert (n_words, chars, symbols, n_lines, dup) == (9, 3 + 1 + 2 + 3 * 8, 2, 4, 1)


def test_only_the_six_blanks_separate_words():
    assert ledger.measure("a b\x1cc\x0bd\x0ce".encode())[0] == 3


def test_edge_rows_have_a_defined_result(edge):
    rows = ledger.with_ledger(edge, into="marks").select("doc_id", "text", "marks.*").collect()
    assert len(rows) == edge.count()
    for row in rows:
        if not (row.text or "").strip():
            assert row.n_words == 0 and row.fail_bits & ledger.bits_of(ledger.BASE) == 1
    long = next(r for r in rows if r.doc_id == 8)
    assert long.n_words == 60_000 and long.fail_bits == 0


def test_a_kept_document_keeps_all_columns(edge, empty):
    kept = ledger.keep_passing(edge)
    assert kept.columns == edge.columns
    assert sorted(r.doc_id for r in kept.where("doc_id is not null").collect()) == [4, 5, 5, 6, 7, 8, 12]
    assert ledger.keep_passing(empty).count() == 0


def test_policies_read_bits_only(spark):
    bits = spark.createDataFrame([(0,), (1,), (5,), (5,), (64,)], "fail_bits bigint")
    kept = {p.version: bits.where(ledger.passes(F.col("fail_bits"), p)).count() for p in ledger.POLICIES}
    assert kept == {"v1": 2, "v2": 2, "v3": 1}


def test_ablations_agree_with_applying_each_policy(spark):
    masks = [0, 0, 1, 2, 3, 4, 5, 64, 64, 68, 128]
    bits = spark.createDataFrame([(m,) for m in masks], "fail_bits bigint")
    for row in ledger.ablations(bits).collect():
        policy = next(p for p in ledger.POLICIES if p.version == row.policy)
        whole, bit = ledger.bits_of(policy.rules), ledger.bits_of([row.rule])
        assert row.kept == sum(not m & whole for m in masks)
        assert row.failed == sum(bool(m & bit) for m in masks)
        assert row.kept + row.failed_alone == sum(not m & (whole & ~bit) for m in masks)
    none = ledger.ablations(bits.where("false")).collect()
    assert len(none) == sum(len(p.rules) for p in ledger.POLICIES) and not any(r.failed for r in none)


def test_unknown_rules_are_refused():
    with pytest.raises(KeyError):
        ledger.bits_of(["no such rule"])
