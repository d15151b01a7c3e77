import math
from collections import Counter, defaultdict

import pytest

from rowgate.llm import entropy_mixing as mixing
from rowgate.llm.queries import QUERIES

from llm_cases import SMALL, edge_rows


def words(text):
    return len((text or "").encode().split())


def plain_targets(rows):
    sizes = Counter()
    for _, text, source in rows:
        sizes[source] += words(text)
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    left, full = 1.5 * sum(sizes.values()), set()
    while True:
        open_ = [s for s in order if s not in full]
        level = (left - sum(2 * sizes[s] for s in full)) / sum(weight[s] for s in open_) if open_ else 0
        above = {s for s in open_ if weight[s] * level > 2 * sizes[s]}
        if not above:
            return sizes, {s: 2 * sizes[s] if s in full else weight[s] * level for s in order}
        full |= above


def check(rows, expected, slack):
    sizes, targets = plain_targets(expected)
    taken = Counter()
    for r in rows:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(targets[r.source])
        assert r.taken in (0, r.size, 2 * r.size) and r.taken == r.copies * r.size
        taken[r.source] += r.taken
    assert Counter((r.id, r.size) for r in rows) == Counter((d, words(t)) for d, t, _ in expected)
    for source, target in targets.items():
        largest = max(words(t) for _, t, s in expected if s == source)
        assert abs(taken[source] - target) <= max(slack * target, largest)


def test_query(spark, small):
    query = QUERIES["op9_entropy_mixing"]
    rows = query(spark, SMALL).withColumnRenamed("doc_id", "id").collect()
    check(rows, small, 0.02)
    again = query(spark, SMALL).withColumnRenamed("doc_id", "id").collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))


def test_rates_solve_the_dual(spark, small):
    """One multiplier per source explains the rates, and the rates meet the targets."""
    by_source = defaultdict(list)
    for r in QUERIES["op9_entropy_mixing"](spark, SMALL).collect():
        by_source[r.source].append(r)
    for rows in by_source.values():
        assert sum(r.rate * r.size for r in rows) == pytest.approx(rows[0].target, rel=1e-4)
        tilts = [math.log(r.rate) / r.size for r in rows if r.size and 1e-6 < r.rate < 2]
        assert max(tilts, default=0) - min(tilts, default=0) < 1e-9


def test_edge_rows(edge, empty, area):
    check(mixing.taken(edge, area).collect(), edge_rows(), 0.0)
    assert mixing.taken(empty, area).count() == 0


def test_targets_stop_at_twice_the_source(spark):
    sizes = spark.createDataFrame([("a", 10), ("b", 1000), ("c", 500), (None, 0)], "source string, source_size bigint")
    found = {r.source: r.target for r in mixing.targets(sizes).collect()}
    # 2265 words by weights 3, 1, 2, 3: a is full at 20, the source without words at 0.
    assert found == pytest.approx({"a": 20, "b": 2245 - 1000, "c": 1000, None: 0})


def test_the_mix_repeats_whole_rows(edge, empty, area):
    mixed = mixing.mix(edge, area)
    assert mixed.columns == edge.columns
    found = Counter((r.doc_id, r.text, r.source) for r in mixed.collect())
    ledger = mixing.taken(edge, area).collect()
    assert sum(found.values()) == sum(r.copies for r in ledger)
    assert max(found.values()) <= 4  # two rows are equal
    assert mixing.mix(empty, area).count() == 0


def test_rows_without_ids_are_told_apart_by_their_texts(spark, area):
    rows = [(i, f"{i} b c d e f g", "a") for i in range(300)] + [(None, f"{i} b c d e f g", "b") for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    taken = mixing.taken(docs, area).collect()
    check(taken, rows, 0.0)
    without = [r.taken for r in taken if r.source == "b"]
    assert set(without) == {7, 14} and sum(without) == 7 * 750  # neither all nor none get one more
    mixed = Counter(r.source for r in mixing.mix(docs, area).collect())
    assert mixed["b"] * 7 == sum(without)
