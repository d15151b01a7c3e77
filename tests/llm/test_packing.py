import random
from collections import defaultdict

import pytest

from rowgate.llm import constrained_packing as packing
from rowgate.llm.queries import QUERIES

from llm_cases import SMALL, edge_rows


def plain_pack(sizes, sources, clusters, capacity):
    """Room left of each bin, by looking at all bins for each piece."""
    bins = []
    for size, source, cluster in zip(sizes, sources, clusters):
        fits = [b for b in bins if b[0] >= size and source not in b[1] and cluster not in b[2]]
        if fits:
            best = min(fits, key=lambda b: b[0])
        else:
            best = [capacity, set(), set()]
            bins.append(best)
        best[0] -= size
        best[1].add(source)
        best[2].add(cluster)
    return bins


@pytest.mark.parametrize("seed", range(6))
def test_every_piece_goes_to_a_tightest_compatible_bin(seed):
    rng = random.Random(seed)
    n, capacity = 300, 64
    sizes = sorted((rng.randrange(1, 65) for _ in range(n)), reverse=True)
    sources = [rng.choice("aaab" + "cdefgh") for _ in range(n)]
    clusters = [rng.choice([0, 0, *range(1, 200)]) for _ in range(n)]
    state = defaultdict(lambda: [capacity, set(), set()])
    for (number, start), size, source, cluster in zip(packing.pack(sizes, sources, clusters, capacity), sizes, sources, clusters):
        own = state[number]
        assert start == capacity - own[0] and own[0] >= size and source not in own[1] and cluster not in own[2]
        others = [b[0] for b in state.values() if b[0] >= size and b[1] and source not in b[1] and cluster not in b[2]]
        assert own[0] == min(others, default=capacity)
        own[0] -= size
        own[1].add(source)
        own[2].add(cluster)


def test_as_few_bins_as_the_plain_search_without_ties():
    rng = random.Random(9)
    sizes = sorted(rng.sample(range(1, 2000), 400), reverse=True)
    sources, clusters = [rng.randrange(30) for _ in sizes], list(range(400))
    found = packing.pack(sizes, sources, clusters, 2048)
    expected = plain_pack(sizes, sources, clusters, 2048)
    assert abs(len({b for b, _ in found}) - len(expected)) <= 0.03 * len(expected)


def check(rows, expected, capacity):
    bins = defaultdict(list)
    for r in rows:
        bins[r.bin].append(r)
    for held in bins.values():
        held.sort(key=lambda r: r.bin_start)
        assert [r.bin_start for r in held] == [sum(x.size for x in held[:i]) for i in range(len(held))]
        assert sum(r.size for r in held) <= capacity
        assert len({r.source for r in held}) == len({r.cluster for r in held}) == len(held)
    whole = defaultdict(list)
    for r in rows:
        whole[r.id, r.n_tokens].append((r.piece, r.size))
    assert sum(n == sum(s for _, s in p) / max(1, len([x for x in p if x[0] == 0])) for (_, n), p in whole.items()) == len(whole)
    assert sum(1 for r in rows if r.piece == 0) == len(expected)


def test_edge_rows(edge, empty, area):
    from rowgate.llm.queries import TOKENIZER

    check(packing.pack_documents(edge, area, TOKENIZER, 64).collect(), edge_rows(), 64)
    assert packing.pack_documents(empty, area, TOKENIZER).count() == 0


def test_query(spark, small):
    rows = QUERIES["op7_constrained_packing"](spark, SMALL).withColumnRenamed("doc_id", "id").collect()
    check(rows, small, 2048)
    assert sum(r.size for r in rows) / len({r.bin for r in rows}) / 2048 > 0.9


def test_more_blocks_hold_the_same_rules(spark, small, area, monkeypatch):
    from rowgate.llm.queries import TOKENIZER

    monkeypatch.setattr(packing, "PER_BLOCK", 30)
    docs = spark.createDataFrame(small, "doc_id bigint, text string, source string")
    check(packing.pack_documents(docs, area, TOKENIZER).collect(), small, 2048)


def test_repeated_rows_are_dealt_over_the_blocks(spark, area, monkeypatch):
    from rowgate.llm.queries import TOKENIZER

    monkeypatch.setattr(packing, "PER_BLOCK", 30)
    docs = spark.createDataFrame([(None, "the same words", "a")] * 300, "doc_id bigint, text string, source string")
    rows = packing.pack_documents(docs, area, TOKENIZER, 64).collect()
    sizes = defaultdict(int)
    for r in rows:
        sizes[r.bin >> 32] += 1
    assert len(rows) == len({r.bin for r in rows}) == 300 and len(sizes) == 10 and max(sizes.values()) < 60
