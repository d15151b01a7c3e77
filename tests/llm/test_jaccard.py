from collections import Counter, defaultdict

import numpy as np
import pytest

from rowgate.llm import jaccard_forest as forest
from rowgate.llm.components import components
from rowgate.llm.queries import QUERIES
from rowgate.llm.shingles import minhashes, shingle_set, word_hashes

from llm_cases import SMALL, edge_rows


def plain_shingles(text):
    words = (text or "").encode().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def plain_links(rows, threshold=0.8):
    """Class and number of links of each row, from an inverted index."""
    sets = [plain_shingles(text) for _, text, _ in rows]
    holders, common = defaultdict(list), Counter()
    for i, s in enumerate(sets):
        for shingle in s:
            for j in holders[shingle]:
                common[j, i] += 1
            holders[shingle].append(i)
    links, parent = Counter(), list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for (i, j), n in common.items():
        if n / (len(sets[i]) + len(sets[j]) - n) >= threshold:
            links[i] += 1
            links[j] += 1
            parent[max(root(i), root(j))] = min(root(i), root(j))
    least = defaultdict(list)
    for i, (doc_id, _, _) in enumerate(rows):
        least[root(i)].append(doc_id)
    name = {r: min((d for d in ids if d is not None), default=None) for r, ids in least.items()}
    return sorted(((rows[i][0], name[root(i)], len(sets[i]), links[i]) for i in range(len(rows))), key=str)


def as_found(df):
    return sorted(((r.id, r.class_id, r.n_shingles, r.n_links) for r in df.collect()), key=str)


def near_rows():
    """Groups of near copies, chains among them, a passage that many share, and many equal texts."""
    rng = np.random.default_rng(4)
    word = lambda: "".join(rng.choice(list("abcdefgh"), 6))
    passage = [word() for _ in range(40)]
    rows = []
    for group in range(12):
        words = [word() for _ in range(120)]
        for copy in range(group + 1):
            rows.append(" ".join(words))
            words = list(words)
            words[(copy * 17 + 3) % 120] = word()
    rows += [" ".join([*passage, *(word() for _ in range(60))]) for _ in range(40)]
    rows += [rows[0]] * 30
    return [(i, text, None) for i, text in enumerate(rows)]


@pytest.mark.parametrize("options", [{}, {"block_shingles": 700, "block_classes": 8}, {"block_shingles": 90, "block_classes": 2}])
def test_all_ways_of_cutting_work_find_the_same_links(spark, area, options):
    rows = near_rows()
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    assert as_found(forest.link(docs, area, **options)) == plain_links(rows)


def test_edge_rows(edge, empty, area):
    expected = [list(x) for x in plain_links(edge_rows())]
    assert [list(x) for x in as_found(forest.link(edge, area))] == expected
    assert forest.link(empty, area).count() == 0


def test_query(spark, small):
    found = QUERIES["op10_jaccard_forest"](spark, SMALL).withColumnRenamed("doc_id", "id")
    assert as_found(found) == plain_links(small)


def test_one_of_each_class_stays(edge, empty, area):
    kept = forest.keep_one(edge, area)
    assert kept.columns == edge.columns
    # Without words: all four; the rest one of each class, equal rows once.
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted([1, 2, 3, None, 4, 8, 9, 11, 13], key=str)
    assert forest.keep_one(empty, area).count() == 0


def test_the_depth_is_the_longest_that_reaches_the_recall():
    assert forest.matching_depth(0.8, 20, 8, 0.999) == 5
    assert forest.matching_depth(0.8, 20, 8, 0.9) > 5
    with pytest.raises(ValueError):
        forest.matching_depth(0.1, 2, 8, 0.999)


def test_common_counts_agree_with_sets():
    rng = np.random.default_rng(0)
    sets = [np.unique(rng.integers(0, 300, rng.integers(1, 150))).astype(np.uint64) for _ in range(60)]
    common = forest.common_counts(sets)
    for i, a in enumerate(sets):
        assert all(common[i, j] == len(np.intersect1d(a, b)) for j, b in enumerate(sets))


def test_shingles_depend_on_words_alone():
    assert (word_hashes(b" aa  b\n\ncc\t") == word_hashes("aa b cc".encode())).all()
    assert set(shingle_set(b"x a b c d e")) & set(shingle_set(b"a b c d e y z")) == set(shingle_set(b"a b c d e"))
    assert len(shingle_set(b"a a a a a a a a")) == 1 and len(shingle_set(b"")) == 0
    assert len(shingle_set(b"a b")) == 1 and (shingle_set(b"a b") != shingle_set(b"b a")).all()


def test_minhashes_estimate_similarity():
    rng = np.random.default_rng(1)
    pool = rng.integers(0, 1 << 62, 1500).astype(np.uint64)
    a, b = minhashes(pool[:1000], 400), minhashes(pool[500:], 400)
    assert (a == b).mean() == pytest.approx(1 / 3, abs=0.1)


def test_components_of_chains_and_stars(spark, area):
    edges = [(i, i + 1) for i in range(0, 200)] + [(1000, 1000 + i) for i in range(1, 300)] + [(5000, 5000)]
    found = components(spark.createDataFrame(edges, "u bigint, v bigint"), area, "t").collect()
    assert {r.component for r in found if r.node <= 200} == {0}
    assert {r.component for r in found if 1000 <= r.node < 1300} == {1000}
    assert len(found) == 201 + 300
