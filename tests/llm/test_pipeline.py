import re
from collections import Counter, defaultdict

import corpus_pipeline
from rowgate.llm import quality_ledger
from test_jaccard import plain_links
from test_mixing import plain_targets, words

from llm_cases import SMALL


def as_rows(df):
    return [(r.doc_id, r.text, r.source) for r in df.collect()]


def test_each_stage_agrees_with_a_plain_version(spark, area, small):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns = docs.columns
    names = [name for name, _ in corpus_pipeline.STAGES]
    before, left = small, {}
    for name, stage in corpus_pipeline.STAGES:
        docs = area.stage(stage(spark, docs, SMALL), re.sub(r"\W", "", name))
        if name == names[-1]:
            break
        assert docs.columns == columns
        left[name] = sorted(as_rows(docs))
    rules, exact, near, mixed = (left[n] for n in names[:4])

    policy = quality_ledger.bits_of(quality_ledger.IN_USE.rules)

    def fails(text):
        n, chars, symbols, lines, dup, repeats = quality_ledger.measure((text or "").encode())
        bits = (n < 50, 100 * repeats > 50 * n, 10 * symbols > 3 * n, lines >= 4 and 2 * dup > lines, chars < 2 * n, chars > 25 * n)
        return sum(1 << i for i, b in enumerate(bits) if b) & policy

    assert rules == [r for r in before if not fails(r[1])]

    groups = defaultdict(list)
    for r in rules:
        groups[re.sub(r"[\x20\x09-\x0D]", "", r[1])].append(r)
    assert exact == sorted(min(g, key=lambda r: (-len(r[1]), r[0])) for g in groups.values())

    assert [r[0] for r in near] == sorted({c for _, c, _, _ in plain_links(exact)})

    sizes, targets = plain_targets(near)
    taken, times = Counter(), Counter()
    for doc_id, text, source in mixed:
        taken[source] += words(text)
        times[doc_id] += 1
    assert set(mixed) <= set(near) and max(times.values()) <= 2
    for source, target in targets.items():
        assert abs(taken[source] - target) <= max(words(t) for _, t, s in near if s == source)

    bins, whole = defaultdict(list), Counter()
    for r in docs.collect():
        bins[r.bin].append(r)
        whole[r.doc_id, r.n_tokens] += r.size
    assert {d: n for (d, t), n in whole.items()} == {d: t * times[d] for d, t in whole}
    assert {d for d, _ in whole} == set(times)
    for held in bins.values():
        assert sum(r.size for r in held) <= 2048
        assert len({r.source for r in held}) == len({r.doc_id for r in held}) == len(held)


def test_run_gives_the_last_stage(spark):
    assert corpus_pipeline.run(spark, SMALL).columns == ["doc_id", "source", "piece", "size", "n_tokens", "bin", "bin_start"]


def test_the_chain_takes_nulls_repeats_and_columns_of_clashing_names(spark, edge, empty, area):
    """Also where a stage leaves nothing; every stage but the last keeps the columns."""
    for docs, some in ((edge, True), (empty, False), (edge.where("text is null or length(text) < 20"), False)):
        columns = docs.columns
        for name, stage in corpus_pipeline.STAGES:
            docs = area.stage(stage(spark, docs, SMALL), re.sub(r"\W", "", name))
            if name != corpus_pipeline.STAGES[-1][0]:
                assert docs.columns == columns
        assert docs.isEmpty() != some
