import hashlib
import random
import re
from fractions import Fraction

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from rowgate.llm import periodic_runs
from rowgate.llm.queries import QUERIES, repeat_tail

from llm_cases import SMALL, edge_rows


def words_of(text):
    return [w for w in re.split("[\x20\x09-\x0d]+", text or "") if w]


def plain_runs(words):
    """All runs, by comparing every word at every distance."""
    n, found = len(words), []
    for period in range(1, n // 3 + 1):
        i = 0
        while i + period < n:
            if words[i] != words[i + period]:
                i += 1
                continue
            end = i
            while end + period < n and words[end] == words[end + period]:
                end += 1
            length = end - i + period
            smaller = any(words[i : i + length - q] == words[i + q : i + length] for q in range(1, period))
            if length >= max(24, 3 * period) and not smaller:
                found.append((i, length, period))
            i = end
    return sorted(found)


def plain_collapse(words, runs):
    return [w for i, w in enumerate(words) if not any(s + p <= i < s + n for s, n, p in runs)]


def as_bytes(words):
    return [w.encode() for w in words]


def agree(words):
    assert periodic_runs.runs_of([as_bytes(words)])[0] == plain_runs(words)


@pytest.mark.parametrize("period", [1, 2, 7, 8, 9, 11, 12, 13, 16, 20, 21, 27, 33, 41, 64, 85, 100])
@pytest.mark.parametrize("extra", [-1, 0, 1])
def test_runs_of_three_periods_are_found_and_shorter_ones_are_not(period, extra):
    rng = random.Random(period)
    block = [f"w{rng.randrange(4)}" for _ in range(period - 1)] + ["end"]
    length = max(24, 3 * period) + extra
    words = [f"a{i}" for i in range(5)] + [block[i % period] for i in range(length)] + [f"z{i}" for i in range(5)]
    agree(words)


def test_runs_inside_of_periods():
    inner = ["a"] * 40 + ["b", "c"] * 15 + [f"x{i}" for i in range(9)]
    agree((inner * 5)[: 5 * len(inner) - 3] + ["end"] + (["a"] * 23 + ["q"]) * 4)


def test_words_like_thue_morse_and_fibonacci():
    morse = [str(bin(i).count("1") % 2) for i in range(1500)]
    a, b = "a", "ab"
    while len(b) < 900:
        a, b = b, b + a
    assert plain_runs(morse) == periodic_runs.runs_of([as_bytes(morse)])[0] == []
    agree(list(b))
    agree(list(b) * 3)


@settings(max_examples=150, deadline=None)
@given(st.data())
def test_random_texts(data):
    words: list[str] = []
    for _ in range(data.draw(st.integers(1, 4))):
        block = data.draw(st.lists(st.sampled_from("abc"), min_size=1, max_size=30))
        words += (block * 8)[: data.draw(st.integers(1, 200))]
    agree(words)


def test_texts_together_are_as_alone():
    rng = random.Random(9)
    texts = []
    for _ in range(60):
        block = [rng.choice("abcde") for _ in range(rng.randrange(1, 30))]
        texts.append(as_bytes((block * 10)[: rng.randrange(0, 150)]))
    assert periodic_runs.runs_of(texts) == [periodic_runs.runs_of([t])[0] for t in texts]
    assert periodic_runs.runs_of(texts) == [plain_runs([w.decode() for w in t]) for t in texts]


def expected(doc_id, text):
    words = words_of(text)
    if doc_id is not None:
        words = [w.decode() for w in repeat_tail(as_bytes(words), doc_id)]
    runs = plain_runs(words)
    top = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None,) * 3)
    lines = "".join(f"{s},{n},{p}\n" for s, n, p in runs)
    return (
        doc_id, len(runs), *top, None if top[0] is None else 1000 * top[1] // top[2],
        hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(" ".join(plain_collapse(words, runs)).encode()).hexdigest(),
    )


def test_query_agrees_with_a_plain_version(spark, small):
    rows = QUERIES["op13_periodic_runs"](spark, SMALL).collect()
    assert sum(r.n_runs > 0 for r in rows) > 10
    found = sorted((r.doc_id, r.n_runs, r.start, r.length, r.period, r.exponent_milli, r.runs_sha256, r.collapsed_sha256) for r in rows)
    assert [f[0] for f in found] == [d for d, _, _ in small]
    for (doc_id, text, _), row in zip(small, found):
        if len(words_of(text)) < 1200:
            assert row == expected(doc_id, text)


def test_planting_is_as_stated():
    """Word i >= a becomes word a + (i - a) % p."""
    words = [f"w{i}".encode() for i in range(50)]
    changed = 0
    for doc_id in range(200):
        found = repeat_tail(words, doc_id)
        h = __import__("zlib").crc32(str(doc_id).encode())
        g = h // 10
        a = g % 50
        p = 1 + (50 - a) // (3 + g % 8)
        assert found == (words if h % 10 else [words[i] if i < a else words[a + (i - a) % p] for i in range(50)])
        changed += h % 10 == 0
    assert changed > 5 and repeat_tail([], 3) == []


def test_edge_rows(spark, edge, empty):
    rows = periodic_runs.collapse_runs(edge).collect()
    assert len(rows) == len(edge_rows())
    for doc_id, text, _ in edge_rows():
        words = words_of(text)
        assert any(r.id == doc_id and r.n_words == len(words) and r.collapsed == " ".join(words) and r.runs == [] for r in rows)
    assert periodic_runs.collapse_runs(empty).count() == 0


def test_a_very_long_text(spark):
    block = [f"w{i % 997}x{i}" for i in range(3000)]
    text = " ".join(f"h{i}" for i in range(20_000)) + " " + " ".join(block * 5) + " a" * 30_000
    row = periodic_runs.collapse_runs(spark.createDataFrame([(1, text)], "doc_id bigint, text string")).first()
    assert [tuple(r) for r in row.runs] == [(20_000, 15_000, 3000), (35_000, 30_000, 1)]
    assert len(row.collapsed.split()) == 23_001


def test_the_best_run_has_the_most_periods(spark):
    runs = [(0, 30, 10), (40, 24, 3), (70, 48, 6), (120, 24, 4)]
    df = spark.createDataFrame([(runs,), ([],)], f"runs array<struct<{periodic_runs.RUN}>>")
    assert [r[0] and tuple(r[0]) for r in df.select(periodic_runs.best(df.runs)).collect()] == [(40, 24, 3), None]
