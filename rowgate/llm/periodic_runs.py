"""Find the periodic runs of words in a text, and collapse them to their first period.

A run is a stretch of words with a smallest period, three periods or more and ``MIN_LENGTH``
words or more, that no neighbour extends. Periods of up to ``SHORT`` words are found by comparing
each word with the one that far ahead. For longer ones there are scales of a quarter more each.
At a scale, every gram as long as its longest period has a hash, and the smallest of each window
of grams is a minimizer. Inside a run the windows repeat at period distance, and so do their
minimizers; a gram as long as the period cannot occur earlier again. So of the minimizers with
equal hashes, each and its next one are a seed if their distance belongs to the scale. Seeds are
extended word by word with words compared as such, so hashes decide nothing but where to look.

Many texts are searched at once, with a word of its own between them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import column, encoded
from .encoding import pieces
from .shingles import _ONE, _mix, _stream
from .winnowing import sliding

MIN_LENGTH, MIN_POWER = 24, 3
#: The longest period that is looked for at every word.
SHORT = 8
_LEFT, _RIGHT = _stream(2, 31) | _ONE

RUN = "start bigint, length bigint, period bigint"
RESULT = f"n_words bigint, runs array<struct<{RUN}>>, collapsed string"


def least(period: int) -> int:
    return max(MIN_LENGTH, MIN_POWER * period)


def scales(longest: int) -> Iterator[tuple[int, int]]:
    """The shortest and the longest period of each scale, for texts of up to ``longest`` words."""
    low = SHORT + 1
    while MIN_POWER * low <= longest:
        high = low * 5 // 4
        yield low, high
        low = high + 1


def _scanned(ids: np.ndarray, period: int) -> Iterator[tuple[int, int, int]]:
    """The stretches that repeat at this distance, by comparing all words."""
    same = np.flatnonzero(ids[period:] == ids[:-period])
    if len(same) < least(period) - period:
        return
    cut = np.flatnonzero(np.diff(same) > 1)
    first, last = same[np.concatenate([[0], cut + 1])], same[np.concatenate([cut, [len(same) - 1]])]
    length = last - first + 1 + period
    for i in np.flatnonzero(length >= least(period)):
        yield int(first[i]), int(length[i]), period


def _differ_from(ids: np.ndarray, i: int, period: int) -> int:
    """The first place from ``i`` on whose word is not repeated at this distance."""
    n, size = len(ids) - period, 32
    while i < n:
        end = min(n, i + size)
        differs = ids[i:end] != ids[i + period : end + period]
        at = int(differs.argmax())
        if differs[at]:
            return i + at
        i, size = end, size * 2
    return n


def _differ_before(ids: np.ndarray, i: int, period: int) -> int:
    """The last place before ``i`` whose word is not repeated at this distance, -1 if there is none."""
    size = 32
    while i > 0:
        first = max(0, i - size)
        differs = np.flatnonzero(ids[first:i] != ids[first + period : i + period])
        if len(differs):
            return first + int(differs[-1])
        i, size = first, size * 2
    return -1


def _seeds(hashes: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of minimizers and their distance to the next equal one, sorted by distance and place."""
    width = 2 * low - high + 1  # so many windows of a run have their like a period further
    smallest = sliding(hashes, width)
    if not len(smallest):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    around = np.zeros(len(smallest) + 2 * (width - 1), np.uint64)
    around[width - 1 : width - 1 + len(smallest)] = smallest
    at = np.flatnonzero(hashes == sliding(around, width, np.maximum))
    value = hashes[at]
    order = np.argsort(value, kind="stable")
    at, value = at[order], value[order]
    distance = np.diff(at)
    pair = (value[1:] == value[:-1]) & (distance >= low) & (distance <= high)
    place, distance = at[:-1][pair], distance[pair]
    order = np.lexsort((place, distance))
    return place[order], distance[order]


def _grown(ids: np.ndarray, longest: int) -> Iterator[tuple[int, int, int]]:
    """The stretches of longer periods, from seeds of every scale."""
    level, size = _mix(ids.view(np.uint64) * _LEFT), 1
    for low, high in scales(longest):
        if high > len(ids):
            return
        while size * 2 <= high:
            level = _mix(level[:-size] * _LEFT + level[size:] * _RIGHT)
            size *= 2
        n = len(ids) - high + 1
        hashes = _mix(level[:n] * _LEFT + level[high - size : high - size + n] * _RIGHT)
        done: tuple[int, int] = (0, 0)
        for place, period in zip(*map(np.ndarray.tolist, _seeds(hashes, low, high))):
            if done[0] == period and place + period < done[1]:
                continue  # inside of the stretch before
            start = _differ_before(ids, place, period) + 1
            end = _differ_from(ids, place, period) + period
            done = (period, end)
            if end - start >= least(period):
                yield start, end - start, period


def find_runs(ids: np.ndarray, longest: int | None = None) -> list[tuple[int, int, int]]:
    """``start, length, period`` of all runs among words given as numbers, by start, then period.

    ``longest``: how many words there are between two that are no other's like.
    """
    ids = np.ascontiguousarray(ids, np.int64)
    if len(ids) < MIN_LENGTH:
        return []
    found: dict[tuple[int, int], int] = {}
    short = (run for q in range(1, SHORT + 1) for run in _scanned(ids, q))
    for stretches in (short, _grown(ids, longest or len(ids))):
        for start, length, period in stretches:
            # The same stretch repeats at multiples of its smallest period too.
            found[start, length] = min(period, found.get((start, length), period))
    return sorted((start, length, period) for (start, length), period in found.items())


def _by_size(sizes: np.ndarray) -> Iterator[np.ndarray]:
    """Texts that may have runs, those of about the same size together."""
    able = np.flatnonzero(sizes >= MIN_LENGTH)
    kind = np.frexp(sizes[able].astype(np.float64))[1]
    for k in np.unique(kind):
        yield able[kind == k]


def runs_of(texts: list[list[bytes]]) -> list[list[tuple[int, int, int]]]:
    """The runs of each text, given as its words."""
    known: dict[bytes, int] = {}
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for together in _by_size(sizes):
        joined = np.empty(int(sizes[together].sum()) + len(together), np.int64)
        starts = np.concatenate([[0], np.cumsum(sizes[together] + 1)])
        for k, i in enumerate(together):
            joined[starts[k] : starts[k + 1] - 1] = [known.setdefault(w, len(known)) for w in texts[i]]
            joined[starts[k + 1] - 1] = -1 - k  # a word that nothing is like
        for start, length, period in find_runs(joined, int(sizes[together].max())):
            k = int(np.searchsorted(starts, start, "right")) - 1
            found[together[k]].append((start - int(starts[k]), length, period))
    return found


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words without those that any run holds after its first period."""
    if not runs:
        return words
    kept = np.ones(len(words), bool)
    for start, length, period in runs:
        kept[start + period : start + length] = False
    return [words[i] for i in np.flatnonzero(kept)]


def _searched(texts: pa.Array) -> pa.Array:
    sizes: list[int] = []
    runs: list[list[dict[str, int]]] = []
    left: list[bytes] = []
    for piece in pieces(texts.cast(pa.large_string())):
        words = [text.split() for text in encoded(piece)]
        for own, of in zip(words, runs_of(words)):
            sizes.append(len(own))
            runs.append([dict(zip(("start", "length", "period"), run)) for run in of])
            left.append(b" ".join(collapse(own, of)))
    kind = pa.list_(pa.struct([(name, pa.int64()) for name in ("start", "length", "period")]))
    return pa.StructArray.from_arrays(
        [pa.array(sizes, pa.int64()), pa.array(runs, kind), pa.array(left, pa.binary()).cast(pa.string())],
        names=["n_words", "runs", "collapsed"],
    )


def search(text: Column) -> Column:
    """``n_words, runs, collapsed`` of a text: its runs by start, then period, and what is left of it.

    Words are what stands between white space; ``collapsed`` has one blank between those that
    are kept. A null text has no words and gives an empty one.
    """
    return F.arrow_udf(_searched, RESULT)(text)


def collapse_runs(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``id, n_words, runs, collapsed`` of every document.

    Texts are worked on one batch at a time, nothing is shuffled; memory grows with the longest
    text. Rows that repeat each other give equal rows. Other columns, whatever their names, are
    not looked at; an empty table gives an empty one.
    """
    rows = docs.select(column(doc_id).cast("bigint").alias("id"), search(column(text)).alias("found"))
    return rows.select("id", "found.*")


def best(runs: Column) -> Column:
    """The run with the most periods, compared exactly; of equal ones the first."""
    none = F.lit(None).cast(f"struct<{RUN}>")

    def better(held: Column, run: Column) -> Column:
        more = run["length"] * held["period"] > held["length"] * run["period"]
        return F.when(held.isNull() | more, run).otherwise(held)

    return F.aggregate(runs, none, better)
