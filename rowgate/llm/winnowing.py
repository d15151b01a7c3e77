"""Benchmark decontamination by winnowing.

Of every window of ten words, the smallest hash among its five-word grams is the window's
fingerprint. The same ten words have the same fingerprint wherever they stand, so every shared
passage of ten words or more has a fingerprint in common; neighbouring windows mostly share
theirs, so few of them are looked up. An item of fewer than ten words is a window of its own
length, with itself as its only gram.

Fingerprints of the benchmark are marked in a bitmap of fixed size, which is all that goes to
the workers. Where a document's fingerprint is marked, the hit is extended to all windows that
have it: they are joined with the benchmark's windows by fingerprint and a digest of all
words. A window of the benchmark is one row in that join, however many items and documents
hold it, so the join makes one row per hit window. Items are added afterwards, once per distinct
set of windows: a passage that many documents share with many items makes no pairs.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.staging import StagingArea
from .common import column, give_back
from .encoding import pieces
from .marks import mark, marked
from .shingles import _BYTE, _ONE, _mix, _powers_to, _stream

#: Words of a window, and of the grams in it.
SPAN, GRAM = 10, 5
#: Bytes of text whose words are hashed at once.
_SEGMENT = 1 << 22

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_INSIDE = np.zeros(256, dtype=bool)
_INSIDE[48:58] = _INSIDE[97:123] = _INSIDE[128:] = True
_FIRST, _SECOND = _stream(SPAN, 21) | _ONE, _stream(SPAN, 22) | _ONE

WINDOW = "span int, fingerprint bigint, digest bigint"


def folded_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A hash per word of all texts in a row, and where each text's words start.

    Words are runs of ASCII letters, digits and characters beyond ASCII, with A-Z lower-cased.
    A null text has none.
    """
    texts = pc.fill_null(texts.cast(pa.large_binary()), b"")
    _, offsets, data = texts.buffers()
    ends = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if ends[-1] == ends[0]:
        return np.empty(0, np.uint64), np.zeros(len(texts) + 1, np.int64)
    x = _FOLD[np.frombuffer(data, np.uint8)[ends[0] : ends[-1]]]
    ends = ends - ends[0]
    inside = _INSIDE[x]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    cuts = ends[(ends > 0) & (ends < len(x))]  # words end where texts do
    first[cuts], last[cuts - 1] = inside[cuts], inside[cuts - 1]
    begin, until = np.flatnonzero(first), np.flatnonzero(last) + 1
    hashes = np.empty(len(begin), np.uint64)
    i = 0
    while i < len(begin):
        j = max(i + 1, int(np.searchsorted(until, begin[i] + _SEGMENT, "right")))
        part = x[begin[i] : until[j - 1]]
        power, inverse = _powers_to(len(part) + 1)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTE[part] * power[: len(part)])])
        s, e = begin[i:j] - begin[i], until[i:j] - begin[i]
        hashes[i:j] = _mix((sums[e] - sums[s]) * inverse[s] + (e - s).astype(np.uint64))
        i = j
    return hashes, np.searchsorted(begin, ends)


def sliding(x: np.ndarray, width: int, of=np.minimum) -> np.ndarray:
    """The least (or greatest) of every ``width`` values in a row."""
    have = 1
    while have < width:
        step = min(have, width - have)
        x = of(x[:-step], x[step:]) if len(x) > step else x[:0]
        have += step
    return x


def fingerprints(words: np.ndarray, span: int, gram: int) -> np.ndarray:
    """The smallest gram hash in each window of ``span`` words."""
    n = len(words) - gram + 1
    if n <= span - gram:
        return np.empty(0, np.uint64)
    hashes = words[:n] * _FIRST[0]
    for k in range(1, gram):
        hashes += words[k : k + n] * _FIRST[k]
    return sliding(_mix(hashes), span - gram + 1)


def _digests(words: np.ndarray, at: np.ndarray, span: int) -> np.ndarray:
    total = np.full(len(at), span, np.uint64)
    for k in range(span):
        total += words[at + k] * _SECOND[k]
    return _mix(total)


def gram_of(span: int) -> int:
    return GRAM if span == SPAN else span


def windows(words: np.ndarray, starts: np.ndarray, span: int, keep) -> tuple[np.ndarray, ...]:
    """First word, text, fingerprint and digest of the windows that ``keep`` picks by text and fingerprint."""
    prints = fingerprints(words, span, gram_of(span))
    change = np.flatnonzero(np.concatenate([np.ones(min(1, len(prints)), bool), prints[1:] != prints[:-1]]))
    lengths = np.diff(np.concatenate([change, [len(prints)]]))
    kept = keep(prints[change])  # one look-up for neighbours with the same fingerprint
    at = np.repeat(change[kept] - np.cumsum(lengths[kept]) + lengths[kept], lengths[kept]) + np.arange(lengths[kept].sum())
    text = np.searchsorted(starts, at, "right") - 1
    whole = at + span <= starts[text + 1] if len(at) else np.zeros(0, bool)
    at, text = at[whole], text[whole]
    return at, text, prints[at], _digests(words, at, span)


def _items(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for items, texts in _sliced(batch):
            words, starts = folded_words(texts)
            sizes = np.minimum(np.diff(starts), SPAN)
            for span in range(1, SPAN + 1):
                _, text, prints, digests = windows(words, starts, span, lambda p: np.ones(len(p), bool))
                own = sizes[text] == span
                if own.any():
                    yield pa.RecordBatch.from_arrays(
                        [items.take(pa.array(text[own])), pa.array(np.full(int(own.sum()), span, np.int32)),
                         pa.array(prints[own].view(np.int64)), pa.array(digests[own].view(np.int64))],
                        names=["item", "span", "fingerprint", "digest"],
                    )
        give_back()


def _sliced(batch: pa.RecordBatch) -> Iterator[tuple[pa.Array, pa.Array]]:
    first = 0
    for texts in pieces(batch.column(1).cast(pa.large_string())):
        yield batch.column(0).slice(first, len(texts)), texts
        first += len(texts)


def item_windows(benchmark: DataFrame, text: str = "text", item_id: str = "item_id") -> DataFrame:
    """``item, span, fingerprint, digest``: the distinct windows of each item; ids are text, a null id is empty."""
    rows = benchmark.select(F.coalesce(column(item_id).cast("string"), F.lit("")).alias("item"), column(text).alias("text"))
    return rows.mapInArrow(_items, f"item string, {WINDOW}").distinct()


def _scanned(shared, spans: list[int]):
    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = TaskContext.get().partitionId() << 33
        bitmap = shared.value
        for batch in batches:
            for ids, texts in _sliced(batch):
                words, starts = folded_words(texts)
                found = [(*windows(words, starts, span, lambda p: marked(bitmap, p)), span) for span in spans]
                at, text, prints, digests = (np.concatenate([f[i] for f in found] or [np.empty(0, np.int64)]) for i in range(4))
                span = np.concatenate([np.full(len(f[0]), f[4], np.int32) for f in found] or [np.empty(0, np.int32)])
                order = np.argsort(text, kind="stable")
                entries = pa.StructArray.from_arrays(
                    [pa.array((at - starts[text])[order]), pa.array(span[order]),
                     pa.array(prints[order].view(np.int64)), pa.array(digests[order].view(np.int64))],
                    names=["start", "span", "fingerprint", "digest"],
                )
                ends = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=len(texts)))]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(place + np.arange(len(texts))), ids, pa.array(np.diff(starts)), pa.ListArray.from_arrays(pa.array(ends), entries)],
                    names=["place", "id", "n_words", "windows"],
                )
                place += len(texts)
            give_back()

    return scan


def _spans(hits: pa.Array) -> pa.Array:
    """The stretches of words that sorted windows cover together."""
    rows = []
    for windows_of in hits.to_pylist():
        merged: list[dict[str, int]] = []
        for hit in windows_of or ():
            end = hit["start"] + hit["span"]
            if merged and hit["start"] <= merged[-1]["end"]:
                merged[-1]["end"] = max(merged[-1]["end"], end)
            else:
                merged.append({"start": hit["start"], "end": end})
        rows.append(merged)
    return pa.array(rows, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))


def contamination(
    docs: DataFrame, benchmark: DataFrame, area: StagingArea,
    text: str = "text", doc_id: str = "doc_id", item_text: str = "text", item_id: str = "item_id",
) -> DataFrame:
    """One row per document: ``id, n_words, spans, items``.

    ``spans`` are the stretches of words ``[start, end)`` that occurrences of item windows
    cover, ``items`` the ids of the items they belong to, sorted as strings. Rows that repeat
    each other are found alike and all kept. A text without words has no hit, an item
    without words none to give; rows of one item id count as one item. Other columns, whatever
    their names, are not looked at; an empty table on either side gives no hits.

    The list of a document's items stands in one row, so it grows with the items that the
    document really contains.
    """
    key = ["span", "fingerprint", "digest"]
    owned = area.stage(item_windows(benchmark, item_text, item_id), "item-windows")
    spans = sorted(row["span"] for row in owned.select("span").distinct().collect())  # ten at most
    shared = docs.sparkSession.sparkContext.broadcast(mark(owned, F.col("fingerprint")))

    # Windows of the same items are one set; it is named by what does not depend on order.
    by_window = area.stage(
        owned.groupBy(*key).agg(
            F.concat_ws(
                "-", F.count(F.lit(1)), F.hex(F.bit_xor(F.xxhash64("item"))), F.hex(F.bit_xor(F.xxhash64(F.lit(1), "item")))
            ).alias("set")
        ),
        "sets",
    )
    example = by_window.groupBy("set").agg(F.min(F.struct(*key)).alias("w")).select("set", "w.*")
    members = area.stage(example.join(owned, key).select("set", "item"), "members")

    rows = docs.select(column(doc_id).cast("bigint").alias("id"), column(text).alias("text"))
    entry = "start bigint, span int, fingerprint bigint, digest bigint"
    scanned = area.stage(
        rows.mapInArrow(_scanned(shared, spans), f"place bigint, id bigint, n_words bigint, windows array<struct<{entry}>>"),
        "scanned",
    )
    candidates = scanned.where(F.size("windows") > 0).select("place", "id", "n_words", F.explode("windows").alias("w"))
    met = candidates.select("place", "id", "n_words", "w.*").join(by_window, key, "left")
    hit = F.when(F.col("set").isNotNull(), F.struct("start", "span"))
    per_doc = area.stage(
        met.groupBy("place", "id", "n_words")
        .agg(F.array_sort(F.collect_list(hit)).alias("hits"), F.array_sort(F.collect_set("set")).alias("sets"))
        .withColumn("signature", F.sha2(F.concat_ws(",", "sets"), 256)),
        "hits",
    )
    some = F.size("sets") > 0
    kinds = per_doc.where(some).groupBy("signature").agg(F.first("sets").alias("sets"))
    listed = area.stage(
        kinds.select("signature", F.explode("sets").alias("set"))
        .join(members, "set")
        .groupBy("signature")
        .agg(F.array_sort(F.collect_set("item")).alias("items")),
        "items",
    )
    covered = F.arrow_udf(_spans, "array<struct<start:bigint,end:bigint>>")(F.col("hits"))
    found = per_doc.where(some).join(listed, "signature").select("id", "n_words", covered.alias("spans"), "items")
    clean = scanned.where(F.size("windows") == 0).select("id", "n_words").unionByName(
        per_doc.where(~some).select("id", "n_words")
    )
    nothing = F.array().cast("array<struct<start:bigint,end:bigint>>")
    return found.unionByName(clean.select("id", "n_words", nothing.alias("spans"), F.array().cast("array<string>").alias("items")))
