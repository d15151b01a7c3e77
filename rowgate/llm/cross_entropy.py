"""Cross-entropy difference: how much better a target model predicts a text than a background one.

Both are models of words and of word pairs over one vocabulary, the distinct words of the whole
corpus: the background model counts all documents, the target model the wanted ones among
them. Counts are smoothed by ``DELTA`` for every word of the vocabulary, and the loss of a token is
the mean of its loss as a word and as the second word of a pair (a log-linear mix of both
orders). The score of a document is the mean, over its tokens, of target loss minus background
loss, in bits: below zero, the document is closer to the target than the corpus is. A text
starts and ends with a mark that counts as a word.

Documents are encoded once, in blocks of some million tokens: the distinct words of a block and
the place of each token among them. Every block asks for each of its distinct words and pairs once, with
how often it has them, and a bucket of keys adds up the counts of all blocks and answers each. So a
word or pair that stands in every document is one entry per block, whatever its share of the
corpus. Blocks then read their answers in the order they asked, and sum per document. Texts are
not shuffled, counts never leave the tasks but as answers, and three totals come to the driver.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.staging import StagingArea
from .common import column, encoded, give_back
from .shingles import _ONE, _mix, _stream, word_hashes

DELTA = 0.1
#: Tokens of a block, and entries that a bucket has, about.
BLOCK, PER_BUCKET = 1 << 20, 1 << 20
#: Keys of words and pairs have 56 bits: the last byte is not sent.
_SENT = ~np.uint64(0xFF)
_CODEC = pa.Codec("zstd")
_LEFT, _RIGHT = _stream(2, 41) | _ONE

_BLOCKS = "block bigint, ids array<bigint>, sizes array<int>, words binary, tokens binary, n_words bigint, n_tokens bigint"
_REQUESTS = "block bigint, bucket int, keys binary, background binary, target binary"
_ANSWERS = "block bigint, bucket int, background binary, target binary, kinds bigint, background_total bigint, target_total bigint"
SCORES = "id bigint, n_tokens bigint, loss_difference double, score double"


def pack(values: np.ndarray) -> bytes:
    """The bytes of numbers, compressed, all first bytes before all second ones: what numbers share goes."""
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), values.itemsize).T.tobytes()
    return len(planes).to_bytes(8, "little") + _CODEC.compress(planes, asbytes=True)


def unpack(data: bytes, kind: str) -> np.ndarray:
    planes = _CODEC.decompress(data[8:], int.from_bytes(data[:8], "little"), asbytes=True)
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(size, -1).T).view(kind).reshape(-1)


def _encode(block_tokens: int):
    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = TaskContext.get().partitionId() << 32
        ids: list[int | None] = []
        words: list[np.ndarray] = []
        held = 0

        def emit() -> pa.RecordBatch:
            sizes = np.array([len(w) for w in words], np.int32)
            # The mark, then each text with the mark that ends it and starts the next one.
            joined = np.concatenate([_MARK, *(part for w in words for part in (w, _MARK))])
            distinct, at, n = np.unique(joined, return_inverse=True, return_counts=True)
            order = np.lexsort((distinct, -n))  # frequent words have small numbers, which compress
            rank = np.empty(len(order), "<u4")
            rank[order] = np.arange(len(order))
            columns = [[place], [ids], [sizes], [pack(distinct[order])], [pack(rank[at])], [len(distinct)], [held]]
            schema = pa.schema([
                ("block", pa.int64()), ("ids", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int32())), ("words", pa.binary()),
                ("tokens", pa.binary()), ("n_words", pa.int64()), ("n_tokens", pa.int64()),
            ])
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), encoded(batch.column(1))):
                ids.append(doc_id)
                words.append(word_hashes(text))
                held += len(words[-1]) + 1
                if held >= block_tokens:
                    yield emit()
                    place, ids, words, held = place + 1, [], [], 0
        if words:
            yield emit()

    return encode


_MARK = np.zeros(1, np.uint64)


class Block:
    """The distinct words and pairs of a block, and where its tokens have them."""

    def __init__(self, row: dict):
        self.words = unpack(row["words"], "<u8")
        self.sequence = unpack(row["tokens"], "<u4").astype(np.int64)
        self.sizes = np.asarray(row["sizes"], np.int64) + 1  # with the end
        self.ids = row["ids"]

    def flags(self, wanted: bytes | None) -> np.ndarray:
        """Of every token, whether its document is wanted."""
        bits = np.unpackbits(np.frombuffer(wanted or b"", np.uint8), bitorder="little")[: len(self.sizes)]
        of_document = np.zeros(len(self.sizes), np.int64)
        of_document[: len(bits)] = bits
        return np.repeat(of_document, self.sizes)

    def keys(self, order: int) -> tuple[np.ndarray, np.ndarray]:
        """The sorted keys of the distinct words (1) or pairs (2), and the place of each token's among them."""
        if order == 1:
            keys, which = _mix(self.words * _LEFT + _ONE), self.sequence[1:]
        else:
            codes = self.sequence[:-1] * len(self.words) + self.sequence[1:]
            distinct, which = np.unique(codes, return_inverse=True)
            first, second = np.divmod(distinct, max(1, len(self.words)))
            keys = _mix(_mix(self.words[first] * _LEFT + _ONE) * _RIGHT + self.words[second])
        keys &= _SENT
        order_of = np.argsort(keys)
        place = np.empty(len(keys), np.int64)
        place[order_of] = np.arange(len(keys))
        return keys[order_of], place[which]


def buckets_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    """The bucket of each key; sorted keys have sorted buckets."""
    return ((keys >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int32)


def _requests(order: int, buckets: int):
    def ask(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                block = Block(row)
                keys, at = block.keys(order)
                counts = [np.bincount(at, minlength=len(keys))]
                counts.append(np.bincount(at, block.flags(row["wanted"]), minlength=len(keys)).astype(np.int64))
                bucket = buckets_of(keys, buckets)
                starts = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
                ends = np.append(starts[1:], len(keys))
                parts = list(zip(starts.tolist(), ends.tolist()))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(parts), row["block"])), pa.array(bucket[starts]),
                        pa.array([pack(keys[a:b]) for a, b in parts], pa.binary()),
                        *(pa.array([pack(n[a:b].astype("<u4")) for a, b in parts], pa.binary()) for n in counts),
                    ],
                    names=["block", "bucket", "keys", "background", "target"],
                )
            give_back()

    return ask


def _answered(table: pa.Table) -> pa.Table:
    """To every block that asks in a bucket, the counts of its keys over all blocks."""
    parts = [unpack(k.as_py(), "<u8") for k in table.column("keys")]
    distinct, at = np.unique(np.concatenate(parts), return_inverse=True)
    ends = np.cumsum([len(p) for p in parts])
    answers, totals = [], []
    for name in ("background", "target"):
        asked = np.concatenate([unpack(n.as_py(), "<u4") for n in table.column(name)])
        total = np.bincount(at, asked, minlength=len(distinct)).astype("<i8")
        totals.append(int(total.sum()))
        answers.append([pack(part) for part in np.split(total[at], ends[:-1])])
    none = [0] * (len(parts) - 1)
    give_back()
    return pa.table(
        {
            "block": table.column("block"), "bucket": table.column("bucket"),
            "background": pa.array(answers[0], pa.binary()), "target": pa.array(answers[1], pa.binary()),
            # Once per bucket: how many keys it has, and their counts.
            "kinds": pa.array([len(distinct), *none], pa.int64()),
            "background_total": pa.array([totals[0], *none], pa.int64()),
            "target_total": pa.array([totals[1], *none], pa.int64()),
        }
    )


def _counts(answers: pa.Table, order: int, at: np.ndarray) -> list[np.ndarray]:
    """Of every token, the background and target counts of its word or pair."""
    own = answers.filter(pa.compute.equal(answers.column("order"), order)).sort_by("bucket")
    return [
        np.concatenate([unpack(n.as_py(), "<i8") for n in own.column(name)]).astype(np.float64)[at]
        for name in ("background", "target")
    ]


def _summed(kinds: int, background_total: int, target_total: int, delta: float):
    """Scores of a block's documents from the answers to all it asked for."""
    room = delta * kinds

    def score(_: tuple, blocks: pa.Table, answers: pa.Table) -> pa.Table:
        block = Block(blocks.to_pylist()[0])
        words, pairs = (_counts(answers, order, block.keys(order)[1]) for order in (1, 2))
        # A word is as often the first of a pair as it is a token; the mark that ends a block is the one that starts it.
        before = [np.concatenate([n[-1:], n[:-1]]) for n in words]
        totals = (background_total, target_total)
        alone, after = (
            [np.log2(count + delta) - np.log2(total + room) for count, total in zip(counts, of)]
            for counts, of in ((words, totals), (pairs, before))
        )
        lost = ((alone[0] - alone[1]) + (after[0] - after[1])) / 2
        sums = np.add.reduceat(lost, np.cumsum(block.sizes) - block.sizes)
        give_back()
        return pa.table(
            {
                "id": pa.array(block.ids, pa.int64()), "n_tokens": pa.array(block.sizes),
                "loss_difference": pa.array(sums), "score": pa.array(sums / block.sizes),
            }
        )

    return score


def _bits(table: pa.Table) -> pa.Table:
    places = table.column("at").to_numpy()
    bits = np.zeros(int(places.max()) // 8 * 8 + 8, np.uint8)
    bits[places] = 1
    return pa.table({"of": table.column("of")[:1], "wanted": pa.array([np.packbits(bits, bitorder="little").tobytes()])})


def score(
    docs: DataFrame, wanted: DataFrame, area: StagingArea, text: str = "text", doc_id: str = "doc_id",
    delta: float = DELTA, block_tokens: int = BLOCK, per_bucket: int = PER_BUCKET,
) -> DataFrame:
    """``id, n_tokens, loss_difference, score`` of every document, by the ``wanted`` ids against all documents.

    ``wanted`` has one column of ids. A null or empty text has one token, the end. A null id
    is not wanted. Rows that share an id are wanted together; rows that repeat each other are
    counted and scored alike. Without wanted documents the target is the uniform model. Other
    columns, whatever their names, are not looked at; an empty table gives an empty one.

    A block holds whole documents, so its memory grows with the longest text.
    """
    rows = docs.select(column(doc_id).cast("bigint").alias("id"), column(text).alias("text"))
    blocks = area.stage(rows.mapInArrow(_encode(block_tokens), _BLOCKS), "blocks")
    size = blocks.agg(F.sum("n_words").alias("words"), F.sum("n_tokens").alias("tokens")).first()
    good = wanted.select(F.col(wanted.columns[0]).cast("bigint").alias("good")).distinct()
    places = blocks.select(F.col("block").alias("of"), F.posexplode("ids").alias("at", "id"))
    flags = area.stage(
        places.join(good, F.col("id") == F.col("good")).groupBy("of").applyInArrow(_bits, "of bigint, wanted binary"), "wanted"
    )
    asking = blocks.join(flags, F.col("block") == F.col("of"), "left").select("block", "ids", "sizes", "words", "tokens", "wanted")

    def answers(order: int, entries: int | None) -> DataFrame:
        buckets = max(1, -(-(entries or 0) // per_bucket))
        asked = asking.mapInArrow(_requests(order, buckets), _REQUESTS)
        return asked.groupBy("bucket").applyInArrow(_answered, _ANSWERS).withColumn("order", F.lit(order))

    words = area.stage(answers(1, size["words"]), "vocabulary")
    totals = words.agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("kinds", "background_total", "target_total"))).first()
    both = words.unionByName(answers(2, size["tokens"])).select("block", "bucket", "background", "target", "order")
    return (
        blocks.select("block", "ids", "sizes", "words", "tokens")
        .groupBy("block").cogroup(both.groupBy("block")).applyInArrow(_summed(*totals, delta), SCORES)
    )


def score_by_labels(docs: DataFrame, labels: DataFrame, area: StagingArea, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Score all documents by those that the labels call good against all documents.

    Several labels of one document agree to the best of them. A null id matches none.
    """
    return score(docs, labels.where("quality = 1").select("doc_id"), area, text, doc_id)
