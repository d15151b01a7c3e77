"""Conflict-constrained best-fit packing of documents into sequences.

Documents are cut into pieces of a sequence's length at most. The pieces are dealt into blocks
by a hash, and each block is packed largest first: bins are kept in the order of the room they
have left, with one bitmap of the sources and one of the duplicate clusters they hold. The
search for a bin starts at the least room that takes the piece and goes on to the next until it
finds a bin with neither the piece's source nor its cluster; without one, a bin is opened.

A block holds a bounded number of pieces and carries no text.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.staging import StagingArea
from .common import column
from .encoding import token_counts

SEQUENCE = 2048
#: Pieces per block, about.
PER_BLOCK = 1 << 14


class Bins:
    """Open bins by room left, then by what they hold."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.rooms = 0  # bit r: there is a bin with room r
        self.by_room: dict[int, dict[tuple[int, int], list[int]]] = {}
        self.opened = 0

    def place(self, size: int, source: int, cluster: int) -> tuple[int, int]:
        """The bin for a piece and where it starts there; source and cluster are bitmaps."""
        number, room, sources, clusters = self._tightest(size, source, cluster)
        left = room - size
        if left:
            holding = self.by_room.setdefault(left, {})
            holding.setdefault((sources | source, clusters | cluster), []).append(number)
            self.rooms |= 1 << left
        return number, self.capacity - room

    def _tightest(self, size: int, source: int, cluster: int) -> tuple[int, int, int, int]:
        rooms = self.rooms >> size
        room = size
        while rooms:
            step = (rooms & -rooms).bit_length() - 1  # the next room that some bin has
            room += step
            holding = self.by_room[room]
            for (sources, clusters), numbers in holding.items():
                if not sources & source and not clusters & cluster:
                    number = numbers.pop()
                    if not numbers:
                        del holding[sources, clusters]
                        if not holding:
                            del self.by_room[room]
                            self.rooms ^= 1 << room
                    return number, room, sources, clusters
            rooms >>= step + 1
            room += 1
        self.opened += 1
        return self.opened - 1, self.capacity, 0, 0


def _bits(values: list) -> list[int]:
    """One bit per value that occurs more than once, none for the others: they meet nothing."""
    counts: dict = {}
    for v in values:
        counts[v] = counts.get(v, 0) + 1
    codes: dict = {}
    return [1 << codes.setdefault(v, len(codes)) if counts[v] > 1 else 0 for v in values]


def pack(sizes: list[int], sources: list, clusters: list, capacity: int) -> list[tuple[int, int]]:
    """Bin and offset of each piece; the pieces come largest first."""
    bins = Bins(capacity)
    return [bins.place(*piece) for piece in zip(sizes, _bits(sources), _bits(clusters))]


def _pack_block(capacity: int):
    def packed(table: pa.Table) -> pa.Table:
        table = table.sort_by(
            [("size", "descending"), ("cluster", "ascending"), ("source", "ascending"), ("id", "ascending"),
             ("piece", "ascending")]
        )
        columns = [table.column(c).to_pylist() for c in ("size", "source", "cluster")]
        found = pack(*columns, capacity)
        base = table.column("block")[0].as_py() << 32 if table.num_rows else 0
        return table.append_column("bin", pa.array([base + b for b, _ in found], pa.int64())).append_column(
            "bin_start", pa.array([s for _, s in found], pa.int32())
        )

    return packed


def pieces(docs: DataFrame, tokenizer: str, capacity: int = SEQUENCE, text: str = "text", doc_id: str = "doc_id", source: str = "source") -> DataFrame:
    """``id, source, cluster, n_tokens, piece, size``: every document cut into pieces.

    A document has its ids and an end id; all its pieces but the last fill a sequence. Equal
    texts, white space aside, form a duplicate cluster.
    """
    bare = F.regexp_replace(F.coalesce(column(text), F.lit("")), r"[\x20\x09-\x0D]+", "")
    sized = docs.select(
        column(doc_id).cast("bigint").alias("id"), column(source).cast("string").alias("source"),
        F.xxhash64(bare).alias("cluster"),
        (F.arrow_udf(token_counts(tokenizer), "bigint")(column(text)) + 1).alias("n_tokens"),
    )
    last = F.floor((F.col("n_tokens") - 1) / capacity)
    cut = sized.select("*", F.explode(F.sequence(F.lit(0).cast("bigint"), last)).alias("piece"))
    return cut.withColumn("size", F.least(F.lit(capacity).cast("bigint"), F.col("n_tokens") - F.col("piece") * capacity))


def pack_documents(docs: DataFrame, area: StagingArea, tokenizer: str, capacity: int = SEQUENCE, **names) -> DataFrame:
    """One row per piece: ``id, piece, size, n_tokens, source, cluster, bin, bin_start``.

    No bin holds more than ``capacity`` ids, two pieces of one source, or two of one cluster.
    A null text has the end id alone. A null source is one source. Rows that repeat each other
    are equal texts, so they lie in different bins; they are dealt over the blocks as all others are. Other columns are not looked at; an empty
    table gives an empty one.
    """
    placed = pieces(docs, tokenizer, capacity, **names).withColumn("place", F.monotonically_increasing_id())
    cut = area.stage(placed, "pieces")
    blocks = max(1, -(-cut.count() // PER_BLOCK))
    # The place, as it was written, deals out rows that are equal in all else.
    block = F.pmod(F.xxhash64("id", "piece", "source", "cluster", "place"), F.lit(blocks))
    return (
        cut.withColumn("block", block)
        .drop("place")
        .groupBy("block")
        .applyInArrow(
            _pack_block(capacity),
            "id bigint, source string, cluster bigint, n_tokens bigint, piece bigint, size bigint, block bigint, "
            "bin bigint, bin_start int",
        )
        .drop("block")
    )
