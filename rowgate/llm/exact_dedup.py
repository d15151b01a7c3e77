"""Exact duplicates by a minimal perfect hash over the distinct digests of the history.

The history is cut into buckets by the first bits of its digests. Each bucket gets a minimal
perfect hash of its own: a pilot per small group of digests sends every digest of the bucket
to a slot that no other has, and there are as many slots as digests. A slot holds the full
digest and the locator of its winner. A lookup computes the slot and compares all bytes of
the digest, so a digest that is not in the history is told from one that is.

Only digests and locators are shuffled, never a text; equal digests are counted before the
shuffle, so a text that a third of all rows share sends one row per task.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.staging import StagingArea
from .common import column, encoded, fresh

BLANKS = b" \t\n\x0b\x0c\r"
#: Digests per bucket, about: an index row is some 60 bytes per digest.
PER_BUCKET = 1 << 12
#: Digests per pilot, on average.
PER_PILOT = 4


def normalized_digest(text: bytes) -> bytes:
    """SHA-256 of the text without its white space."""
    return hashlib.sha256(text.translate(None, BLANKS)).digest()


def _digested(texts: pa.Array) -> pa.Array:
    digests, lengths = [], []
    for text in encoded(texts):
        digests.append(normalized_digest(text))
        lengths.append(len(text.decode("utf-8", "replace")))
    return pa.StructArray.from_arrays(
        [pa.array(digests, pa.binary()), pa.array(lengths, pa.int64())], names=["digest", "n_chars"]
    )


def with_digest(docs: DataFrame, text: str = "text", into: str = "digest") -> DataFrame:
    """The documents with a struct ``into`` of the digest and the code points of the text."""
    return docs.withColumn(into, F.arrow_udf(_digested, "digest binary, n_chars bigint")(column(text)))


def _mixed(lanes: np.ndarray, salt: np.ndarray | int) -> np.ndarray:
    """64 well-spread bits of each lane under a salt."""
    x = lanes ^ (np.asarray(salt, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _lanes(digests: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit parts of each digest, behind the bits that chose the bucket."""
    words = digests.reshape(-1, 32).view("<u8")
    return words[:, 1].copy(), words[:, 2].copy()


def build_slots(digests: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A minimal perfect hash of distinct digests, ``(n, 32)`` bytes: pilots, and each digest's slot.

    The groups are placed largest first. A group tries pilots until all its digests fall on
    free slots of their own; the slots are as many as the digests, so the last digests search
    longest, n pilots on average for the very last one.
    """
    n = len(digests)
    groups = max(1, -(-n // PER_PILOT))
    which, where = _lanes(digests)
    group = (_mixed(which, 0) % np.uint64(groups)).astype(np.int64)
    pilots = np.zeros(groups, dtype=np.uint32)
    slots = np.zeros(n, dtype=np.int64)
    taken = np.zeros(n, dtype=bool)
    order = np.argsort(group, kind="stable")
    counts = np.bincount(group, minlength=groups)
    starts = np.concatenate([[0], np.cumsum(counts)[:-1]])
    tries = np.arange(1 << 8, dtype=np.uint64)
    for g in np.argsort(-counts, kind="stable"):
        if not counts[g]:
            break
        members = order[starts[g] : starts[g] + counts[g]]
        lanes = where[members]
        first, step = 0, tries
        while True:
            if first >> 32:
                raise ValueError("two digests agree in 64 bits and cannot be told apart by a pilot")
            tried = _mixed(lanes[None, :], (step + np.uint64(first))[:, None]) % np.uint64(n)
            fits = ~taken[tried.astype(np.int64)].any(axis=1)
            if len(members) > 1:
                ordered = np.sort(tried, axis=1)
                fits &= (ordered[:, 1:] != ordered[:, :-1]).all(axis=1)
            found = np.flatnonzero(fits)
            if len(found):
                pilots[g] = first + int(found[0])
                slots[members] = tried[found[0]].astype(np.int64)
                taken[slots[members]] = True
                break
            first += len(step)
            if len(step) < 1 << 14:
                step = np.arange(2 * len(step), dtype=np.uint64)
    return pilots, slots


def find_slots(digests: np.ndarray, pilots: np.ndarray, n: int) -> np.ndarray:
    """The slot that each digest would have; says nothing on whether it is a member."""
    which, where = _lanes(digests)
    group = (_mixed(which, 0) % np.uint64(len(pilots))).astype(np.int64)
    return (_mixed(where, pilots[group]) % np.uint64(n)).astype(np.int64)


def _matrix(values: pa.ChunkedArray | pa.Array) -> np.ndarray:
    joined = b"".join(v.as_py() for v in values)
    return np.frombuffer(joined, dtype=np.uint8).reshape(-1, 32)


_INDEX = "bucket int, n bigint, pilots binary, digests binary, winner array<bigint>, n_chars array<bigint>, copies array<bigint>"


def _build(table: pa.Table) -> pa.Table:
    digests = _matrix(table.column("digest"))
    pilots, slots = build_slots(digests)
    back = np.argsort(slots)
    held = {name: table.column(name).combine_chunks().take(pa.array(back)) for name in ("winner", "n_chars", "copies")}
    return pa.table(
        {
            "bucket": pa.array([table.column("bucket")[0].as_py()], pa.int32()),
            "n": pa.array([len(digests)], pa.int64()),
            "pilots": pa.array([pilots.tobytes()], pa.binary()),
            "digests": pa.array([digests[back].tobytes()], pa.binary()),
            **{name: pa.array([values.to_pylist()], pa.list_(pa.int64())) for name, values in held.items()},
        }
    )


def _bucket(digest: Column, buckets: int) -> Column:
    """The bucket by the first 32 bits, which the hash within a bucket does not use."""
    head = F.conv(F.substring(F.hex(digest), 1, 8), 16, 10).cast("bigint")
    return F.pmod(head, F.lit(buckets)).cast("int")


def _best() -> Column:
    """Of equal texts the longest original, then the smallest id; a null id comes last."""
    return F.max(F.struct("n_chars", F.col("id").isNotNull().alias("known"), (-F.col("id")).alias("minus")))


def distinct_digests(digested: DataFrame) -> DataFrame:
    """One row per digest with its copies and the locator of its winner.

    ``digested`` has the columns ``id``, ``digest`` and ``n_chars``.
    """
    return (
        digested.groupBy("digest")
        .agg(F.count(F.lit(1)).alias("copies"), _best().alias("best"))
        .select("digest", "copies", (-F.col("best.minus")).alias("winner"), F.col("best.n_chars").alias("n_chars"))
    )


def build_index(distinct: DataFrame, size: int) -> DataFrame:
    """The index of a history: one row per bucket. ``size``: the distinct digests, about.

    The buckets depend on the size, and a digest is random, so no bucket is much larger than
    ``PER_BUCKET`` whatever the texts are.
    """
    buckets = max(1, -(-size // PER_BUCKET))
    return (
        distinct.withColumn("bucket", _bucket(F.col("digest"), buckets))
        .groupBy("bucket")
        .applyInArrow(_build, _INDEX)
        .withColumn("buckets", F.lit(buckets))
    )


def _probe(entry: pa.Table, asked: pa.Table) -> pa.Table:
    """Asked digests with slot and locator where all bytes of the slot's digest agree."""
    m = asked.num_rows
    none = {name: pa.nulls(m, pa.int64()) for name in ("slot", "old_winner", "old_chars", "old_copies")}
    out = {name: asked.column(name) for name in ("digest", "bucket", "copies", "winner", "n_chars")}
    if not entry.num_rows or not m:
        return pa.table(out | none)
    n = entry.column("n")[0].as_py()
    digests = _matrix(asked.column("digest"))
    pilots = np.frombuffer(entry.column("pilots")[0].as_py(), dtype=np.uint32)
    held = np.frombuffer(entry.column("digests")[0].as_py(), dtype=np.uint8).reshape(n, 32)
    slot = find_slots(digests, pilots, n)
    member = (held[slot] == digests).all(axis=1)
    picked = pa.array(slot, mask=~member)
    values = {
        new: entry.column(old)[0].values.take(picked)
        for new, old in (("old_winner", "winner"), ("old_chars", "n_chars"), ("old_copies", "copies"))
    }
    return pa.table(out | {"slot": picked} | values)


_PROBED = (
    "digest binary, bucket int, copies bigint, winner bigint, n_chars bigint, "
    "slot bigint, old_winner bigint, old_chars bigint, old_copies bigint"
)


def look_up(index: DataFrame, asked: DataFrame) -> DataFrame:
    """Distinct digests with the slot and locator of each that the history has, else nulls.

    Both sides meet by bucket. The asked side has one row per digest, so no bucket is hot.
    """
    buckets = index.agg(F.max("buckets")).first()[0] or 1
    marked = asked.withColumn("bucket", _bucket(F.col("digest"), buckets))
    return index.groupBy("bucket").cogroup(marked.groupBy("bucket")).applyInArrow(_probe, _PROBED)


def decide(
    docs: DataFrame,
    history: Column,
    area: StagingArea,
    text: str = "text",
    doc_id: str = "doc_id",
) -> DataFrame:
    """One row per document: ``id, digest, n_chars, keep_id, group_size, kept, repeats, slot``.

    ``history`` says which documents were there before; null counts as no. Their distinct
    digests are indexed, those of all other documents are looked up: members join the group
    of their slot, nonmembers form groups of their own. Of equal texts the one with the most
    code points, then the smallest id, stays, wherever it came from; ``slot`` is null for
    groups that the history does not have.

    Equal are texts that agree in all but white space; null and empty texts are equal. A null
    id loses against any other. Rows that repeat the winner in id and text are all ``kept``
    here and counted in ``repeats``; ``drop_duplicates`` leaves one of them. An empty table
    gives an empty one. Other columns, whatever their names, are not looked at.
    """
    digested = area.stage(
        with_digest(
            docs.select(
                column(doc_id).cast("bigint").alias("id"), column(text).alias("text"),
                F.coalesce(history, F.lit(False)).alias("old"),
            )
        ).select("id", "old", F.col("digest.digest").alias("digest"), F.col("digest.n_chars").alias("n_chars")),
        "digests",
    )
    old = area.stage(distinct_digests(digested.where("old")), "history")
    index = area.stage(build_index(old, old.count()), "index")
    found = look_up(index, distinct_digests(digested.where("not old")))

    members = found.where("slot is not null").select(
        "bucket", "slot", "copies", "winner", "n_chars"
    )
    held = index.select(
        "bucket", F.posexplode(F.arrays_zip("winner", "n_chars", "copies")).alias("slot", "h"),
        "digests",
    ).select(
        "bucket", F.col("slot").cast("bigint").alias("slot"),
        F.expr("substring(digests, slot * 32 + 1, 32)").alias("digest"),
        F.col("h.copies").alias("copies"), F.col("h.winner").alias("winner"), F.col("h.n_chars").alias("n_chars"),
    )
    merged = (
        held.unionByName(members, allowMissingColumns=True)
        .withColumnRenamed("winner", "id")
        .groupBy("bucket", "slot")
        .agg(F.max("digest").alias("digest"), F.sum("copies").alias("group_size"), _best().alias("best"))
    )
    alone = found.where("slot is null").select(
        "digest", F.col("copies").alias("group_size"), F.col("winner").alias("keep_id"),
        F.col("n_chars").alias("keep_chars"), F.lit(None).cast("bigint").alias("slot"),
    )
    groups = area.stage(
        merged.select(
            "digest", "group_size", (-F.col("best.minus")).alias("keep_id"),
            F.col("best.n_chars").alias("keep_chars"), "slot",
        ).unionByName(alone),
        "groups",
    )
    same = F.col("n_chars") == F.col("keep_chars")
    kept = same & F.col("id").eqNullSafe(F.col("keep_id"))
    return digested.drop("old").join(groups, "digest").select(
        "id", "digest", "n_chars", "keep_id", "group_size", kept.alias("kept"), "slot"
    )


def drop_duplicates(
    docs: DataFrame, history: Column, area: StagingArea, text: str = "text", doc_id: str = "doc_id"
) -> DataFrame:
    """The documents that stay, with all their columns; one of each group of equal texts.

    The decisions are joined by id and digest. Where rows repeat the winner in both, one of
    them stays; only such rows are shuffled once more.
    """
    decided = decide(docs, history, area, text, doc_id).where("kept")
    winners = area.stage(
        decided.groupBy("id", "digest").agg(F.count(F.lit(1)).alias("repeats")), "winners"
    )
    into, key, again = fresh(docs, "digested"), fresh(docs, "kept_key"), fresh(docs, "repeats")
    marked = with_digest(docs, text, into)
    of = F.struct(column(doc_id).cast("bigint"), F.col(into).getField("digest"))
    right = winners.select(F.struct("id", "digest").alias(key), F.col("repeats").alias(again))
    joined = marked.join(right, of.eqNullSafe(F.col(key)))
    once = joined.where(F.col(again) == 1).select(*map(column, docs.columns))
    repeated = joined.where(F.col(again) > 1).dropDuplicates([key])
    return once.unionByName(repeated.select(*map(column, docs.columns)))


def older_half(docs: DataFrame, doc_id: str = "doc_id") -> Column:
    """Documents are numbered as they arrive: true for those up to the middle of the numbers."""
    first, last = docs.agg(F.min(doc_id), F.max(doc_id)).first()
    return F.lit(False) if first is None else column(doc_id) <= F.lit((first + last) // 2)
