"""Mix sources to target weights by entropy balancing.

Each source gets a target of words. Among all rates per document that meet the targets and
do not exceed the cap, those closest to "every document once" in relative entropy are
``min(cap, exp(multiplier * size / mean size))`` with one multiplier per source: the convex
dual has one unknown per source, and Newton steps on its gradient find them. Each step is one
aggregation over the distinct (source, size) pairs. The rates are then rounded to copies by a
hash of the document, with the threshold of each source set so that its words come as close to
the target as whole documents can.

All sums are of integers, so reruns agree to the last document.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..sources.staging import StagingArea
from .common import WORD, column

WEIGHTS = (3, 1, 2)
SHARE, CAP = 1.5, 2
STEPS, TOLERANCE = 60, 1e-6
#: Contributions are summed in units of so small a part of a word.
UNIT = 1 << 20
#: Rounding keys have 41 bits, found in four parts.
KEY_BITS, SHIFTS = 41, (30, 20, 10, 0)


def word_count(text: Column) -> Column:
    """Runs without white space, counted where the rows are; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """``source, source_size, target``: ``share`` of all sizes dealt to the sources by weight.

    The weights repeat over the sources in code point order, null last. No target exceeds
    ``cap`` times its source's size; what that leaves is dealt again by weight. In order of
    size per weight the full sources come first, so one pass finds them all. ``sizes`` has a
    row ``source, source_size`` per source.
    """
    ranked = sizes.withColumn("rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (F.col("rank") % len(weights) + 1).cast("int"))
    limited = ranked.withColumn("weight", weight).withColumn("most", F.lit(float(cap)) * F.col("source_size"))
    by_room = Window.orderBy(F.col("most") / F.col("weight"), "rank")
    earlier = by_room.rowsBetween(Window.unboundedPreceding, -1)
    later = by_room.rowsBetween(0, Window.unboundedFollowing)
    every = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    budget = F.lit(float(share)) * F.sum("source_size").over(every)
    level = (budget - F.coalesce(F.sum("most").over(earlier), F.lit(0.0))) / F.sum("weight").over(later)
    leveled = limited.withColumn("level", level)
    # The first source whose room is above its level sets the level of all that follow.
    first = F.min(F.when(F.col("most") > F.col("weight") * F.col("level"), F.struct(F.col("most") / F.col("weight"), "rank", "level"))).over(every)
    return leveled.withColumn("level", F.coalesce(first["level"], F.col("level"))).select(
        "source", "source_size", F.least("most", F.col("weight") * F.col("level")).alias("target")
    )


def _rate(size: Column, cap: float) -> Column:
    tilt = F.least(F.lit(float(cap)), F.exp(F.col("multiplier") * size / F.col("mean_size")))
    return F.when(F.col("target") >= F.lit(float(cap)) * F.col("source_size"), F.lit(float(cap))).otherwise(tilt)


def _total(value: Column) -> Column:
    """A sum that does not depend on the order of the rows."""
    return F.sum(F.round(value * UNIT).cast("decimal(38,0)")).cast("double") / UNIT


def solve(cells: DataFrame, wanted: DataFrame, area: StagingArea, cap: float = CAP) -> DataFrame:
    """``wanted`` with ``mean_size`` and the ``multiplier`` of each source, by Newton steps.

    ``cells`` has ``source, size, n``: how many documents of a source have a size. A step
    outside of the bracket known so far is replaced by its middle. Steps end when all sources
    are within ``TOLERANCE`` of their targets. One row per source is kept between steps; one
    number comes to the driver.
    """
    means = cells.groupBy("source").agg((F.sum(F.col("size") * F.col("n")) / F.sum("n")).alias("mean_size"))
    state = area.stage(
        wanted.join(means, wanted["source"].eqNullSafe(means["source"])).select(
            wanted["source"], "source_size", "target", F.greatest("mean_size", F.lit(1.0)).alias("mean_size"),
            F.lit(0.0).alias("multiplier"), F.lit(None).cast("double").alias("low"),
            F.lit(None).cast("double").alias("high"),
        ),
        "state-0",
    )
    cells = cells.withColumnRenamed("source", "of")
    for step in range(1, STEPS + 1):
        rate = _rate(F.col("size"), cap)
        words = F.col("n") * F.col("size") * rate
        slope = F.when(rate < cap, words * F.col("size") / F.col("mean_size")).otherwise(0.0)
        sums = (
            cells.join(state, F.col("of").eqNullSafe(F.col("source")))
            .groupBy("source", "source_size", "target", "mean_size", "multiplier", "low", "high")
            .agg(_total(words).alias("words"), _total(slope).alias("slope"))
        )
        miss = F.col("words") - F.col("target")
        done = (F.abs(miss) <= TOLERANCE * F.greatest(F.col("target"), F.lit(1.0))) | (
            F.col("target") >= F.lit(float(cap)) * F.col("source_size")
        )
        low = F.when(miss < 0, F.col("multiplier")).otherwise(F.col("low"))
        high = F.when(miss > 0, F.col("multiplier")).otherwise(F.col("high"))
        newton = F.when(F.col("slope") > 0, F.col("multiplier") - miss / F.col("slope"))
        inside = (low.isNull() | (newton > low)) & (high.isNull() | (newton < high))
        middle = F.coalesce((low + high) / 2, 2 * low + 1, 2 * high - 1)
        state = area.stage(
            sums.select(
                "source", "source_size", "target", "mean_size",
                F.when(done, F.col("multiplier")).when(inside, newton).otherwise(middle).alias("multiplier"),
                low.alias("low"), high.alias("high"), done.alias("done"),
            ),
            f"state-{step}",
        )
        if state.where("not done").isEmpty():
            break
    return state.select("source", "source_size", "target", "mean_size", "multiplier")


def mark_of(doc_id: Column, text: Column) -> Column:
    """What tells documents apart when they are rounded: rows of one id, or without any, by their texts."""
    return F.xxhash64(doc_id, text)


def _draw(cap: float, mark: Column, size: Column) -> tuple[Column, Column]:
    """Whole copies of a document, and the key by which it gets one more: small keys first."""
    rate = _rate(size, cap)
    whole = F.when(size > 0, F.floor(rate)).otherwise(0).cast("bigint")
    uniform = F.shiftrightunsigned(mark, 11) / F.lit(float(1 << 53))
    key = F.floor((uniform - (rate - whole) + 1) * F.lit(float(1 << (KEY_BITS - 1)))).cast("bigint")
    return whole, F.when((size > 0) & (rate < cap), key).otherwise(F.lit(1 << KEY_BITS))


def round_off(ledger: DataFrame, state: DataFrame, area: StagingArea, cap: float = CAP) -> DataFrame:
    """``state`` with the ``threshold`` of each source: documents with a smaller key get one more copy.

    The threshold is found 11, then 10 bits at a time: words per source and interval are
    summed, and the interval in which the target is reached is looked into next. It stands
    before the document that would exceed the target; of all documents behind it, the one whose
    size comes closest to what is still missing, ``extra``, is taken instead if that helps. No
    source is sorted or gathered.
    """
    rows = ledger.withColumnRenamed("source", "of")
    columns = ["source", "source_size", "target", "mean_size", "multiplier"]

    def drawn(current: DataFrame) -> DataFrame:
        whole, key = _draw(cap, F.col("mark"), F.col("size"))
        joined = rows.join(current, F.col("of").eqNullSafe(F.col("source")))
        return joined.withColumn("whole", whole).withColumn("key", key)

    current = area.stage(
        drawn(state).groupBy(*columns).agg(F.sum(F.col("whole") * F.col("size")).alias("below")).withColumn("start", F.lit(0).cast("bigint")),
        "threshold-0",
    )
    for i, shift in enumerate(SHIFTS):
        width = 1 << (KEY_BITS if i == 0 else SHIFTS[i - 1])
        here = drawn(current).where((F.col("key") >= F.col("start")) & (F.col("key") < F.col("start") + width))
        bins = here.groupBy("source", F.shiftright(F.col("key") - F.col("start"), shift).alias("bin")).agg(F.sum("size").alias("words"))
        left = current.withColumnRenamed("source", "of")
        joined = left.join(bins, F.col("of").eqNullSafe(F.col("source")), "left").drop("source").withColumnRenamed("of", "source")
        order = Window.partitionBy("source").orderBy("bin")
        summed = joined.withColumn("until", F.col("below") + F.sum("words").over(order))
        reached = F.min(F.when(F.col("until") >= F.col("target"), F.struct("bin", (F.col("until") - F.col("words")).alias("before"), "words")))
        found = summed.groupBy(*columns, "below", "start").agg(reached.alias("r"), F.max("until").alias("all"))
        # Where the whole interval does not reach the target, all of it is taken.
        past = F.coalesce("r.before", "all", F.col("below"))
        start = F.col("start") + F.when(F.col("below") >= F.col("target"), 0).otherwise(
            F.coalesce(F.shiftleft(F.col("r.bin").cast("bigint"), shift), F.lit(width - (1 << shift)))
        )
        current = area.stage(
            found.select(
                *columns,
                F.when(F.col("below") >= F.col("target"), F.col("below")).otherwise(past).alias("below"),
                start.cast("bigint").alias("start"),
            ),
            f"threshold-{i + 1}",
        )
    missing = F.col("target") - F.col("below")
    behind = (F.col("key") >= F.col("start")) & (F.col("key") < (1 << KEY_BITS))
    closest = F.min(F.when(behind, F.struct(F.abs(F.col("size") - missing).alias("miss"), "key")))
    nearest = drawn(current).groupBy(*columns, "below", "start").agg(closest.alias("closest"))
    return area.stage(
        nearest.select(
            *columns, F.col("start").alias("threshold"),
            F.when(F.col("closest.miss") < missing, F.col("closest.key")).alias("extra"),
        ),
        "solved",
    )


def plan(docs: DataFrame, area: StagingArea, text: str = "text", doc_id: str = "doc_id", source: str = "source",
         weights: Sequence[float] = WEIGHTS, share: float = SHARE, cap: float = CAP) -> tuple[DataFrame, DataFrame]:
    """The ledger ``id, source, size, mark`` of all documents, and the solved row of each source."""
    key = column(doc_id).cast("bigint")
    ledger = area.stage(
        docs.select(
            key.alias("id"), column(source).cast("string").alias("source"), word_count(column(text)).alias("size"),
            mark_of(key, column(text)).alias("mark"),
        ),
        "sizes",
    )
    cells = area.stage(ledger.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n")), "cells")
    sizes = cells.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    state = solve(cells, area.stage(targets(sizes, weights, share, cap), "targets"), area, cap)
    return ledger, round_off(ledger, state, area, cap)


def copies(mark: Column, size: Column, cap: float = CAP) -> Column:
    """How often the mix takes a document, over rows joined with their source's solved row."""
    whole, key = _draw(cap, mark, size)
    return whole + F.when((key < F.col("threshold")) | key.eqNullSafe(F.col("extra")), 1).otherwise(0)


def taken(docs: DataFrame, area: StagingArea, cap: float = CAP, **names) -> DataFrame:
    """One row per document: ``id, source, size, source_size, target, rate, copies, taken``.

    A null text has size 0; a document without words is not taken. A null source is one
    source. Rows that share id, text and source are taken alike, all or none of them, so a target is
    missed by up to half of such a group; rows of one id, or without any, are told apart by their texts.
    Other columns are not looked at; an empty table gives an empty one.
    """
    ledger, state = plan(docs, area, cap=cap, **names)
    joined = ledger.withColumnRenamed("source", "of").join(state, F.col("of").eqNullSafe(F.col("source")))
    n = copies(F.col("mark"), F.col("size"), cap)
    return joined.select(
        "id", "source", "size", "source_size", "target",
        F.when(F.col("size") > 0, _rate(F.col("size"), cap)).otherwise(0.0).alias("rate"),
        n.alias("copies"), (n * F.col("size")).alias("taken"),
    )


def mix(docs: DataFrame, area: StagingArea, text: str = "text", doc_id: str = "doc_id", source: str = "source", cap: float = CAP) -> DataFrame:
    """The documents as the mix takes them: each row as often as it has copies, all its columns kept.

    A row's copies follow from its id, text and source's row, so the texts are not joined with
    the ledger.
    """
    _, state = plan(docs, area, text, doc_id, source, cap=cap)
    rows = docs.select(F.struct(*map(column, docs.columns)).alias("row"))
    body = F.col("row").getField(text)
    sized = rows.select(
        "row", F.col("row").getField(source).cast("string").alias("of"), word_count(body).alias("size"),
        mark_of(F.col("row").getField(doc_id).cast("bigint"), body).alias("mark"),
    )
    joined = sized.join(state, F.col("of").eqNullSafe(F.col("source")))
    n = copies(F.col("mark"), F.col("size"), cap)
    return joined.select("row", F.explode(F.array_repeat(F.lit(1), n.cast("int")))).select("row.*")
