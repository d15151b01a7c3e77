"""The exact histogram of encoded lengths, and what it answers for every context limit.

Documents are aggregated by their encoded length: one row per distinct length is all that is
shuffled. Suffix sums over the lengths say how many documents are at least that long and how
many ids they have, so any limit is answered from one row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..sources.staging import StagingArea
from .common import column
from .encoding import token_counts

#: Lengths per block of the suffix sums.
BLOCK = 1 << 10


def histogram(docs: DataFrame, tokenizer: str, text: str = "text") -> DataFrame:
    """``n_tokens, n_docs``: the documents of each encoded length; a null text has length 0."""
    length = F.arrow_udf(token_counts(tokenizer), "bigint")(column(text))
    return docs.select(length.alias("n_tokens")).groupBy("n_tokens").agg(F.count(F.lit(1)).alias("n_docs"))


def with_suffix_sums(counts: DataFrame, area: StagingArea) -> DataFrame:
    """One row per length that occurs, in which each answer for a limit of that length stands.

    ``docs_from`` and ``tokens_from``: documents of that length or more, and their ids.
    ``docs_cut``: documents that are longer. ``kept_tokens``: ids left when every document is
    cut to that length; ``cut_tokens``: the rest. ``total_docs``, ``total_tokens``: all.
    For a limit between two lengths: the answer of the shorter one plus the documents that
    are longer than it for each further id.

    The sums run within blocks of lengths, and over the blocks: neither grows with the
    documents, both only with the longest one. An empty table gives an empty one.
    """
    counts = area.stage(
        counts.withColumn("block", F.floor(F.col("n_tokens") / BLOCK))
        .withColumn("tokens", F.col("n_tokens") * F.col("n_docs")),
        "lengths",
    )
    per_block = counts.groupBy("block").agg(F.sum("n_docs").alias("d"), F.sum("tokens").alias("t"))
    later = Window.orderBy(F.col("block").desc()).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    after = area.stage(
        per_block.select(
            "block",
            F.coalesce(F.sum("d").over(later), F.lit(0)).alias("docs_after"),
            F.coalesce(F.sum("t").over(later), F.lit(0)).alias("tokens_after"),
            F.sum("d").over(every).alias("total_docs"), F.sum("t").over(every).alias("total_tokens"),
        ),
        "blocks",
    )
    longer = Window.partitionBy("block").orderBy(F.col("n_tokens").desc())
    summed = counts.join(after, "block").select(
        "n_tokens", "n_docs", "total_docs", "total_tokens",
        (F.sum("n_docs").over(longer) + F.col("docs_after")).alias("docs_from"),
        (F.sum("tokens").over(longer) + F.col("tokens_after")).alias("tokens_from"),
    )
    cut = F.col("tokens_from") - F.col("n_tokens") * F.col("docs_from")
    return summed.select(
        "*", (F.col("docs_from") - F.col("n_docs")).alias("docs_cut"),
        (F.col("total_tokens") - cut).alias("kept_tokens"), cut.alias("cut_tokens"),
    )


def answers(summed: DataFrame, limits: Sequence[int]) -> DataFrame:
    """``context, kept_tokens, cut_tokens, docs_cut`` for the given limits, from the suffix sums.

    For each limit, the row of the longest length up to it, found by one aggregation.
    """
    spread = summed.select("*", F.explode(F.array(*map(F.lit, limits))).alias("context"))
    under = F.when(F.col("n_tokens") <= F.col("context"), F.struct("n_tokens", "docs_cut", "kept_tokens"))
    rows = spread.groupBy("context").agg(
        F.max(under).alias("r"), F.max("total_tokens").alias("t"), F.max("total_docs").alias("d")
    )
    docs_cut = F.coalesce("r.docs_cut", F.col("d"))
    kept = F.coalesce(F.col("r.kept_tokens") + (F.col("context") - F.col("r.n_tokens")) * F.col("r.docs_cut"),
                      F.col("context") * F.col("d"))
    return rows.select("context", kept.alias("kept_tokens"), (F.col("t") - kept).alias("cut_tokens"),
                       docs_cut.alias("docs_cut"))


def quantiles(summed: DataFrame, shares: Sequence[float]) -> DataFrame:
    """``share, n_tokens``: the least length that so large a share of the documents does not exceed."""
    spread = summed.select("*", F.explode(F.array(*(F.lit(float(s)) for s in shares))).alias("share"))
    reached = F.col("total_docs") - F.col("docs_cut") >= F.col("share") * F.col("total_docs")
    return spread.where(reached).groupBy("share").agg(F.min("n_tokens").alias("n_tokens"))
