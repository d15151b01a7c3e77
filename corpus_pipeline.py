"""A corpus from raw documents to packed sequences, as five stages.

Each stage takes the documents that the one before left, as Parquet, and returns a DataFrame:
all but the last one documents with their columns, the last one the pieces of the documents
with their places in sequences.

The reading and writing between stages belongs to ``run`` or to whoever calls the stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowgate.llm import constrained_packing, entropy_mixing, exact_dedup, jaccard_forest, quality_ledger
from rowgate.llm.common import documents, tune_for_texts
from rowgate.llm.queries import TOKENIZER
from rowgate.session import share_package
from rowgate.sources.staging import StagingArea


def _prepare(spark: SparkSession) -> None:
    share_package(spark)
    tune_for_texts(spark)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the quality policy in use lets pass."""
    _prepare(spark)
    return quality_ledger.keep_passing(docs)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    _prepare(spark)
    return exact_dedup.drop_duplicates(docs, exact_dedup.older_half(docs), StagingArea(spark))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that links of similar shingles connect."""
    _prepare(spark)
    return jaccard_forest.keep_one(docs, StagingArea(spark))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often as the mix of the sources takes them."""
    _prepare(spark)
    return entropy_mixing.mix(docs, StagingArea(spark))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents, packed into sequences."""
    _prepare(spark)
    packed = constrained_packing.pack_documents(docs, StagingArea(spark), TOKENIZER)
    return packed.select(
        F.col("id").alias("doc_id"), "source", "piece", "size", "n_tokens", "bin", "bin_start"
    )


STAGES = [
    ("quality rules", quality_rules),
    ("exact dedup", drop_exact_copies),
    ("n-gram Jaccard join", drop_near_copies),
    ("mixing sources", mix_sources),
    ("best-fit packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder, each written and read again by the next one."""
    area = StagingArea(spark)
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = area.stage(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)


#: Encoding, mixing and packing have no form in SQL; the tests hold each stage to a plain version.
ORACLE_SQL = None
QUERIES = {"pipeline": run}
ORACLES: dict[str, str] = {}
