"""The operators of this package on whole tables, each with its SQL where SQL has a form."""

from __future__ import annotations

from collections.abc import Callable
from zlib import crc32

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import share_package
from ..sources.staging import StagingArea
from . import (
    arrow_sequences, constrained_packing, cross_entropy, entropy_mixing, exact_dedup, importance_resampling,
    jaccard_forest, length_histogram, periodic_runs, quality_ledger, sharding, surrogates, winnowing,
)
from .common import documents, encoded, tune_for_texts

SHARDS = 8
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def register(build):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            share_package(spark)
            tune_for_texts(spark)
            return build(spark, sf_dir)

        QUERIES[build.__name__] = run
        if sql is not None:
            ORACLES[build.__name__] = sql
        return build

    return register


@query(
    r"""WITH d AS (SELECT doc_id, coalesce(text, '') AS text,
                          regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
    m AS (SELECT doc_id, len(w)::BIGINT AS n_words,
                 coalesce(list_sum([length(x) for x in w]), 0)::BIGINT AS word_chars,
                 length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
                 [x for x in string_split(text, chr(10)) if regexp_matches(x, '[^\x20\x09-\x0D]')] AS lines FROM d),
    g AS (SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS win
          FROM d, unnest(range(1, len(w) - 1)) AS r(i)),
    t AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, win) AS n FROM g) WHERE n > 1),
    c AS (SELECT doc_id, count(DISTINCT i + o) AS n FROM t, unnest([0, 1, 2]) AS u(o) GROUP BY doc_id),
    a AS (SELECT doc_id, n_words, word_chars, n_symbols, len(lines)::BIGINT AS n_lines,
                 (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
                 coalesce(c.n, 0)::BIGINT AS n_repeat_words FROM m LEFT JOIN c USING (doc_id)),
    b AS (SELECT *, (CASE WHEN n_words < 50 THEN 1 ELSE 0 END
                   + CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 2 ELSE 0 END
                   + CASE WHEN 10 * n_symbols > 3 * n_words THEN 4 ELSE 0 END
                   + CASE WHEN n_lines >= 4 AND 2 * n_dup_lines > n_lines THEN 8 ELSE 0 END
                   + CASE WHEN word_chars < 2 * n_words THEN 16 ELSE 0 END
                   + CASE WHEN word_chars > 25 * n_words THEN 32 ELSE 0 END
                   + CASE WHEN 10 * n_symbols > n_words THEN 64 ELSE 0 END
                   + CASE WHEN 100 * n_repeat_words > 20 * n_words THEN 128 ELSE 0 END)::BIGINT AS fail_bits FROM a)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, fail_bits,
           fail_bits & 3 <> 0 AS base_failed, fail_bits & 63 = 0 AS kept, 'v2' AS policy FROM b"""
)
def op6_quality_ledger(spark, sf_dir):
    """Every document with its measurements, its failure bits and the verdict of the policy in use."""
    marked = quality_ledger.with_ledger(documents(spark, sf_dir).select("doc_id", "text"))
    base = quality_ledger.Policy("base", quality_ledger.BASE)
    return marked.select("doc_id", "ledger.*").select(
        "*",
        (~quality_ledger.passes(F.col("fail_bits"), base)).alias("base_failed"),
        quality_ledger.passes(F.col("fail_bits"), quality_ledger.IN_USE).alias("kept"),
        F.lit(quality_ledger.IN_USE.version).alias("policy"),
    )


@query(
    r"""WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS n,
                          sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS h FROM documents),
    k AS (SELECT *, first_value(doc_id) OVER (PARTITION BY h ORDER BY n DESC, doc_id) AS keep_id,
                 count(*) OVER (PARTITION BY h) AS group_size FROM d)
    SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, h AS text_sha256 FROM k"""
)
def op8_exact_dedup(spark, sf_dir):
    """Every document with the one of its equals that stays; the older half of the table is the history."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    area = StagingArea(spark)
    decided = exact_dedup.decide(docs, exact_dedup.older_half(docs), area)
    return decided.select(
        F.col("id").alias("doc_id"), "keep_id", "group_size", "kept",
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


@query()
def op1_karmarkar_karp_shards(spark, sf_dir):
    """All documents in eight shards of equal bytes, equal texts together."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    assigned = sharding.assign(docs, SHARDS, StagingArea(spark))
    return assigned.select(
        F.col("id").alias("doc_id"), "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query()
def op3_length_histogram(spark, sf_dir):
    """Every encoded length with the answers for a context limit of that length."""
    counts = length_histogram.histogram(documents(spark, sf_dir).select("text"), TOKENIZER)
    return length_histogram.with_suffix_sums(counts, StagingArea(spark))


@query()
def op4_arrow_sequences(spark, sf_dir):
    """All documents encoded, written as Arrow files of equal-length sequences and read back."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    manifest = arrow_sequences.write_sequences(docs, StagingArea(spark), TOKENIZER)
    return arrow_sequences.read_documents(manifest).withColumnRenamed("id", "doc_id")


@query()
def op7_constrained_packing(spark, sf_dir):
    """Every piece of every document with its bin of 2048 ids."""
    docs = documents(spark, sf_dir).select("doc_id", "text", "source")
    return constrained_packing.pack_documents(docs, StagingArea(spark), TOKENIZER).withColumnRenamed("id", "doc_id")


@query()
def op9_entropy_mixing(spark, sf_dir):
    """Every document with the words that the mix takes of it."""
    docs = documents(spark, sf_dir).select("doc_id", "text", "source")
    return entropy_mixing.taken(docs, StagingArea(spark)).withColumnRenamed("id", "doc_id")


@query()
def op10_jaccard_forest(spark, sf_dir):
    """Every document with its class of near copies and its number of links."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return jaccard_forest.link(docs, StagingArea(spark)).select(
        F.col("id").alias("doc_id"), "class_id", "n_shingles", "n_links"
    )


@query()
def op5_cross_entropy(spark, sf_dir):
    """Every document's cross-entropy difference between the good documents and all."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    return cross_entropy.score_by_labels(docs, labels, StagingArea(spark)).withColumnRenamed("id", "doc_id")


@query()
def op2_surrogates(spark, sf_dir):
    """Every document with its personal data replaced by surrogates."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return surrogates.pseudonymize(docs, "key of the test run", StagingArea(spark))


@query(
    r"""WITH i AS (SELECT DISTINCT item_id::VARCHAR AS item, words FROM (SELECT item_id, regexp_extract_all(
                     translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM benchmark) WHERE len(words) > 0),
    iw AS (SELECT DISTINCT item, least(10, len(words)) AS n, words[p : p + least(10, len(words)) - 1] AS win
           FROM i, unnest(range(1, len(words) - least(10, len(words)) + 2)) AS r(p)),
    d AS (SELECT doc_id, coalesce(regexp_extract_all(
                     translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS words FROM documents),
    dw AS (SELECT doc_id, n, p, words[p : p + n - 1] AS win
           FROM d, (SELECT DISTINCT n FROM iw) AS s, unnest(range(1, len(words) - n + 2)) AS r(p)),
    w AS (SELECT DISTINCT n, win FROM iw),
    hit AS (SELECT doc_id, n, p, win FROM dw JOIN w USING (n, win)),
    covered AS (SELECT doc_id, count(DISTINCT p + o) AS n_hit FROM hit, unnest(range(0, n)) AS r(o) GROUP BY doc_id),
    items AS (SELECT doc_id, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS names
              FROM hit JOIN iw USING (n, win) GROUP BY doc_id)
    SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
           coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(names, '')) AS items_sha256,
           n_hit IS NOT NULL AS contaminated
    FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)"""
)
def op11_winnowing(spark, sf_dir):
    """Every document with the words that are inside of benchmark windows, and the items they are from."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text")
    found = winnowing.contamination(docs, benchmark, StagingArea(spark))
    n_hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s["end"] - s["start"])
    return found.select(
        F.col("id").alias("doc_id"), "n_words", n_hit.alias("n_hit"), F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"),
    )


@query()
def op12_importance_resampling(spark, sf_dir):
    """Every document with its weight towards the benchmark, and the rank of those that are drawn."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    target = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("text")
    drawn = importance_resampling.resample(docs, target, StagingArea(spark))
    return drawn.select(F.col("id").alias("doc_id"), "n_words", "n_features", "weight", "score", "rank")


def repeat_tail(words: list[bytes], doc_id: int) -> list[bytes]:
    """One text in ten, by its id, with a period planted from some word on."""
    h = crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if h % 10 or not n:
        return words
    first = g % n
    period = 1 + (n - first) // (3 + g % 8)
    return words[:first] + [words[first + k % period] for k in range(n - first)]


def _planted(ids: pa.Array, texts: pa.Array) -> pa.Array:
    rows = []
    for doc_id, text in zip(ids.to_pylist(), encoded(texts)):
        rows.append(text if doc_id is None else b" ".join(repeat_tail(text.split(), doc_id)))
    return pa.array(rows, pa.binary()).cast(pa.string())


@query()
def op13_periodic_runs(spark, sf_dir):
    """Every document, one in ten with a planted period, with its runs and what is left without them."""
    docs = documents(spark, sf_dir).select(
        "doc_id", F.arrow_udf(_planted, "string")("doc_id", "text").alias("text")
    )
    found = periodic_runs.collapse_runs(docs).withColumn("best", periodic_runs.best(F.col("runs")))
    line = lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))
    return found.select(
        F.col("id").alias("doc_id"), F.size("runs").cast("bigint").alias("n_runs"), "best.*",
        F.expr("best.length * 1000 div best.period").alias("exponent_milli"),
        F.sha2(F.concat_ws("", F.transform("runs", line)), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
