import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from rowgate.llm import arrow_sequences, length_histogram
from rowgate.llm.encoding import encode_batch, encoder
from rowgate.llm.queries import QUERIES, TOKENIZER
from rowgate.session import settings

from llm_cases import SMALL, edge_rows


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(TOKENIZER)


def ids(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def test_ids_are_those_of_the_whole_text(library, small):
    rng = random.Random(3)
    signs = [*"abcXYZ éÉßİÀ×÷'.,!<|>0123²ñ日本Σ\t\n", "\x00", "\x1c", "\x85", "́", "\x0b\x0c", "<|endoftext|>", "'s "]
    odd = ["".join(rng.choice(signs) for _ in range(rng.randrange(30))) for _ in range(4000)]
    texts = [t for _, t, _ in small] + odd + [None, "", " "]
    found = [e.ids[a : a + n].tolist() for e in encode_batch(pa.array(texts), TOKENIZER) for a, n in zip(e.starts, e.lengths)]
    assert found == [ids(library, t) for t in texts]


def test_forgetting_words_changes_nothing(library, monkeypatch):
    monkeypatch.setattr("rowgate.llm.encoding.KEPT", 3)
    encoder(TOKENIZER).parts.clear()
    texts = ["some words here", "other words there", "some words again!"] * 3
    for text in texts:
        (found,) = encode_batch(pa.array([text]), TOKENIZER)
        assert found.ids.tolist() == ids(library, text)


def check_histogram(rows, lengths):
    lengths = np.array(lengths)
    assert sorted(r.n_tokens for r in rows) == sorted(set(lengths.tolist()))
    for r in rows:
        n = r.n_tokens
        assert (r.n_docs, r.docs_from, r.docs_cut) == ((lengths == n).sum(), (lengths >= n).sum(), (lengths > n).sum())
        assert r.tokens_from == lengths[lengths >= n].sum()
        assert (r.kept_tokens, r.cut_tokens) == (np.minimum(lengths, n).sum(), np.maximum(lengths - n, 0).sum())
        assert (r.total_docs, r.total_tokens) == (len(lengths), lengths.sum())


def test_histogram_of_edge_rows(edge, empty, area, library):
    summed = length_histogram.with_suffix_sums(length_histogram.histogram(edge, TOKENIZER), area)
    lengths = [len(ids(library, t)) for _, t, _ in edge_rows()]
    check_histogram(summed.collect(), lengths)
    lengths = np.array(lengths)
    for r in length_histogram.answers(summed, [0, 1, 5, 1000, 10**7]).collect():
        assert r.kept_tokens == np.minimum(lengths, r.context).sum() and r.docs_cut == (lengths > r.context).sum()
    for r in length_histogram.quantiles(summed, [0.1, 0.5, 1.0]).collect():
        assert r.n_tokens == np.sort(lengths)[int(np.ceil(r.share * len(lengths))) - 1]
    assert length_histogram.with_suffix_sums(length_histogram.histogram(empty, TOKENIZER), area).count() == 0


def test_histogram_query(spark, small, library):
    rows = QUERIES["op3_length_histogram"](spark, SMALL).collect()
    check_histogram(rows, [len(ids(library, t)) for _, t, _ in small])


def check_files(rows, expected, library):
    at, found = 0, sorted(((r.id, r.start, r.n_tokens, r.ids_crc32) for r in rows), key=lambda r: r[1])
    assert len(found) == len(expected)
    assert [r[0] for r in found] == sorted((d for d, _, _ in expected), key=lambda d: (d is not None, d))
    wanted = {}
    for doc_id, text, _ in expected:
        own = [*ids(library, text), 1]
        wanted.setdefault(doc_id, []).append((len(own), zlib.crc32(np.array(own, "<u4").tobytes())))
    for doc_id, start, n, crc in found:
        assert start == at and (n, crc) in wanted[doc_id]
        wanted[doc_id].remove((n, crc))
        at += n


def test_files_of_edge_rows(edge, empty, area, library):
    manifest = arrow_sequences.write_sequences(edge, area, TOKENIZER, length=16, per_batch=4)
    check_files(arrow_sequences.read_documents(manifest).collect(), edge_rows(), library)
    assert arrow_sequences.read_documents(arrow_sequences.write_sequences(empty, area, TOKENIZER)).count() == 0


def test_query_reads_back_what_was_written(spark, small, library):
    rows = QUERIES["op4_arrow_sequences"](spark, SMALL).withColumnRenamed("doc_id", "id").collect()
    check_files(rows, small, library)


def test_every_pair_of_files_is_read_by_a_task_of_its_own(spark, small, area):
    docs = spark.createDataFrame([(d, t) for d, t, _ in small], "doc_id bigint, text string").repartition(4)
    with settings(spark, {"spark.sql.adaptive.coalescePartitions.enabled": "false"}):  # several files of little data
        manifest = arrow_sequences.write_sequences(docs, area, TOKENIZER)
    read = arrow_sequences.read_documents(manifest).select("part", F.spark_partition_id().alias("task")).distinct().collect()
    files = manifest.count()
    assert files > 2 and len(read) == len({r.part for r in read}) == len({r.task for r in read}) == files


def test_a_folder_without_a_scheme_is_where_spark_looks(spark, edge, area, tmp_path):
    manifest = arrow_sequences.write_sequences(edge, area, TOKENIZER, folder=f"{tmp_path}/ids")
    default = spark.sparkContext._jsc.hadoopConfiguration().get("fs.defaultFS").split(":")[0]
    assert all(r.ids_path.startswith(f"{default}:") for r in manifest.collect())
    assert spark.read.format("binaryFile").load(f"{tmp_path}/ids").count() == 2 * manifest.count()


def test_random_access_without_copying(edge, area, library):
    manifest = arrow_sequences.write_sequences(edge, area, TOKENIZER, length=16, per_batch=4)
    for line in manifest.collect():
        reader = arrow_sequences.SequenceReader(line.ids_path)
        every = np.concatenate(list(reader.span(0, line.n_ids)))
        for i in range(line.n_sequences):
            own, mask = reader.sequence(i)
            assert len(own) == len(mask) == 16 and not own.flags.owndata
            assert mask.sum() == min(16, line.n_ids - 16 * i)
            assert (own[mask] == every[16 * i : 16 * i + 16]).all()
