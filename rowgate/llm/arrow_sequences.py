"""Token ids as Arrow IPC files of equal-length sequences.

The documents' ids follow each other in ascending order of the document id, each document
closed by an end id. Every task holds a range of documents and writes two files: the ids cut
into fixed-size lists with a mask of the same length, in record batches of equally many
lists, and the places of its documents. Sequence i of a file is row ``i % per_batch`` of batch
``i // per_batch``: a reader that maps the file gets its ids without copying or decoding.

Only the last sequence of a file is padded; the mask is false there.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark import TaskContext
from pyspark.sql import DataFrame

from ..sources.staging import StagingArea
from ..sources.staging import file_system as area_file_system
from .common import column, running_blocks
from .encoding import encode_batch, encoder

SEQUENCE = 2048
PER_BATCH = 256
END_ID = 1


def file_system(path: str) -> tuple[arrow_fs.FileSystem, str]:
    """The file system of a path or URI, and the path in it."""
    if path.startswith("file:"):
        return arrow_fs.LocalFileSystem(), "/" + path[len("file:") :].lstrip("/")
    if path.startswith("/"):
        return arrow_fs.LocalFileSystem(), path
    return arrow_fs.FileSystem.from_uri(path)


class SequenceWriter:
    """Append ids of documents; full batches go to the file at once."""

    def __init__(self, path: str, dtype: np.dtype, length: int, per_batch: int):
        self.length, self.per_batch, self.dtype = length, per_batch, dtype
        kind = pa.from_numpy_dtype(dtype)
        self.schema = pa.schema(
            [pa.field("ids", pa.list_(kind, length)), pa.field("mask", pa.list_(pa.bool_(), length))],
            metadata={"per_batch": str(per_batch)},
        )
        files, name = file_system(path)
        files.create_dir(name.rsplit("/", 1)[0], recursive=True)
        self.sink = files.open_output_stream(name)
        self.file = pa.ipc.new_file(self.sink, self.schema)
        self.buffer = np.empty(length * per_batch, dtype=dtype)
        self.filled, self.total = 0, 0

    def append(self, ids: np.ndarray) -> None:
        self.total += len(ids)
        while len(ids):
            part = ids[: len(self.buffer) - self.filled]
            self.buffer[self.filled : self.filled + len(part)] = part
            self.filled += len(part)
            ids = ids[len(part) :]
            if self.filled == len(self.buffer):
                self._flush()

    def _flush(self) -> None:
        rows = -(-self.filled // self.length)
        self.buffer[self.filled : rows * self.length] = 0
        mask = np.arange(rows * self.length) < self.filled
        columns = [
            pa.FixedSizeListArray.from_arrays(pa.array(values[: rows * self.length]), self.length)
            for values in (self.buffer, mask)
        ]
        self.file.write_batch(pa.RecordBatch.from_arrays(columns, schema=self.schema))
        self.filled = 0

    def close(self) -> None:
        if self.filled:
            self._flush()
        self.file.close()
        self.sink.close()


class SequenceReader:
    """Random access to the sequences of one file; a local file is mapped, not read."""

    def __init__(self, path: str):
        files, name = file_system(path)
        local = isinstance(files, arrow_fs.LocalFileSystem)
        self.source = pa.memory_map(name) if local else files.open_input_file(name)
        self.file = pa.ipc.open_file(self.source)
        self.per_batch = int(self.file.schema.metadata[b"per_batch"])
        self.length = self.file.schema.field("ids").type.list_size
        self._held: tuple[int, pa.RecordBatch] | None = None

    def _batch(self, i: int) -> pa.RecordBatch:
        if self._held is None or self._held[0] != i:
            self._held = (i, self.file.get_batch(i))
        return self._held[1]

    def sequence(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and mask of sequence i; the ids are a view of the file."""
        batch, row = self._batch(i // self.per_batch), i % self.per_batch
        span = slice(row * self.length, (row + 1) * self.length)
        ids = batch.column("ids").values.to_numpy(zero_copy_only=True)[span]
        return ids, batch.column("mask").values[span].to_numpy(zero_copy_only=False)

    def span(self, start: int, n: int) -> Iterator[np.ndarray]:
        """The ids from ``start`` on, as views of one batch each."""
        per_batch = self.per_batch * self.length
        while n:
            at = start % per_batch
            ids = self._batch(start // per_batch).column("ids").values.to_numpy(zero_copy_only=True)
            part = ids[at : at + min(n, per_batch - at)]
            if not len(part):
                raise ValueError("the file ends before the document does")
            yield part
            start, n = start + len(part), n - len(part)

    def close(self) -> None:
        self.source.close()


_PLACES = pa.schema([("id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])
_MANIFEST = "part int, ids_path string, docs_path string, n_docs bigint, n_ids bigint, n_sequences bigint"


def _write(folder: str, tokenizer: str, end_id: int, length: int, per_batch: int):
    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        name = f"{folder}/part-{task:06d}-{uuid.uuid4().hex}"  # a repeated task writes files of its own
        dtype = encoder(tokenizer).dtype
        writer = places = None
        n_docs = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            if writer is None:
                writer = SequenceWriter(f"{name}.ids.arrow", dtype, length, per_batch)
                files, path = file_system(f"{name}.docs.arrow")
                sink = files.open_output_stream(path)
                places = pa.ipc.new_file(sink, _PLACES)
            starts, sizes = [], []
            for found in encode_batch(batch.column("text"), tokenizer):
                for i in range(len(found.lengths)):
                    ids = found.ids[found.starts[i] : found.starts[i + 1]]
                    starts.append(writer.total)
                    sizes.append(len(ids) + 1)
                    writer.append(ids)
                    writer.append(np.array([end_id], dtype=dtype))
            places.write_batch(
                pa.RecordBatch.from_arrays([batch.column("id"), pa.array(starts), pa.array(sizes)], schema=_PLACES)
            )
            n_docs += batch.num_rows
        if writer is None:
            return
        writer.close()
        places.close()
        sink.close()
        yield pa.RecordBatch.from_pylist(
            [
                {
                    "part": task, "ids_path": f"{name}.ids.arrow", "docs_path": f"{name}.docs.arrow",
                    "n_docs": n_docs, "n_ids": writer.total, "n_sequences": -(-writer.total // length),
                }
            ],
            schema=pa.schema(
                [("part", pa.int32()), ("ids_path", pa.string()), ("docs_path", pa.string()),
                 ("n_docs", pa.int64()), ("n_ids", pa.int64()), ("n_sequences", pa.int64())]
            ),
        )

    return write


def write_sequences(
    docs: DataFrame,
    area: StagingArea,
    tokenizer: str,
    folder: str | None = None,
    text: str = "text",
    doc_id: str = "doc_id",
    end_id: int = END_ID,
    length: int = SEQUENCE,
    per_batch: int = PER_BATCH,
) -> DataFrame:
    """Write all documents and return the manifest: one row per pair of files.

    ``folder`` must be reached by all executors; without one the files go to the area. The
    manifest is written when the files are, and names those of finished tasks only. A null
    text counts as empty: its document has the end id alone. Null ids come first; rows that
    share an id are written one after the other. Other columns are not read. An empty table
    gives an empty manifest.
    """
    # As Spark's own files are found: a path without a scheme is on the default file system.
    files, path = area_file_system(docs.sparkSession, folder or f"{area.path}/sequences")
    folder = files.makeQualified(path).toString()
    ordered = (
        docs.select(column(doc_id).cast("bigint").alias("id"), column(text).alias("text"))
        .repartitionByRange("id")
        .sortWithinPartitions("id")
    )
    written = ordered.mapInArrow(_write(folder, tokenizer, end_id, length, per_batch), _MANIFEST)
    manifest = area.stage(written, "manifest")
    before = running_blocks(manifest, "part", "part", {"ids_before": "n_ids", "docs_before": "n_docs"})
    return area.stage(manifest.join(before, "part"), "placed-manifest")


def _read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for line in batch.to_pylist():
            reader = SequenceReader(line["ids_path"])
            files, path = file_system(line["docs_path"])
            with files.open_input_file(path) as source:
                places = pa.ipc.open_file(source)
                for b in range(places.num_record_batches):
                    part = places.get_batch(b)
                    sums = []
                    for start, n in zip(part.column("start").to_pylist(), part.column("n_tokens").to_pylist()):
                        crc = 0
                        for ids in reader.span(start, n):
                            crc = zlib.crc32(ids.astype("<u4").tobytes(), crc)
                        sums.append(crc)
                    yield pa.RecordBatch.from_arrays(
                        [
                            part.column("id"),
                            pa.compute.add(part.column("start"), line["ids_before"]),
                            part.column("n_tokens"), pa.array(sums, pa.int64()),
                            pa.array([line["part"]] * part.num_rows, pa.int32()),
                            pa.compute.floor(pa.compute.divide(part.column("start"), reader.length)).cast(pa.int64()),
                        ],
                        names=["id", "start", "n_tokens", "ids_crc32", "part", "first_sequence"],
                    )
            reader.close()


def read_documents(manifest: DataFrame) -> DataFrame:
    """Every document as the files have it: place among all ids, length and checksum of its ids.

    One task per pair of files: as many ranges of ``part`` as there are, which adaptive execution does
    not merge.
    """
    files = max(1, manifest.count())
    return manifest.repartitionByRange(files, "part").mapInArrow(
        _read, "id bigint, start bigint, n_tokens bigint, ids_crc32 bigint, part int, first_sequence bigint"
    )
