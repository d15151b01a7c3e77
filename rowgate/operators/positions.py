"""Where rows stand in their input."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .split import POSITION


def place_of(df: DataFrame, several: bool | None = None) -> tuple[Column, bool]:
    """Where a row stands in its input, and whether that is the same in every run.

    Of Parquet, the file and the row in it; of other files, the file, the block and the
    order within the scan of the block. Blocks are read in any order and packed by size, so
    the scan order alone would depend on the sizes of the files and on the cores. ``several``
    says that the input has other files than the scan's own.
    """
    known = _file_fields(df)
    # One file needs no name; each name would be carried by every row.
    file = ["_metadata.file_path"] if known and (several or len(df._jdf.inputFiles()) > 1) else []
    if "row_index" in known:
        return F.struct(*file, "_metadata.row_index"), True
    row = F.monotonically_increasing_id().alias("row")
    if known:
        return F.struct(*file, "_metadata.file_block_start", row), False
    return F.struct(row), False


def _file_fields(df: DataFrame) -> list[str]:
    """What a row of the table knows about its file; nothing unless the table is a plain scan."""
    hidden = df._jdf.queryExecution().analyzed().metadataOutput()
    for i in range(hidden.size()):
        if hidden.apply(i).name() == "_metadata":
            return list(hidden.apply(i).dataType().fieldNames())
    return []


def with_positions(df: DataFrame, several: bool | None = None) -> DataFrame:
    """Add the place of each row in its input: files by name, then rows as they stand there.

    For other input than files, the scan order. Places that hold a scan order are final once
    the rows are staged.
    """
    return df.withColumn(POSITION, place_of(df, several)[0])
