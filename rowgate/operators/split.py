"""The clean / quarantine split of a tagged table.

A tagged table carries ``rejection_reason``: NULL for an accepted row, else the one
reason the row was rejected for. Splitting filters on it, so no row can be lost or
appear on both sides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

REASON = "rejection_reason"
POSITION = "_position"
#: The line of a row whose number of fields is not its header's; null for all other rows.
MALFORMED = "_malformed"
MALFORMED_ROW = "malformed row"
#: For rows that are tagged with an empty text.
UNNAMED = "rejected without a reason"


def accepted() -> Column:
    return F.col(REASON).isNull()


def clean_rows(tagged: DataFrame) -> DataFrame:
    """Accepted rows, with the columns of the table itself."""
    return tagged.where(accepted()).drop(REASON, POSITION, MALFORMED)


def quarantined_rows(tagged: DataFrame) -> DataFrame:
    """Rejected rows, with ``rejection_reason``."""
    return tagged.where(~accepted()).drop(POSITION)


def rejections_by_reason(tagged: DataFrame, table: str) -> DataFrame:
    """Rows per reason; the accepted rows have the reason NULL."""
    return (
        tagged.groupBy(REASON)
        .agg(F.count(F.lit(1)).alias("row_count"))
        .select(F.lit(table).alias("table"), REASON, "row_count")
    )


def accounting(tagged: DataFrame, table: str) -> DataFrame:
    """Rows in, kept and quarantined; in = cleaned + quarantined."""
    return tagged.agg(
        F.lit(table).alias("table"),
        F.count(F.lit(1)).alias("rows_in"),
        F.count_if(accepted()).alias("rows_cleaned"),
        F.count_if(~accepted()).alias("rows_quarantined"),
    )
