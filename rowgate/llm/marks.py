"""Bitmaps of fixed size over 64-bit hashes: what is not marked cannot be in the table they were made of.

They thin a large side before a join that decides; their size does not depend on the table, only
how many rows pass that have no partner.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A bitmap has 2**BITS bits: 8 MB.
BITS = 26
#: Bits that a row of Spark's bitmaps has.
_ROW_BITS = 1 << 15


def mark(table: DataFrame, hashes: Column) -> np.ndarray:
    """The bitmap of the 64-bit hashes of a table, by their upper bits."""
    bit = F.shiftrightunsigned(hashes, 64 - BITS) + 1
    rows = table.groupBy(F.bitmap_bucket_number(bit).alias("row")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(bit)).alias("bits")
    )
    bitmap = np.zeros((1 << BITS) // 8, np.uint8)
    for row in rows.toLocalIterator():  # 2**BITS / _ROW_BITS rows at most
        first = (row["row"] - 1) * _ROW_BITS // 8
        bitmap[first : first + _ROW_BITS // 8] = np.frombuffer(row["bits"], np.uint8)
    return bitmap


def marked(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    bit = (hashes >> np.uint64(64 - BITS)).astype(np.int64)
    return (bitmap[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1 > 0


def may_have(spark: SparkSession, bitmap: np.ndarray, hashes: Column) -> Column:
    """Whether a hash is marked; only the hashes go to the workers."""
    shared = spark.sparkContext.broadcast(bitmap)

    def look_up(values: pa.Array) -> pa.Array:
        return pa.array(marked(shared.value, values.to_numpy(zero_copy_only=False).view(np.uint64)))

    return F.arrow_udf(look_up, "boolean")(hashes)
