"""Integer vectors: rows out of Arrow lists, and products without rounding."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Integers up to this size are exact as doubles.
EXACT_BITS = 53


def without_gaps(table: DataFrame, vector_col: str) -> DataFrame:
    """Rows whose vector is there and holds finite components alone; an empty vector counts as such."""
    x = F.col(vector_col).cast("array<double>")
    return table.where(x.isNotNull() & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))))


def saturation(width: int, spare_bits: int = 2) -> int:
    """The largest power of two at which sums of ``width`` products stay below ``2 ** (63 - spare_bits)``."""
    return 1 << ((63 - spare_bits - math.ceil(math.log2(max(1, width)))) // 2)


def floored(vector: Column, scale: int, most: int) -> Column:
    """``floor(scale * x)`` of each component as double; beyond ``most`` in size it stays at ``most``."""
    high = F.lit(float(most))
    return F.transform(vector.cast("array<double>"), lambda x: F.floor(F.least(F.greatest(x * scale, -high), high)))


def extended(schema: StructType, columns: str) -> StructType:
    """A schema with further columns."""
    return StructType([*schema.fields, *StructType.fromDDL(columns).fields])


def longest(table: DataFrame, vector_col: str) -> int:
    """Components of the longest vector."""
    return table.agg(F.max(F.size(vector_col))).first()[0] or 0


def rows_of(column: pa.Array | pa.ChunkedArray, width: int) -> np.ndarray:
    """Lists of integers as the rows of a matrix; shorter ones are filled up with zeros."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat, offsets = column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy()
    sizes = np.diff(offsets)
    out = np.zeros((len(sizes), width), dtype=np.int64)
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(sizes.sum()) - np.repeat(offsets[:-1] - offsets[0], sizes)] = flat[offsets[0] : offsets[-1]]
    return out


def limbs(values: np.ndarray, bits: int) -> list[np.ndarray]:
    """Integers cut into pieces of ``bits``, lowest first; the highest carries the sign."""
    pieces = []
    while values.size and max(-int(values.min()), int(values.max()) + 1) > 1 << bits:
        pieces.append((values & ((1 << bits) - 1)).astype(np.float64))
        values = values >> bits
    return [*pieces, values.astype(np.float64)]


def products(left: np.ndarray, right: np.ndarray, bits: int | None = None) -> np.ndarray:
    """All inner products of the rows of two integer matrices, without rounding.

    Limbs are so narrow that a sum of their products stays within 53 bits, so
    that each matrix product of doubles is exact in any order of summation; the
    parts are put together as 64-bit integers. Results must fit in those.
    """
    if bits is None:
        bits = (EXACT_BITS - math.ceil(math.log2(max(1, left.shape[1])))) // 2
    total = np.zeros((len(left), len(right)), dtype=np.int64)
    for i, a in enumerate(limbs(left, bits)):
        for j, b in enumerate(limbs(right, bits)):
            total += (a @ b.T).astype(np.int64) << (bits * (i + j))
    return total
