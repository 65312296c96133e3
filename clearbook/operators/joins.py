"""Join helpers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


# Estimated size up to which a look-up table is sent to every executor.
LOOKUP_BYTES = 8 << 20


def estimated_bytes(df: DataFrame) -> int:
    """Size of a result as its plan estimates it, from file sizes and without a job."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def lookup(df: DataFrame) -> DataFrame:
    """A look-up table, to be broadcast if its estimated size is small.

    A larger table, or one of unknown size, is joined as Spark sees fit.
    """
    return F.broadcast(df) if estimated_bytes(df) <= LOOKUP_BYTES else df


def left_join_if_present(
    df: DataFrame, other: DataFrame, key: str, other_key: str | None = None, spread: str = "transferId"
) -> DataFrame:
    """Left join on a key that is often NULL, without one task for all the NULLs.

    The key's hash is the first key of the join. A row without the key takes the
    hash of ``spread`` instead, which only places it in some partition: the second
    key is NULL, so it matches nothing. ``other`` keeps its columns except its key.
    """
    right_key, left_hash, right_hash = "_other_key", "_spread_hash", "_other_hash"
    kind = df.schema[key].dataType
    other = other.withColumnRenamed(other_key or key, right_key)
    other = other.withColumn(right_hash, F.xxhash64(F.col(right_key).cast(kind)))
    hashed = F.when(F.col(key).isNull(), F.xxhash64(spread)).otherwise(F.xxhash64(key))
    return (
        df.withColumn(left_hash, hashed)
        .join(other, (F.col(left_hash) == F.col(right_hash)) & (F.col(key) == F.col(right_key)), "left")
        .drop(left_hash, right_hash, right_key)
    )


def repeated_as_matched(df: DataFrame, key: str, other: DataFrame, other_key: str) -> DataFrame:
    """What a left join with ``other`` does to the rows, where none of its columns is used.

    A row comes once for each row of ``other`` with its key, and once without any.
    Only keys that ``other`` has several times matter. Spark knows at run time
    whether there are any: if not, the table joined is empty and the join goes.
    """
    copies, matched = "_copies", "_repeated_key"
    repeated = other.groupBy(F.col(other_key).alias(matched)).agg(F.count("*").alias(copies))
    repeated = repeated.where((F.col(copies) > 1) & F.col(matched).isNotNull())
    joined = df.join(repeated, F.col(key) == F.col(matched), "left")
    times = F.sequence(F.lit(1).cast("long"), F.coalesce(copies, F.lit(1).cast("long")))
    return joined.withColumn("_copy", F.explode(times)).drop("_copy", copies, matched)
