"""Numbering the rows of a result in order, without one task for all of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from clearbook.sources.sinks import staged


def with_ordinals(df: DataFrame, order: list[str | Column], name: str = "ordinal") -> DataFrame:
    """Add ``name``, the row's number from 1 in the given order.

    Rows are dealt by ranges of the order, sorted within each and written with
    their place there. Only the number of rows of each range is added up, a table
    with one row for each partition, which is what is broadcast. Rows that are equal
    in ``order`` get different numbers, in any order; name further columns to break ties.
    """
    part, place = "_range", "_place"
    # The place within a partition is what the id counts in its lower 33 bits.
    within = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    ordered = df.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = staged(ordered.withColumn(place, within).withColumn(part, F.spark_partition_id()), "ordered")
    counts = placed.groupBy(part).agg(F.count("*").alias("_rows"))
    earlier = W.orderBy(part).rowsBetween(W.unboundedPreceding, -1)
    before = counts.select(part, F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"))
    ordinal = (F.col("_before") + F.col(place) + 1).alias(name)
    return placed.join(F.broadcast(before), part).select(*df.columns, ordinal)
