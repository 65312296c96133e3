"""As-of merge: rows and marks as one stream ordered by time, in pieces of a day."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# Rows of one key and day that one task may get; more are spread over several.
ROWS_PER_PIECE = 1 << 20
# Pieces for rows without a key or time, which no mark can reach.
PIECES_WITHOUT_KEY = 64


def numbered_times(times: DataFrame, by: list[str], at: str, name: str) -> DataFrame:
    """The distinct times of each key with ``name``: their number, from 0, in order.

    Times are put in order within a day, and only counts of days are added up over
    a key, so that a key with most of the times is not sorted in one task.
    """
    days = times.groupBy(*by, F.to_date(at).alias("_day")).agg(F.sort_array(F.collect_set(at)).alias("_times"))
    earlier = W.partitionBy(*by).orderBy("_day").rowsBetween(W.unboundedPreceding, -1)
    counted = days.withColumn("_before", F.coalesce(F.sum(F.size("_times")).over(earlier), F.lit(0)))
    placed = counted.select(*by, "_before", F.posexplode("_times").alias("_place", at))
    return placed.select(*by, at, (F.col("_before") + F.col("_place")).alias(name))


def with_last_mark(
    rows: DataFrame, marks: DataFrame, by: list[str], ts: str, key: str, rows_per_piece: int = ROWS_PER_PIECE
) -> DataFrame:
    """Add ``mark`` of the last mark at or before each row's ``ts``; NULL if there is none.

    ``marks`` has the columns ``by``, ``at`` and ``mark``, with one mark for each key
    and time. Rows and marks of a key and day are merged in order of time, after
    the last mark of the days before, which is carried in. A day of a key with more
    than ``rows_per_piece`` rows is dealt to several pieces by hash of ``key``, and its
    marks go to each of them. The rows are read twice: for the counts of days, and to be merged.
    """
    dated = rows.withColumn("_day", F.to_date(ts))
    reachable = F.col("_day").isNotNull()
    for column in by:
        reachable &= F.col(column).isNotNull()
    place = [*by, "_day"]
    pieces = F.ceil(F.count("*") / rows_per_piece).cast("long").alias("_pieces")
    days = dated.where(reachable).groupBy(*place).agg(pieces)
    # At most one row for every ``rows_per_piece`` rows.
    crowded = F.broadcast(days.where("_pieces > 1"))
    spread = F.when(reachable, F.coalesce("_pieces", F.lit(1))).otherwise(PIECES_WITHOUT_KEY)
    placed = dated.join(crowded, place, "left").withColumn("_piece", F.pmod(F.xxhash64(key), spread))

    marks = marks.select(*by, F.to_date("at").alias("_day"), "at", "mark")
    kind = marks.schema["mark"].dataType
    last_of_day = marks.groupBy(*place).agg(F.max_by("mark", "at").alias("mark"))
    known = days.withColumn("mark", F.lit(None).cast(kind)).unionByName(last_of_day, allowMissingColumns=True)
    known = known.groupBy(*place).agg(F.max("_pieces").alias("_pieces"), F.first("mark", ignorenulls=True).alias("mark"))
    earlier = W.partitionBy(*by).orderBy("_day").rowsBetween(W.unboundedPreceding, -1)
    carried = known.withColumn("mark", F.last("mark", ignorenulls=True).over(earlier)).where("_pieces IS NOT NULL AND mark IS NOT NULL")
    met = marks.join(days, place)

    def streamed(df: DataFrame, at) -> DataFrame:
        piece = F.explode(F.sequence(F.lit(0).cast("long"), F.col("_pieces") - 1)).alias("_piece")
        return df.select(*place, piece, at.alias("_at"), "mark", F.lit(None).cast(rows.schema).alias("_row"))

    moment = rows.schema[ts].dataType
    every = F.struct(*[F.col(c) for c in rows.columns]).alias("_row")
    stream = (
        placed.select(*place, "_piece", F.col(ts).alias("_at"), F.lit(None).cast(kind).alias("mark"), every)
        .unionByName(streamed(carried, F.lit(None).cast(moment)))
        .unionByName(streamed(met, F.col("at")))
    )
    order = [F.asc_nulls_first("_at"), F.col("_row").isNotNull()]
    so_far = W.partitionBy(*place, "_piece").orderBy(*order).rowsBetween(W.unboundedPreceding, W.currentRow)
    merged = stream.withColumn("mark", F.last("mark", ignorenulls=True).over(so_far))
    return merged.where(F.col("_row").isNotNull()).select("_row.*", "mark")
