"""The operators that also run on streams.

Each function takes streaming DataFrames and returns one; the stateless and
aggregating ones are the batch operators themselves.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clearbook.operators.rules import event_rows, quote_events
from clearbook.operators.settlement import settlement_day_totals
from clearbook.operators.states import latest_by
from clearbook.operators.timing import FULFIL_TIMEOUT_SECONDS, FULFILLED, PREPARED, seconds


def parquet_stream(spark: SparkSession, path: str, schema: str, files_per_batch: int | None = None) -> DataFrame:
    """A Parquet file, or a folder of them with the folders in it, as a stream.

    The last letter is written as a glob: a plain path would have to be a folder.
    Columns that only the names of folders hold are not read.
    """
    path = path.rstrip("/")
    reader = spark.readStream.schema(schema).option("recursiveFileLookup", True)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(f"{path[:-1]}[{path[-1]}]")


def kafka_stream(spark: SparkSession, servers: str, topic: str, schema: str) -> DataFrame:
    """A topic of JSON messages as a stream; needs Spark's Kafka package on the class path."""
    messages = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .load()
    )
    return messages.select(F.from_json(F.col("value").cast("string"), schema).alias("message")).select("message.*")


def as_instant(ts: Column) -> Column:
    """A time without zone as an instant, read as UTC: watermarks need instants.

    Made from its parts, not by way of the session's zone, where an hour may be
    missing or come twice.
    """
    date = [F.year(ts), F.month(ts), F.dayofmonth(ts), F.hour(ts), F.minute(ts)]
    return F.make_timestamp(*date, F.date_part(F.lit("SECOND"), ts), F.lit("UTC"))


def as_utc_time(ts: Column) -> Column:
    """The reverse of ``as_instant``: the time since 1970, added to a time without zone."""
    seconds_since = (F.unix_micros(ts).cast("decimal(20,0)") / F.lit(1_000_000)).cast("decimal(18,6)")
    start = F.to_timestamp_ntz(F.lit("1970-01-01 00:00:00"))
    return start + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds_since)


def quote_event_stream(facts: DataFrame, rules: list[dict] | None = None) -> DataFrame:
    """Events of the quote rules for every arriving quote; keeps no state."""
    return event_rows(quote_events(facts, rules))


def latest_state_stream(
    changes: DataFrame,
    entity: str,
    order: str,
    values: list[str],
    ts: str | None = None,
    expiry: timedelta | None = None,
    lateness: str = "1 hour",
) -> DataFrame:
    """Latest state change per entity, for update mode.

    Without ``expiry`` the state is one row per entity, for good. With it, time is
    cut into stretches of that length: an entity's state is one row in each stretch
    in which it changes, and goes once the watermark (the newest ``ts`` seen, less
    ``lateness``) is past the stretch. Rows then also carry ``order``, by which a
    reader takes the latest of an entity's rows, those of forgotten stretches among
    them (``runs.run_updating`` with ``newest_by``). Changes later than the watermark of their
    stretch are dropped.
    """
    if expiry is None:
        return latest_by(changes, entity, order, values)
    moment, stretch = "_moment", "_stretch"
    timed = changes.select(entity, order, *values, as_instant(F.col(ts)).alias(moment)).withWatermark(moment, lateness)
    latest = F.max_by(F.struct(order, *values), order).alias("latest")
    grouped = timed.groupBy(F.window(moment, f"{int(expiry.total_seconds())} seconds").alias(stretch), entity)
    return grouped.agg(latest).select(entity, "latest.*")


def settlement_day_stream(transfers: DataFrame, by: list[str], ts: str, lateness: str) -> DataFrame:
    """Totals of each settlement day, given out once no row of that day can come any more."""
    timed = transfers.withColumn(ts, as_instant(F.col(ts))).withWatermark(ts, lateness)
    totals = settlement_day_totals(timed, by, ts)
    return totals.withColumns({day: as_utc_time(F.col(day)) for day in ("dayStart", "dayEnd")})


def timeout_stream(
    changes: DataFrame, lateness: str, timeout_seconds: int = FULFIL_TIMEOUT_SECONDS
) -> DataFrame:
    """Transfers whose preparation saw no fulfilment within the timeout.

    A left join of preparations and fulfilments, bounded by watermark and
    timeout on both sides, so state is dropped once a match is impossible.
    """

    def times(state: str, entity: str, ts: str) -> DataFrame:
        return (
            changes.where(F.col("transferStateId") == state)
            .select(F.col("transferId").alias(entity), as_instant(F.col("createdDate")).alias(ts))
            .withWatermark(ts, lateness)
        )

    prepared = times(PREPARED, "transferId", "preparedAt")
    fulfilled = times(FULFILLED, "fulfilledId", "fulfilledAt")
    in_time = (
        (F.col("transferId") == F.col("fulfilledId"))
        & (F.col("fulfilledAt") >= F.col("preparedAt"))
        & (F.col("fulfilledAt") <= F.col("preparedAt") + seconds(timeout_seconds))
    )
    unmatched = prepared.join(fulfilled, in_time, "leftOuter").where(F.col("fulfilledId").isNull())
    return unmatched.select("transferId", as_utc_time(F.col("preparedAt")).alias("preparedAt"))
