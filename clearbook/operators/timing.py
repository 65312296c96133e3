"""Deadlines: expired quotes and transfers that were not fulfilled in time."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clearbook.functions.text import report_time

Tables = Mapping[str, DataFrame]

# Life of a quote and time to fulfil a transfer, in seconds.
QUOTE_EXPIRY_SECONDS = 60
FULFIL_TIMEOUT_SECONDS = 432000

PREPARED, FULFILLED = "RECEIVED_PREPARE", "COMMITTED"


def seconds(count: int) -> Column:
    return F.lit(timedelta(seconds=count))


def quote_expiry(ledger: Tables, expiry_seconds: int = QUOTE_EXPIRY_SECONDS) -> DataFrame:
    """Transfers with their quote's expiry; ``expired`` ones are to be rejected."""
    quotes = ledger["quote"].select("quoteId", (F.col("createdDate") + seconds(expiry_seconds)).alias("expiresAt"))
    transfers = ledger["transfer"].select("transferId", F.col("createdDate").alias("transferredAt"))
    return (
        quotes.join(ledger["transactionReference"].withColumnRenamed("transactionReferenceId", "transferId"), "quoteId")
        .join(transfers, "transferId")
        .select(
            "transferId", "quoteId", "transferredAt", "expiresAt",
            (F.col("transferredAt") > F.col("expiresAt")).alias("expired"),
        )
    )


def timed_out_transfers(
    changes: DataFrame, as_of: str | datetime, timeout_seconds: int = FULFIL_TIMEOUT_SECONDS
) -> DataFrame:
    """Transfers prepared but not fulfilled within the timeout, seen at ``as_of``.

    One pass over the state changes keeps two times per transfer and task, so
    there is no join of preparations with fulfilments.
    """

    def first(state: str) -> Column:
        return F.min(F.when(F.col("transferStateId") == state, F.col("createdDate")))

    deadline = F.col("preparedAt") + seconds(timeout_seconds)
    return (
        changes.where(F.col("transferStateId").isin(PREPARED, FULFILLED))
        .groupBy("transferId")
        .agg(first(PREPARED).alias("preparedAt"), first(FULFILLED).alias("fulfilledAt"))
        .where(F.coalesce(F.col("fulfilledAt") > deadline, F.lit(True)) & (deadline < report_time(as_of)))
        .withColumn("deadline", deadline)
    )
