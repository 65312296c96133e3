"""Settlement of transfers: details, net positions, settlement days."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clearbook.functions.text import iso_millis, or_null_word, when_settled
from clearbook.operators.joins import left_join_if_present, lookup
from clearbook.operators.transfers import PAYER_ROLE

Tables = Mapping[str, DataFrame]

# The settlement day starts at 08:30.
DAY_START = "8 hours 30 minutes"


def with_settlement(df: DataFrame, ledger: Tables) -> DataFrame:
    """Add the current settlement state of ``settlementWindowId``.

    Adds ``settlementStateId`` and ``settledAt``; rows without a window, or
    whose window is not in a settlement, keep NULLs. Rows have a ``transferId``.
    """
    in_settlement = ledger["settlementSettlementWindow"]
    current = ledger["settlement"].select("settlementId", F.col("currentStateChangeId").alias("settlementStateChangeId"))
    states = ledger["settlementStateChange"].select(
        "settlementStateChangeId", "settlementStateId", F.col("createdDate").alias("settledAt")
    )
    df = left_join_if_present(df, lookup(in_settlement), "settlementWindowId")
    df = left_join_if_present(df, lookup(current), "settlementId")
    df = left_join_if_present(df, lookup(states), "settlementStateChangeId")
    return df.drop("settlementId", "settlementStateChangeId")


def settlement_details(ledger: Tables, of: DataFrame | None = None) -> DataFrame:
    """Window and settlement state of each fulfilled transfer, as text.

    ``of`` restricts the transfers by ``transferId``.
    """
    settled_at = iso_millis(F.col("settledAt"))
    fulfilled = ledger["transferFulfilment"]
    if of is not None:
        fulfilled = fulfilled.join(lookup(of.select("transferId")), "transferId", "left_semi")
    return with_settlement(fulfilled, ledger).select(
        "transferId",
        or_null_word(when_settled(F.col("settlementStateId"), settled_at)).alias("settlementDate"),
        or_null_word(F.col("settlementWindowId")).alias("settlementWindowId"),
        or_null_word(F.col("settlementStateId")).alias("settlementState"),
        or_null_word(settled_at).alias("settlementStateChangeDate"),
    )


def leg_settlements(core: DataFrame, ledger: Tables, leg: str) -> DataFrame:
    """Settlement details of the core's transfers on one leg, ``"A"`` or ``"B"``."""
    wanted = core.select(F.col(f"leg{leg}TransferId").alias("transferId")).where(F.col("transferId").isNotNull())
    return settlement_details(ledger, of=wanted)


def net_positions(ledger: Tables) -> DataFrame:
    """Deferred net settlement: what each participant paid and got per currency and window.

    Lines are summed per account and window before the accounts are looked up,
    so a busy window or account is a sum per task, not a group in one task.
    """
    roles = ledger["transferParticipantRoleType"].select(
        "transferParticipantRoleTypeId", (F.col("name") == PAYER_ROLE).alias("pays")
    )
    per_account = (
        ledger["transferFulfilment"]
        .where(F.col("settlementWindowId").isNotNull())
        .join(ledger["transferParticipant"], "transferId")
        .join(lookup(roles), "transferParticipantRoleTypeId")
        .groupBy("participantCurrencyId", "settlementWindowId")
        .agg(
            F.sum(F.when(F.col("pays"), F.col("amount")).otherwise(0)).alias("debit"),
            F.sum(F.when(F.col("pays"), 0).otherwise(-F.col("amount"))).alias("credit"),
        )
    )
    return (
        per_account.join(lookup(ledger["participantCurrency"]), "participantCurrencyId")
        .join(lookup(ledger["participant"]), "participantId")
        .groupBy("participantId", "name", "currencyId", "settlementWindowId")
        .agg(F.sum("debit").alias("debit"), F.sum("credit").alias("credit"))
        .withColumn("netPosition", F.col("credit") - F.col("debit"))
    )


def settlement_day_totals(transfers: DataFrame, by: list[str], ts: str = "createdDate", start: str = DAY_START) -> DataFrame:
    """Count and sum of amounts per settlement day, which starts at ``start``."""
    day = F.window(ts, "1 day", "1 day", start).alias("day")
    return (
        transfers.groupBy(day, *by)
        .agg(F.count("amount").alias("numTransfers"), F.sum("amount").alias("totalAmount"))
        .select(F.col("day.start").alias("dayStart"), F.col("day.end").alias("dayEnd"), *by, "numTransfers", "totalAmount")
    )
