"""Current state from append-only state changes."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clearbook.operators.joins import lookup

Tables = Mapping[str, DataFrame]

# The states the reports show.
REPORTED_STATES = ["COMMITTED", "RESERVED", "ABORTED"]


def latest_by(changes: DataFrame, entity: str, order: str, values: list[str]) -> DataFrame:
    """The row with the highest ``order`` per ``entity``.

    A max_by keeps one candidate per entity and task before the shuffle, so an
    entity may have any number of changes.
    """
    latest = F.max_by(F.struct(*values), order).alias("latest")
    return changes.groupBy(entity).agg(latest).select(entity, "latest.*")


def latest_transfer_state(ledger: Tables, of: DataFrame | None = None) -> DataFrame:
    """Latest state change per transfer, whatever the state.

    ``of`` restricts the transfers by ``transferId``. That comes before the
    grouping, so the changes of all other transfers are only read.
    """
    changes = ledger["transferStateChange"]
    if of is not None:
        changes = changes.join(lookup(of.select("transferId")), "transferId", "left_semi")
    return latest_by(changes, "transferId", "transferStateChangeId", ["transferStateId", "createdDate"])


def reported_transfer_state(ledger: Tables, of: DataFrame | None = None) -> DataFrame:
    """Latest state per transfer, where that state is one the reports show."""
    shown = ledger["transferState"].where(F.col("enumeration").isin(REPORTED_STATES))
    return latest_transfer_state(ledger, of).join(lookup(shown), "transferStateId")


def leg_a_ids(core: DataFrame) -> DataFrame:
    """The core's leg-A transfers, or the transfer itself where there is no leg A."""
    return core.select(F.coalesce("legATransferId", "currentHubTransferID").alias("transferId"))


def leg_b_ids(core: DataFrame) -> DataFrame:
    """The core's leg-B transfers."""
    return core.where(F.col("legBTransferId").isNotNull()).select(F.col("legBTransferId").alias("transferId"))


def leg_a_states(core: DataFrame, ledger: Tables) -> DataFrame:
    """Reported states of the core's leg-A transfers, or of the transfer itself without a leg A."""
    return reported_transfer_state(ledger, of=leg_a_ids(core))


def leg_b_states(core: DataFrame, ledger: Tables) -> DataFrame:
    """Reported states of the core's leg-B transfers."""
    return reported_transfer_state(ledger, of=leg_b_ids(core))


def window_state_pairs(ledger: Tables, closed: str = "inner") -> DataFrame:
    """Opening and closing time of each settlement window.

    Each combination of an OPEN and a CLOSED row counts, as the reports have it.
    ``closed="left"`` keeps windows that have not closed.
    """
    changes = ledger["settlementWindowStateChange"]

    def times(state: str, name: str) -> DataFrame:
        return changes.where(F.col("settlementWindowStateId") == state).select(
            "settlementWindowId", F.col("createdDate").alias(name)
        )

    return times("OPEN", "windowOpen").join(lookup(times("CLOSED", "windowClose")), "settlementWindowId", closed)
