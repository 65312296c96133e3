"""The reports. Each takes the ledger's tables and returns a DataFrame."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clearbook.functions.fx import decoded_rate, rounding_difference
from clearbook.functions.text import (
    float_text,
    iso_millis,
    or_empty,
    or_null_word,
    parsed_report_time,
    plain_number,
    report_time,
    when_settled,
)
from clearbook.operators.joins import left_join_if_present, lookup, repeated_as_matched
from clearbook.operators.ordering import with_ordinals
from clearbook.operators.settlement import settlement_details, with_settlement
from clearbook.operators.states import (
    latest_transfer_state,
    reported_transfer_state,
    window_state_pairs,
)
from clearbook.operators.transfers import (
    dfsp_transfer_core,
    exchange_as_first_leg,
    exchange_as_second_leg,
    hub_transfer_core,
    named_pairs,
    quoted_transfers,
    quotes_between,
)
from clearbook.sources.periods import of_quotes_between, of_window

Tables = Mapping[str, DataFrame]

# The columns of the reports, in their order, are those their users know.


def fx_amounts(core: DataFrame, ledger: Tables) -> DataFrame:
    """Add the quoted amounts, the decoded rate and the rate set to a transfer core."""
    responses = ledger["quoteResponse"].withColumnRenamed("quoteId", "pricedQuoteId")
    rates = ledger["exchange_channel_rates"].select(
        F.col("id").alias("exchangeRateId"), decoded_rate(F.col("rate"), F.col("decimals")).alias("forex")
    )
    rate_sets = ledger["citiExchangeRate"].select("exchangeRateId", "rateSetId")
    priced = core.withColumn("pricedQuoteId", F.coalesce("legAQuoteAId", "legBQuoteAId", "quoteId"))
    df = priced.join(responses, "pricedQuoteId", "left")
    for table in (rates, rate_sets):
        df = left_join_if_present(df, lookup(table), "exchangeRateId", spread="currentHubTransferID")
    return df


def _with_legs(core: DataFrame, ledger: Tables) -> DataFrame:
    """Add state and settlement of both legs; columns are prefixed ``a_`` and ``b_``.

    Leg A falls back to the transfer itself for the state but not for the
    settlement. Both look-ups of a leg share one key, hence one shuffle of the
    core; states and settlements lie by transfer already and stay where they are.
    """

    def look_up(df: DataFrame, found: DataFrame, leg: str, only_if: Column | None = None) -> DataFrame:
        on = F.col("legKey") == F.col("foundKey")
        columns = [F.col(c).alias("foundKey" if c == "transferId" else f"{leg}_{c}") for c in found.columns]
        return df.join(found.select(*columns), on if only_if is None else on & only_if, "left").drop("foundKey")

    states = reported_transfer_state(ledger).select("transferId", "enumeration", "createdDate")
    settlements = settlement_details(ledger)
    has_a, has_b = F.col("legATransferId").isNotNull(), F.col("legBTransferId").isNotNull()
    df = core.withColumn("legKey", F.coalesce("legATransferId", "currentHubTransferID"))
    df = look_up(df, states, "a")
    df = look_up(df, settlements, "a", has_a)
    df = df.withColumn("legKey", F.coalesce("legBTransferId", "currentHubTransferID"))
    df = look_up(df, states, "b", has_b)
    return look_up(df, settlements, "b", has_b).drop("legKey")


def _assembled(core: DataFrame, ledger: Tables) -> DataFrame:
    """The core with amounts, states and settlements, as one lazy plan."""
    return _with_legs(fx_amounts(core, ledger), ledger)


def _money_columns() -> list[Column]:
    sent, received = F.col("transferAmount"), F.col("payeeReceiveAmount")
    return [
        plain_number(sent).alias("senderAmount"),
        plain_number(F.coalesce(received, sent)).alias("receiverAmount"),
        or_null_word(float_text(F.col("forex"))).alias("forexRate"),
        or_null_word(F.col("rateSetId")).alias("fxRateSetID"),
        or_null_word(float_text(rounding_difference(sent, F.col("forex"), received))).alias("rounding"),
        F.col("receiverNameStatus"),
        F.col("pricingOption"),
        F.col("receiverKYCLevelStatus"),
        or_null_word(F.col("a_enumeration")).alias("senderTxStatus"),
    ]


def _closing_columns() -> list[Column]:
    return [
        iso_millis(F.col("a_createdDate")).alias("modificationDate"),
        F.col("errorCode"),
        F.col("senderDFSPTxnID"),
        F.col("receiverDFSPTxnID"),
        or_null_word(F.col("a_settlementWindowId")).alias("senderSettlementWindowId"),
        or_null_word(F.col("b_settlementWindowId")).alias("receiverSettlementWindowId"),
        or_null_word(F.col("a_settlementState")).alias("settlementState"),
        or_null_word(F.col("a_settlementStateChangeDate")).alias("settlementStateChangeDate"),
    ]


def daily_dfsp_transactions(
    ledger: Tables, start: str | datetime, end: str | datetime, fsp_id: str
) -> DataFrame:
    """Transfers one participant paid or received, both exchange legs on each row."""
    ledger = of_quotes_between(ledger, report_time(start), report_time(end))
    core = dfsp_transfer_core(ledger, report_time(start), report_time(end), fsp_id)
    report = _assembled(core, ledger).select(
        "senderDFSPName",
        "receiverDFSPName",
        F.col("currentHubTransferID").alias("currentTransferID"),
        "parentTransferID",
        F.col("reciprocalHubTransferID").alias("reciprocalTransferID"),
        "transactionType",
        "natureOfTxnType",
        "requestDate",
        "createdDate",
        or_null_word(F.col("a_settlementDate")).alias("settlementDate"),
        F.col("transferAmountCurrencyId").alias("senderCurrency"),
        F.coalesce("payeeReceiveAmountCurrencyId", "transferAmountCurrencyId").alias("receiverCurrency"),
        "senderId",
        "receiverId",
        *_money_columns(),
        F.coalesce("b_enumeration", "a_enumeration").alias("receiverTxStatus"),
        *_closing_columns(),
    )
    return report.distinct().orderBy("createdDate")


def in_report_order(report: DataFrame, transfer: str) -> DataFrame:
    """A daily report with ``ordinal``, its order by time of transfer as a column; ties by transfer, then by the rest."""
    rest = [c for c in report.columns if c not in ("createdDate", transfer)]
    return with_ordinals(report, ["createdDate", transfer, *rest])


def _hub_transactions(ledger: Tables, start: str | datetime, end: str | datetime) -> DataFrame:
    ledger = of_quotes_between(ledger, report_time(start), report_time(end))
    core = hub_transfer_core(ledger, report_time(start), report_time(end))
    return _assembled(core, ledger).select(
        "senderDFSPName",
        "leg1vDFSP",
        "leg2vDFSP",
        "receiverDFSPName",
        F.col("currentHubTransferID").alias("senderTransferID"),
        "parentTransferID",
        F.col("reciprocalHubTransferID").alias("receiverTransferID"),
        "transactionType",
        "natureOfTxnType",
        "requestDate",
        "createdDate",
        or_null_word(F.col("a_settlementDate")).alias("settlementDate"),
        F.col("transferAmountCurrencyId").alias("senderCurrency"),
        F.col("payeeReceiveAmountCurrencyId").alias("receiverCurrency"),
        "senderId",
        "receiverId",
        *_money_columns(),
        or_null_word(F.col("b_enumeration")).alias("receiverTxStatus"),
        *_closing_columns(),
    )


def daily_hub_transactions(ledger: Tables, start: str | datetime, end: str | datetime) -> DataFrame:
    """Hub-wide exchange payments, with the virtual participant of each leg."""
    return _hub_transactions(ledger, start, end).distinct().orderBy("createdDate")


def daily_hub_transactions_anonymous(ledger: Tables, start: str | datetime, end: str | datetime) -> DataFrame:
    """The hub report without the parties' identifiers."""
    return _hub_transactions(ledger, start, end).drop("senderId", "receiverId").distinct().orderBy("createdDate")


def settlement_window_summary(ledger: Tables) -> DataFrame:
    """Count and sum of the quoted amounts per participant and settlement window.

    Amounts are summed per participant and window first; windows, of which
    there are few, are looked up for the sums only.
    """
    roles = ledger["transferParticipantRoleType"].select("transferParticipantRoleTypeId")
    references = ledger["transactionReference"].withColumnRenamed("transactionReferenceId", "transferId")
    parties = ledger["quoteParty"].select(
        F.col("quoteId").alias("partyQuoteId"),
        F.col("transferParticipantRoleTypeId").alias("partyRole"),
        "fspId",
        F.col("amount").alias("quotedAmount"),
    )
    # The role is compared as a difference, which leaves the bucketed id as the
    # only join key: the quote parties are then merged without a shuffle.
    of_line = (F.col("lineQuoteId") == F.col("partyQuoteId")) & (
        F.col("transferParticipantRoleTypeId") - F.col("partyRole") == 0
    )
    sums = (
        ledger["transferFulfilment"]
        .where(F.col("settlementWindowId").isNotNull())
        .join(ledger["transferParticipant"].drop("amount"), "transferId")
        .join(lookup(roles), "transferParticipantRoleTypeId")
        .join(references, "transferId", "left")
        # A transfer without a quote matches no party; its own id spreads such rows.
        .withColumn("lineQuoteId", F.coalesce("quoteId", "transferId"))
        .join(parties, of_line & F.col("quoteId").isNotNull(), "left")
        .groupBy("fspId", "settlementWindowId")
        .agg(F.count("quotedAmount").alias("numTransactions"), F.sum("quotedAmount").alias("netPosition"))
    )
    current = ledger["settlementWindow"].select(
        "settlementWindowId", F.col("currentStateChangeId").alias("settlementWindowStateChangeId")
    )
    states = ledger["settlementWindowStateChange"].select(
        "settlementWindowStateChangeId", F.col("settlementWindowStateId").alias("state")
    )
    return (
        sums.join(lookup(current), "settlementWindowId")
        .join(lookup(states), "settlementWindowStateChangeId")
        .join(window_state_pairs(ledger, closed="left"), "settlementWindowId")
        .select(
            "fspId", "settlementWindowId", "state", "numTransactions", "netPosition", "windowOpen", "windowClose"
        )
    )


def _quote_parties_by_type(ledger: Tables, party_type: int, side: str) -> DataFrame:
    parties = ledger["quoteParty"].where(F.col("partyTypeId") == party_type)
    return parties.select(
        "quoteId",
        F.col("participantId").alias(f"{side}Id"),
        F.col("fspId").alias(f"{side}Fsp"),
        F.col("currencyId").alias(f"{side}Currency"),
        F.col("partyIdentifierValue").alias(f"{side}Identifier"),
    )


def _reconciliation_rows(
    ledger: Tables,
    start: str,
    end: str,
    fsp_id: str | None = None,
    settlement_window_id: int | None = None,
) -> DataFrame:
    ledger = of_quotes_between(ledger, parsed_report_time(start), parsed_report_time(end))

    def owner(side: str) -> DataFrame:
        return ledger["participant"].select(
            F.col("participantId").alias(f"{side}Id"), F.col("name").alias(f"{side}Name")
        )

    quoted = (
        quotes_between(ledger, parsed_report_time(start), parsed_report_time(end))
        .join(_quote_parties_by_type(ledger, 1, "payer"), "quoteId")
        .join(_quote_parties_by_type(ledger, 2, "payee"), "quoteId")
        .join(lookup(owner("payer")), "payerId")
        .join(lookup(owner("payee")), "payeeId")
    )
    if fsp_id is not None:
        quoted = quoted.where((F.col("payerName") == fsp_id) | (F.col("payeeName") == fsp_id))

    fulfilment = ledger["transferFulfilment"].withColumnRenamed("transferId", "fulfilledId")
    if settlement_window_id is not None:
        fulfilment = fulfilment.where(F.col("settlementWindowId") == settlement_window_id)
    transfers = ledger["transfer"].select("transferId", F.col("createdDate").alias("transferredAt"), "amount")
    latest = latest_transfer_state(ledger).withColumnRenamed("createdDate", "modificationDate")
    rows = (
        # A response must exist; its columns are not shown and rows are distinct.
        quoted.join(ledger["quoteResponse"].select("quoteId"), "quoteId", "left_semi")
        .join(ledger["transactionReference"].withColumnRenamed("transactionReferenceId", "transferId"), "quoteId")
        .join(transfers, "transferId")
        .join(
            fulfilment,
            F.col("transferId") == F.col("fulfilledId"),
            "left" if settlement_window_id is None else "inner",
        )
        .join(latest, "transferId", "left")
    )
    state, settled_at = F.col("settlementStateId"), F.col("settledAt")
    return (
        with_settlement(rows, ledger)
        .select(
            "quoteId",
            F.col("payerName").alias("senderDFSPId"),
            F.col("payerName").alias("senderDFSPName"),
            F.col("payeeFsp").alias("receiverDFSPId"),
            F.col("payeeName").alias("receiverDFSPName"),
            F.col("transferId").alias("hubTxnID"),
            "transactionType",
            "natureOfTxnType",
            F.col("quotedAt").alias("requestDate"),
            F.col("transferredAt").alias("createdDate"),
            when_settled(state, settled_at).alias("settlementDate"),
            F.col("payerCurrency").alias("senderCountryCurrencyCode"),
            F.col("payeeCurrency").alias("receiverCountryCurrencyCode"),
            F.col("payerIdentifier").alias("senderId"),
            F.col("payeeIdentifier").alias("receiverId"),
            F.col("amount").alias("reconciliationAmount"),
            F.lit("RNND").alias("receiverNameStatus"),
            F.lit("").alias("pricingOption"),
            F.lit("").alias("receiverKYCLevelStatus"),
            F.col("transferStateId").alias("status"),
            "modificationDate",
            F.lit("").alias("errorCode"),
            F.col("transferId").alias("senderDFSPTxnID"),
            F.col("transferId").alias("receiverDFSPTxnID"),
            or_empty(F.col("settlementWindowId")).alias("settlementWindowId"),
            state.alias("settlementState"),
            settled_at.alias("settlementStateChangeDate"),
        )
        .distinct()
    )


def transaction_reconciliation(
    ledger: Tables, fsp_id: str, start: str, end: str, settlement_window_id: int | None = None
) -> DataFrame:
    """Quotes and transfers of one participant, optionally of one settlement window."""
    return _reconciliation_rows(ledger, start, end, fsp_id, settlement_window_id)


def hub_transactions_legacy(ledger: Tables, start: str, end: str) -> DataFrame:
    """The reconciliation rows of the whole hub."""
    return _reconciliation_rows(ledger, start, end)


def reconciliation_amounts(ledger: Tables, participant_id: int, settlement_window_id: int) -> DataFrame:
    """What one participant sent to and received from each other in a closed window."""
    ledger = of_window(ledger, settlement_window_id)
    in_window = ledger["transferFulfilment"].where(F.col("settlementWindowId") == settlement_window_id)
    times = ledger["settlementWindow"].select("settlementWindowId").join(window_state_pairs(ledger), "settlementWindowId")
    pairs = named_pairs(ledger, within=in_window).where(
        (F.col("payerId") == participant_id) | (F.col("payeeId") == participant_id)
    )
    by = ["payerId", "payerName", "payeeId", "payeeName", "payerCurrency"]
    totals = pairs.groupBy(*by, "settlementWindowId").agg(
        F.count("transferId").alias("numTransactions"), F.sum("payerAmount").alias("total")
    )
    # Every OPEN and CLOSED row of the window counts; equal times share one row.
    merged = (
        totals.join(times, "settlementWindowId")
        .groupBy(*by, "windowOpen", "windowClose")
        .agg(F.sum("numTransactions").alias("numTransactions"), F.sum("total").alias("total"))
    )
    pays = F.col("payerId") == participant_id
    return merged.select(
        F.col("payerName").alias("fromName"),
        F.col("payerId").alias("fromId"),
        F.col("payeeName").alias("toName"),
        F.col("payeeId").alias("toId"),
        F.col("payerCurrency").alias("currency"),
        "numTransactions",
        plain_number(F.when(pays, F.col("total")).otherwise(0)).alias("sent"),
        plain_number(F.when(pays, 0).otherwise(F.col("total"))).alias("received"),
        plain_number(F.when(pays, -F.col("total")).otherwise(F.col("total"))).alias("net"),
        F.col("windowOpen").alias("settlementWindowOpen"),
        F.col("windowClose").alias("settlementWindowClose"),
    )


def dfsp_transactions_legacy(ledger: Tables, fsp_id: str, start: str, end: str) -> DataFrame:
    """The earlier participant report: ledger names and amounts, no rate, not distinct.

    Rows repeat if the quoted receiver's kind of party has several entries in ``party``.
    """
    ledger = of_quotes_between(ledger, parsed_report_time(start), parsed_report_time(end))
    settlements = settlement_details(ledger)
    states = reported_transfer_state(ledger).select(
        "transferId", F.col("enumeration").alias("status"), F.col("createdDate").alias("changedAt")
    )
    rows = (
        quoted_transfers(ledger, parsed_report_time(start), parsed_report_time(end))
        .where((F.col("payerName") == fsp_id) | (F.col("payeeName") == fsp_id))
        .join(settlements, "transferId", "left")
        .join(states, "transferId", "left")
        .join(exchange_as_first_leg(ledger), "transferId", "left")
        .join(exchange_as_second_leg(ledger), "transferId", "left")
    )
    rows = repeated_as_matched(rows, "receiverPartyType", ledger["party"], "partyId")
    return rows.select(
        "quoteId",
        F.col("payerName").alias("senderDFSPId"),
        F.col("payerName").alias("senderDFSPName"),
        F.col("payeeName").alias("receiverDFSPId"),
        F.col("payeeName").alias("receiverDFSPName"),
        F.col("transferId").alias("currentHubTransferID"),
        or_null_word(F.coalesce("legAOfA", "legAOfB")).alias("parentTransferID"),
        or_null_word(F.coalesce("legBOfA", "legAOfB")).alias("reciprocalHubTransferID"),
        "transactionType",
        "natureOfTxnType",
        iso_millis(F.col("quotedAt")).alias("requestDate"),
        iso_millis(F.col("transferredAt")).alias("createdDate"),
        or_null_word(F.col("settlementDate")).alias("settlementDate"),
        F.col("payerCurrency").alias("senderCountryCurrencyCode"),
        F.col("payeeCurrency").alias("receiverCountryCurrencyCode"),
        F.col("senderIdentifier").alias("senderId"),
        F.col("receiverIdentifier").alias("receiverId"),
        plain_number(F.col("transferAmount")).alias("reconciliationAmount"),
        F.lit("RNND").alias("receiverNameStatus"),
        F.lit("null").alias("pricingOption"),
        F.lit("null").alias("receiverKYCLevelStatus"),
        "status",
        iso_millis(F.col("changedAt")).alias("modificationDate"),
        F.lit("null").alias("errorCode"),
        F.col("transferId").alias("senderDFSPTxnID"),
        F.col("transferId").alias("receiverDFSPTxnID"),
        or_null_word(F.col("settlementWindowId")).alias("settlementWindowId"),
        or_null_word(F.col("settlementState")).alias("settlementState"),
        or_null_word(F.col("settlementStateChangeDate")).alias("settlementStateChangeDate"),
    )
