"""Transfers with their two participants, their quote and their exchange legs.

Joins are left-deep over plain tables on purpose: Catalyst then knows the real
size of each lookup table and broadcasts it only if it is small enough, and
joins order-sized tables on the id they are bucketed on.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clearbook.functions.text import iso_millis, or_null_word
from clearbook.operators.joins import left_join_if_present, lookup
from clearbook.sources.periods import of_quotes_between

Tables = Mapping[str, DataFrame]

# Role, party and scenario names, and the codes they turn into.
PAYER_ROLE = "PAYER_DFSP"
PAYER_PARTY, PAYEE_PARTY = "PAYER", "PAYEE"


def counterparty_pairs(ledger: Tables, within: DataFrame | None = None) -> DataFrame:
    """Each payer line of a transfer with every other line of the same transfer.

    The sides pair up on the transfer, which has a handful of lines; a transfer
    with three participants gives two pairs. ``within`` holds the transfers of
    interest; its columns are kept, and both sides are looked up for them only.
    """
    lines = ledger["transferParticipant"]
    roles = ledger["transferParticipantRoleType"].where(F.col("name") == PAYER_ROLE)
    payer_role = lookup(roles.select("transferParticipantRoleTypeId"))
    payer = lines.join(payer_role, "transferParticipantRoleTypeId").select(
        "transferId",
        F.col("transferParticipantId").alias("payerLineId"),
        F.col("participantCurrencyId").alias("payerAccountId"),
        F.col("amount").alias("payerAmount"),
    )
    payee = lines.select(
        "transferId",
        F.col("transferParticipantId").alias("payeeLineId"),
        F.col("participantCurrencyId").alias("payeeAccountId"),
    )
    payers = payer if within is None else within.join(payer, "transferId")
    return payers.join(payee, "transferId").where(F.col("payerLineId") != F.col("payeeLineId"))


def with_account_owner(df: DataFrame, ledger: Tables, side: str) -> DataFrame:
    """Add ``<side>Id``, ``<side>Name`` and ``<side>Currency`` for ``<side>AccountId``."""
    accounts = ledger["participantCurrency"].select(
        F.col("participantCurrencyId").alias(f"{side}AccountId"),
        F.col("participantId").alias(f"{side}Id"),
        F.col("currencyId").alias(f"{side}Currency"),
    )
    owners = ledger["participant"].select(
        F.col("participantId").alias(f"{side}Id"), F.col("name").alias(f"{side}Name")
    )
    return df.join(lookup(accounts), f"{side}AccountId").join(lookup(owners), f"{side}Id")


def named_pairs(ledger: Tables, within: DataFrame | None = None) -> DataFrame:
    """Counterparty pairs with the id, name and currency of both participants."""
    pairs = counterparty_pairs(ledger, within)
    return with_account_owner(with_account_owner(pairs, ledger, "payer"), ledger, "payee")


def transaction_type(scenario: Column) -> Column:
    """``P2P`` for transfers; every other scenario has no type."""
    return F.when(scenario == "TRANSFER", "P2P")


def nature_of_transaction(request_id: Column) -> Column:
    return F.when(request_id.isNull(), "Original").otherwise("Reversal")


def quotes_between(ledger: Tables, start: Column | None, end: Column | None) -> DataFrame:
    """Quotes made in the inclusive time range, with their transaction type."""
    quote = ledger["quote"]
    if start is not None:
        quote = quote.where(F.col("createdDate").between(start, end))
    scenario = ledger["transactionScenario"].select("transactionScenarioId", F.col("name").alias("scenario"))
    return quote.join(lookup(scenario), "transactionScenarioId").select(
        "quoteId",
        F.col("createdDate").alias("quotedAt"),
        transaction_type(F.col("scenario")).alias("transactionType"),
        nature_of_transaction(F.col("transactionRequestId")).alias("natureOfTxnType"),
    )


def quote_side(ledger: Tables, party: str, side: str) -> DataFrame:
    """The quote's parties of one kind: ``<side>Fsp``, ``<side>Identifier`` and ``<side>PartyType``."""
    kind = ledger["partyType"].where(F.col("name") == party).select("partyTypeId")
    return (
        ledger["quoteParty"]
        .join(lookup(kind), "partyTypeId")
        .select(
            "quoteId",
            F.col("fspId").alias(f"{side}Fsp"),
            F.col("partyIdentifierValue").alias(f"{side}Identifier"),
            F.col("partyTypeId").alias(f"{side}PartyType"),
        )
    )


def quoted_transfers(ledger: Tables, start: Column | None, end: Column | None) -> DataFrame:
    """Quotes in the range with their parties, transfer and both participants.

    Starts from the quotes because the time range is the most selective
    predicate: what it leaves is all that moves from quote ids to transfer ids.
    """
    transfers = ledger["transfer"].select(
        "transferId", F.col("createdDate").alias("transferredAt"), F.col("amount").alias("transferAmount")
    )
    quoted = (
        quotes_between(ledger, start, end)
        .join(quote_side(ledger, PAYER_PARTY, "sender"), "quoteId")
        .join(quote_side(ledger, PAYEE_PARTY, "receiver"), "quoteId")
        .join(ledger["transactionReference"].withColumnRenamed("transactionReferenceId", "transferId"), "quoteId")
    )
    return named_pairs(ledger, within=quoted.join(transfers, "transferId"))


def exchange_as_first_leg(ledger: Tables) -> DataFrame:
    """Exchange payments by the transfer that is their leg A; columns end in ``OfA``."""
    return ledger["fxTransaction"].select(
        F.col("transferAId").alias("transferId"),
        F.col("transferAId").alias("legAOfA"),
        F.col("transferBId").alias("legBOfA"),
        F.col("fxQuoteAId").alias("quoteAOfA"),
        F.col("fxQuoteBId").alias("quoteBOfA"),
        F.col("exchangeRateId").alias("rateOfA"),
    )


def exchange_as_second_leg(ledger: Tables) -> DataFrame:
    """Exchange payments by the transfer that is their leg B; columns end in ``OfB``."""
    return ledger["fxTransaction"].select(
        F.col("transferBId").alias("transferId"),
        F.col("transferAId").alias("legAOfB"),
        F.col("transferBId").alias("legBOfB"),
        F.col("fxQuoteAId").alias("quoteAOfB"),
        F.col("exchangeRateId").alias("rateOfB"),
    )


def _shared_columns() -> list[Column]:
    return [
        F.col("quoteId"),
        F.col("senderFsp").alias("senderDFSPName"),
        F.col("receiverFsp").alias("receiverDFSPName"),
        F.col("transferId").alias("currentHubTransferID"),
        F.col("transactionType"),
        F.col("natureOfTxnType"),
        iso_millis(F.col("quotedAt")).alias("requestDate"),
        iso_millis(F.col("transferredAt")).alias("createdDate"),
        F.col("senderIdentifier").alias("senderId"),
        F.col("receiverIdentifier").alias("receiverId"),
        # A name is compared with NULL, which never holds, so this is constant.
        F.lit("RNND").alias("receiverNameStatus"),
        F.lit("null").alias("pricingOption"),
        F.lit("null").alias("receiverKYCLevelStatus"),
        or_null_word(F.col("errorCode")).alias("errorCode"),
        F.col("transferId").alias("senderDFSPTxnID"),
        F.col("transferId").alias("receiverDFSPTxnID"),
    ]


def dfsp_transfer_core(ledger: Tables, start: Column, end: Column, fsp_id: str) -> DataFrame:
    """Transfers one participant pays or receives, seen as either exchange leg."""
    ledger = of_quotes_between(ledger, start, end)
    leg_a = F.coalesce("legAOfA", "legAOfB")
    return (
        quoted_transfers(ledger, start, end)
        .where((F.col("payerName") == fsp_id) | (F.col("payeeName") == fsp_id))
        .join(ledger["transferError"], "transferId", "left")
        .join(exchange_as_first_leg(ledger), "transferId", "left")
        .join(exchange_as_second_leg(ledger), "transferId", "left")
        .select(
            *_shared_columns(),
            or_null_word(leg_a).alias("parentTransferID"),
            # Seen from leg B, the reciprocal transfer is leg A.
            or_null_word(F.coalesce("legBOfA", "legAOfB")).alias("reciprocalHubTransferID"),
            F.coalesce("rateOfA", "rateOfB").alias("exchangeRateId"),
            F.col("quoteAOfA").alias("legAQuoteAId"),
            F.col("quoteAOfB").alias("legBQuoteAId"),
            leg_a.alias("legATransferId"),
            F.coalesce("legBOfA", "legBOfB").alias("legBTransferId"),
        )
    )


def hub_transfer_core(ledger: Tables, start: Column, end: Column) -> DataFrame:
    """Transfers whose direct payee is not the quoted receiver: exchange legs A.

    A missing receiver fails the comparison and drops the row.
    """
    ledger = of_quotes_between(ledger, start, end)
    second_quote = ledger["fxQuote"].select(F.col("fxQuoteId").alias("secondQuoteKey"), "sourceFSP")
    return (
        quoted_transfers(ledger, start, end)
        .where(F.col("payeeName") != F.col("receiverFsp"))
        .join(ledger["transferError"], "transferId", "left")
        .join(exchange_as_first_leg(ledger), "transferId", "left")
        .transform(lambda df: left_join_if_present(df, second_quote, "quoteBOfA", "secondQuoteKey"))
        .select(
            *_shared_columns(),
            or_null_word(F.col("payeeName")).alias("leg1vDFSP"),
            or_null_word(F.col("sourceFSP")).alias("leg2vDFSP"),
            or_null_word(F.col("legAOfA")).alias("parentTransferID"),
            or_null_word(F.col("legBOfA")).alias("reciprocalHubTransferID"),
            F.col("rateOfA").alias("exchangeRateId"),
            F.col("quoteAOfA").alias("legAQuoteAId"),
            F.col("quoteBOfA").alias("legBQuoteAId"),
            F.col("legAOfA").alias("legATransferId"),
            F.col("legBOfA").alias("legBTransferId"),
        )
    )
