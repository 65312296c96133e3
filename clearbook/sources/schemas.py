"""Columns of the ledger tables.

Fixed values: table and column names are those of the ledger the reports run on.
"""

from __future__ import annotations

from pyspark.sql.types import StructType

_AMOUNT = "DECIMAL(18,4)"

LEDGER_COLUMNS: dict[str, str] = {
    "participant": "participantId INT, name STRING",
    "participantCurrency": "participantCurrencyId INT, participantId INT, currencyId STRING",
    "transferParticipantRoleType": "transferParticipantRoleTypeId INT, name STRING",
    "partyType": "partyTypeId INT, name STRING",
    "party": "partyId INT, firstName STRING, lastName STRING",
    "transactionScenario": "transactionScenarioId INT, name STRING",
    "transferState": "transferStateId STRING, enumeration STRING",
    "transfer": f"transferId STRING, amount {_AMOUNT}, currencyId STRING, createdDate TIMESTAMP_NTZ",
    "transferParticipant": "transferParticipantId BIGINT, transferId STRING, participantCurrencyId INT, "
    f"transferParticipantRoleTypeId INT, amount {_AMOUNT}",
    "quote": "quoteId STRING, transactionRequestId STRING, transactionScenarioId INT, createdDate TIMESTAMP_NTZ",
    "transactionReference": "quoteId STRING, transactionReferenceId STRING",
    "quoteParty": "quoteId STRING, partyTypeId INT, transferParticipantRoleTypeId INT, participantId INT, "
    f"fspId STRING, partyIdentifierValue STRING, currencyId STRING, amount {_AMOUNT}",
    "quoteResponse": f"quoteId STRING, transferAmountCurrencyId STRING, transferAmount {_AMOUNT}, "
    f"payeeReceiveAmountCurrencyId STRING, payeeReceiveAmount {_AMOUNT}",
    "transferError": "transferId STRING, errorCode STRING",
    "transferStateChange": "transferStateChangeId BIGINT, transferId STRING, transferStateId STRING, "
    "createdDate TIMESTAMP_NTZ",
    "transferFulfilment": "transferId STRING, settlementWindowId BIGINT",
    "settlementWindow": "settlementWindowId BIGINT, currentStateChangeId BIGINT",
    "settlementWindowStateChange": "settlementWindowStateChangeId BIGINT, settlementWindowId BIGINT, "
    "settlementWindowStateId STRING, createdDate TIMESTAMP_NTZ",
    "settlementSettlementWindow": "settlementId BIGINT, settlementWindowId BIGINT",
    "settlement": "settlementId BIGINT, currentStateChangeId BIGINT",
    "settlementStateChange": "settlementStateChangeId BIGINT, settlementId BIGINT, settlementStateId STRING, "
    "createdDate TIMESTAMP_NTZ",
    "fxTransaction": "transferAId STRING, transferBId STRING, fxQuoteAId STRING, fxQuoteBId STRING, "
    "exchangeRateId INT",
    "fxQuote": "fxQuoteId STRING, sourceFSP STRING",
    "exchange_channel_rates": "id INT, rate INT, decimals INT",
    "citiExchangeRate": "exchangeRateId INT, rateSetId INT",
}

QUOTE_FACT_COLUMNS = "quoteId STRING, headers STRING, payload STRING, payer STRING, payee STRING"


def ledger_schema(table: str) -> StructType:
    return StructType.fromDDL(LEDGER_COLUMNS[table])
