"""A hand-made ledger of a few rows that holds the awkward cases.

T1  domestic transfer, bank1 -> bank2, committed and fulfilled in window 10
TA  exchange leg A, bank1 -> virtual; TB is its leg B, virtual -> bank3
T3  three participants, so two pairs
T4  quoted receiver unknown (NULL), error without a code
T5  latest state is not a reported one
"""

from datetime import datetime
from decimal import Decimal

from clearbook.sources.ledger import from_parquet
from clearbook.sources.schemas import LEDGER_COLUMNS, ledger_schema

D = Decimal
DAY = datetime(2020, 1, 1, 10, 0, 0, 123456)
LATER = datetime(2020, 1, 1, 10, 0, 5, 999999)
OPENED, REOPENED, CLOSED = datetime(2020, 1, 1), datetime(2020, 1, 2), datetime(2020, 1, 3)

_TRANSFERS = ["T1", "TA", "TB", "T3", "T4", "T5"]
_AMOUNTS = {"T1": "100.0000", "TA": "0.5000", "TB": "2.0000", "T3": "0.0000", "T4": "12.3400", "T5": "7.0000"}
# Payer and payee accounts of each transfer; account 1x belongs to participant x.
_ACCOUNTS = {"T1": (11, 12), "TA": (11, 19), "TB": (19, 13), "T3": (11, 12), "T4": (12, 11), "T5": (11, 12)}
_BANKS = {11: "bank1", 12: "bank2", 13: "bank3", 19: "DFSPEUR"}
# Quoted sender and receiver; both legs of an exchange quote the end parties.
_QUOTED = {t: tuple(_BANKS[a] for a in pair) for t, pair in _ACCOUNTS.items()}
_QUOTED.update(TA=("bank1", "bank3"), TB=("bank1", "bank3"), T4=("bank2", None))

ROWS: dict[str, list[tuple]] = {
    "participant": [(a - 10, name) for a, name in _BANKS.items()],
    "participantCurrency": [(11, 1, "EUR"), (12, 2, "EUR"), (13, 3, "MAD"), (19, 9, "EUR")],
    "transferParticipantRoleType": [(1, "PAYER_DFSP"), (2, "PAYEE_DFSP"), (3, "HUB")],
    "partyType": [(1, "PAYER"), (2, "PAYEE")],
    "party": [(1, "Ada", "Payer"), (2, "Ben", "Payee")],
    "transactionScenario": [(1, "TRANSFER"), (2, "PAYMENT")],
    "transferState": [("RECEIVED_PREPARE", "RECEIVED"), ("RESERVED", "RESERVED"), ("COMMITTED", "COMMITTED")],
    "transfer": [(t, D(_AMOUNTS[t]), "EUR", LATER) for t in _TRANSFERS],
    "transferParticipant": [
        line
        for n, t in enumerate(_TRANSFERS)
        for line in (
            (n * 10 + 1, t, _ACCOUNTS[t][0], 1, D(_AMOUNTS[t])),
            (n * 10 + 2, t, _ACCOUNTS[t][1], 2, -D(_AMOUNTS[t])),
        )
    ]
    + [(39, "T3", 19, 3, D("0.0000"))],
    "quote": [("Q" + t, "R" if t == "T1" else None, 2 if t == "T5" else 1, DAY) for t in _TRANSFERS],
    "transactionReference": [("Q" + t, t) for t in _TRANSFERS],
    "quoteParty": [
        party
        for t in _TRANSFERS
        for party in (
            ("Q" + t, 1, 1, _ACCOUNTS[t][0] - 10, _QUOTED[t][0], "payer-" + t, "EUR", D(_AMOUNTS[t])),
            ("Q" + t, 2, 2, _ACCOUNTS[t][1] - 10, _QUOTED[t][1], "payee-" + t, "EUR", -D(_AMOUNTS[t])),
        )
    ],
    "quoteResponse": [
        ("Q" + t, "EUR", D(_AMOUNTS[t]), "MAD" if t == "TA" else None, D("1.0000") if t == "TA" else None)
        for t in _TRANSFERS
        if t != "T5"
    ],
    "transferError": [("T4", None), ("T5", "5001")],
    "transferStateChange": [
        (1, "T1", "RECEIVED_PREPARE", DAY),
        (3, "T1", "COMMITTED", LATER),
        (2, "T1", "RESERVED", datetime(2021, 1, 1)),
        (4, "TA", "RESERVED", LATER),
        (5, "TB", "COMMITTED", LATER),
        (6, "T5", "RESERVED", DAY),
        (7, "T5", "RECEIVED_PREPARE", LATER),
    ],
    "transferFulfilment": [("T1", 10), ("TA", 10), ("TB", 11), ("T3", 10), ("T4", None)],
    "settlementWindow": [(10, 102), (11, 111), (12, 121)],
    "settlementWindowStateChange": [
        (100, 10, "OPEN", OPENED),
        (101, 10, "OPEN", REOPENED),
        (102, 10, "CLOSED", CLOSED),
        (111, 11, "OPEN", OPENED),
        (121, 12, "OPEN", OPENED),
    ],
    "settlementSettlementWindow": [(1, 10)],
    "settlement": [(1, 1001)],
    "settlementStateChange": [(1000, 1, "PENDING_SETTLEMENT", CLOSED), (1001, 1, "SETTLED", datetime(2020, 2, 1))],
    "fxTransaction": [("TA", "TB", "QTA", "QX", 7)],
    "fxQuote": [("QX", "DFSPMAD")],
    "exchange_channel_rates": [(7, 25, 1)],
    "citiExchangeRate": [(7, 70), (7, 71)],
}


def micro_ledger(spark, folder, **changed):
    """The ledger above as Parquet tables, with whole tables replaced by ``changed``."""
    rows = {**ROWS, **changed}
    for table in LEDGER_COLUMNS:
        frame = spark.createDataFrame(rows[table], ledger_schema(table))
        frame.coalesce(1).write.parquet(f"{folder}/{table}")
    return from_parquet(spark, str(folder))
