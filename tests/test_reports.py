"""The reports on the hand-made ledger."""

from datetime import datetime
from decimal import Decimal

import pytest

from clearbook.operators import settlement, states, transfers
from clearbook.plans import reports
from clearbook.plans.catalogue import REPORTS, run_report
from tests.micro import CLOSED, DAY, OPENED, REOPENED, ROWS, micro_ledger

FROM, TO = "2020-01-01T00:00:00", "2020-01-02T00:00:00"


@pytest.fixture(scope="module")
def micro(spark, tmp_path_factory):
    return micro_ledger(spark, tmp_path_factory.mktemp("micro"))


def by(rows, column):
    return {r[column]: r for r in rows}


@pytest.fixture(scope="module")
def dfsp(micro):
    return reports.daily_dfsp_transactions(micro, FROM, TO, "bank1").collect()


def test_dfsp_report_columns_and_rows(dfsp):
    assert len(dfsp[0]) == 32
    # TB is paid by the virtual participant to bank3, so bank1 does not see it.
    # Two rate sets double TA; the second pair of T3 differs in nothing shown.
    assert sorted(r["currentTransferID"] for r in dfsp) == ["T1", "T3", "T4", "T5", "TA", "TA"]
    assert {r["fxRateSetID"] for r in dfsp if r["currentTransferID"] == "TA"} == {"70", "71"}


def test_dfsp_report_domestic_transfer(dfsp):
    row = by(dfsp, "currentTransferID")["T1"]
    assert (row["parentTransferID"], row["reciprocalTransferID"]) == ("null", "null")
    assert (row["natureOfTxnType"], row["transactionType"]) == ("Reversal", "P2P")
    assert (row["senderAmount"], row["receiverAmount"], row["receiverCurrency"]) == ("100", "100", "EUR")
    assert (row["forexRate"], row["rounding"], row["fxRateSetID"]) == ("null", "null", "null")
    # The state falls back to the transfer itself, the settlement does not.
    assert (row["senderTxStatus"], row["receiverTxStatus"]) == ("COMMITTED", "COMMITTED")
    assert (row["senderSettlementWindowId"], row["settlementState"], row["settlementDate"]) == ("null",) * 3
    assert row["requestDate"] == "2020-01-01T10:00:00.123Z"
    assert row["modificationDate"] == "2020-01-01T10:00:05.999Z"


def test_dfsp_report_exchange_payment(dfsp):
    row = by(dfsp, "currentTransferID")["TA"]
    assert (row["parentTransferID"], row["reciprocalTransferID"]) == ("TA", "TB")
    assert (row["senderCurrency"], row["receiverCurrency"]) == ("EUR", "MAD")
    assert (row["forexRate"], row["rounding"]) == ("2.5", "0.25")
    assert (row["senderTxStatus"], row["receiverTxStatus"]) == ("RESERVED", "COMMITTED")
    assert (row["senderSettlementWindowId"], row["receiverSettlementWindowId"]) == ("10", "11")
    assert (row["settlementState"], row["settlementDate"]) == ("SETTLED", "2020-02-01T00:00:00.000Z")


def test_dfsp_report_missing_values(dfsp):
    rows = by(dfsp, "currentTransferID")
    assert (rows["T4"]["errorCode"], rows["T5"]["errorCode"]) == ("null", "5001")
    # T5's latest state is not reported and it has no response.
    assert (rows["T5"]["senderTxStatus"], rows["T5"]["receiverTxStatus"]) == ("null", None)
    assert (rows["T5"]["modificationDate"], rows["T5"]["senderAmount"]) == (None, None)
    assert rows["T5"]["transactionType"] is None
    assert rows["T3"]["senderAmount"] == "0"


def test_second_leg_names_the_first_as_reciprocal(micro):
    rows = reports.daily_dfsp_transactions(micro, FROM, TO, "bank3").collect()
    assert {(r["currentTransferID"], r["parentTransferID"], r["reciprocalTransferID"]) for r in rows} == {("TB", "TA", "TA")}


def test_dfsp_report_is_sorted_and_range_is_inclusive(micro):
    rows = reports.daily_dfsp_transactions(micro, DAY, DAY, "bank1").collect()
    assert len(rows) == 6
    assert [r["createdDate"] for r in rows] == sorted(r["createdDate"] for r in rows)


def test_hub_report_shows_first_legs_only(micro):
    rows = reports.daily_hub_transactions(micro, FROM, TO).collect()
    # T3's hub line makes a pair whose payee is not the quoted receiver; T4's
    # unknown receiver fails the comparison.
    assert sorted({r["senderTransferID"] for r in rows}) == ["T3", "TA"]
    row = by(rows, "senderTransferID")["TA"]
    assert len(row) == 34
    assert (row["leg1vDFSP"], row["leg2vDFSP"], row["receiverTransferID"]) == ("DFSPEUR", "DFSPMAD", "TB")
    other = by(rows, "senderTransferID")["T3"]
    assert (other["leg2vDFSP"], other["parentTransferID"], other["receiverCurrency"]) == ("null", "null", None)
    assert (other["senderTxStatus"], other["receiverTxStatus"]) == ("null", "null")


def test_anonymous_hub_report_drops_two_columns(micro):
    full = reports.daily_hub_transactions(micro, FROM, TO)
    anonymous = reports.daily_hub_transactions_anonymous(micro, FROM, TO)
    assert anonymous.columns == [c for c in full.columns if c not in ("senderId", "receiverId")]
    assert set(map(tuple, anonymous.collect())) == {
        tuple(v for c, v in r.asDict().items() if c not in ("senderId", "receiverId")) for r in full.collect()
    }


def test_settlement_window_report(micro):
    rows = {(r["fspId"], r["settlementWindowId"], r["windowOpen"]): r for r in reports.settlement_window_summary(micro).collect()}
    # Window 10 was opened twice, so each of its rows appears twice.
    assert {k[2] for k in rows if k[1] == 10} == {OPENED, REOPENED}
    row = rows["bank1", 10, OPENED]
    assert (row["state"], row["numTransactions"], row["netPosition"]) == ("CLOSED", 3, Decimal("100.5000"))
    assert row["windowClose"] == CLOSED
    # T3's hub line has no quote party: an unnamed group without amounts.
    assert (rows[None, 10, OPENED]["numTransactions"], rows[None, 10, OPENED]["netPosition"]) == (0, None)
    still_open = rows["bank3", 11, OPENED]
    assert (still_open["state"], still_open["windowClose"]) == ("OPEN", None)
    # Window 12 has no fulfilled transfer and vanishes.
    assert {k[1] for k in rows} == {10, 11}


def test_reconciliation_amounts(micro):
    rows = {(r["fromName"], r["toName"], r["settlementWindowOpen"]): r for r in reports.reconciliation_amounts(micro, 1, 10).collect()}
    assert len(rows) == 4
    row = rows["bank1", "bank2", OPENED]
    assert (row["numTransactions"], row["sent"], row["received"], row["net"]) == (2, "100", "0", "-100")
    assert rows["bank1", "DFSPEUR", REOPENED]["numTransactions"] == 2
    assert [r["net"] for r in reports.reconciliation_amounts(micro, 2, 10).collect()] == ["100", "100"]
    assert reports.reconciliation_amounts(micro, 1, 11).count() == 0


def test_equal_opening_times_share_a_row(spark, tmp_path):
    changes = [(i, w, s, OPENED if s == "OPEN" else t) for i, w, s, t in ROWS["settlementWindowStateChange"]]
    rows = reports.reconciliation_amounts(micro_ledger(spark, tmp_path, settlementWindowStateChange=changes), 2, 10).collect()
    assert [(r["numTransactions"], r["net"]) for r in rows] == [(4, "200")]


def test_transaction_reconciliation(micro):
    rows = by(reports.transaction_reconciliation(micro, "bank1", FROM, TO).collect(), "hubTxnID")
    # T5 has no response, so it is left out; rows are distinct.
    assert sorted(rows) == ["T1", "T3", "T4", "TA"]
    assert (rows["T1"]["status"], rows["T1"]["settlementWindowId"], rows["T1"]["settlementState"]) == ("COMMITTED", "10", "SETTLED")
    assert rows["T1"]["settlementDate"] == datetime(2020, 2, 1)
    assert rows["T1"]["reconciliationAmount"] == Decimal("100.0000")
    assert (rows["T4"]["settlementWindowId"], rows["T4"]["settlementState"], rows["T4"]["status"]) == ("", None, None)
    assert rows["T4"]["receiverDFSPId"] is None


def test_optional_window_and_unreadable_time(micro):
    in_window = reports.transaction_reconciliation(micro, "bank1", FROM, TO, 10)
    assert {r["hubTxnID"] for r in in_window.collect()} == {"T1", "TA", "T3"}
    assert reports.transaction_reconciliation(micro, "bank1", "yesterday", TO).count() == 0


def test_legacy_reports(micro):
    rows = reports.dfsp_transactions_legacy(micro, "bank1", FROM, TO).collect()
    assert len(rows[0]) == 29
    # Not distinct: both pairs of T3 are listed.
    assert sorted(r["currentHubTransferID"] for r in rows) == ["T1", "T3", "T3", "T4", "T5", "TA"]
    assert by(rows, "currentHubTransferID")["T1"]["settlementWindowId"] == "10"
    everyone = reports.hub_transactions_legacy(micro, FROM, TO)
    one = reports.transaction_reconciliation(micro, "bank2", FROM, TO)
    assert everyone.columns == one.columns
    assert one.exceptAll(everyone).count() == 0 and one.count() > 0


def test_three_participants_make_two_pairs(micro):
    pairs = transfers.counterparty_pairs(micro).where("transferId = 'T3'").collect()
    assert sorted(p["payeeLineId"] for p in pairs) == [32, 39]


def test_latest_state_is_by_id_not_by_time(micro):
    latest = {r["transferId"]: r["transferStateId"] for r in states.latest_transfer_state(micro).collect()}
    assert latest == {"T1": "COMMITTED", "TA": "RESERVED", "TB": "COMMITTED", "T5": "RECEIVED_PREPARE"}
    assert "T5" not in {r["transferId"] for r in states.reported_transfer_state(micro).collect()}


def test_net_positions_cancel_out(micro):
    rows = settlement.net_positions(micro).collect()
    for window in {r["settlementWindowId"] for r in rows}:
        assert sum(r["netPosition"] for r in rows if r["settlementWindowId"] == window) == 0
    row = next(r for r in rows if r["name"] == "bank1")
    assert (row["debit"], row["credit"], row["netPosition"]) == (Decimal("100.5"), Decimal("0"), Decimal("-100.5"))


def test_catalogue_checks_parameters(micro):
    assert set(REPORTS) >= {"311_dfspDailyTxnReport", "312_hubDailyTxnReport", "315_reconciliationAmountReport"}
    assert run_report("315_reconciliationAmountReport", micro, participant_id=2, settlement_window_id=10).count() == 2
    assert run_report("settlementWindowReport", micro).count() > 0
    with pytest.raises(ValueError, match="missing a required argument"):
        run_report("315_reconciliationAmountReport", micro, participant_id=2)
