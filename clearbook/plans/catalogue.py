"""Reports by name, with the parameters each one takes."""

from __future__ import annotations

import inspect
from collections.abc import Callable, Mapping
from typing import Any

from pyspark.sql import DataFrame

from clearbook.plans import reports

Tables = Mapping[str, DataFrame]

# Names the reports are requested by.
REPORTS: dict[str, Callable[..., DataFrame]] = {
    "311_dfspDailyTxnReport": reports.daily_dfsp_transactions,
    "312_hubDailyTxnReport": reports.daily_hub_transactions,
    "315_reconciliationAmountReport": reports.reconciliation_amounts,
    "settlementWindowReport": reports.settlement_window_summary,
    "transactionReconciliationReport": reports.transaction_reconciliation,
    "312_hubDailyTxnReportAnonymous": reports.daily_hub_transactions_anonymous,
    "311_dfspDailyTxnReportLegacy": reports.dfsp_transactions_legacy,
    "312_hubDailyTxnReportLegacy": reports.hub_transactions_legacy,
}


def run_report(name: str, ledger: Tables, **parameters: Any) -> DataFrame:
    """A report by name; a missing or unknown parameter is an error, an optional one may be left out."""
    report = REPORTS[name]
    try:
        bound = inspect.signature(report).bind(ledger, **parameters)
    except TypeError as problem:
        raise ValueError(f"{name}: {problem}") from None
    return report(*bound.args, **bound.kwargs)
