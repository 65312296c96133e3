"""Tables laid out by period, and reading only the periods that a selection touches.

A laid-out ledger keeps all rows of a payment (both legs, their quotes, states and
fulfilments) under one ``period``, that of the payment's first quote, and its quotes
under ``quotedIn``, the period in which each was made. Both are dates, the first
day of the period. Fulfilments lie by period and then by ``inWindow``, a copy of their
settlement window.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clearbook.sources.schemas import LEDGER_COLUMNS

Tables = Mapping[str, DataFrame]


def period_of(ts: Column, unit: str) -> Column:
    """First day of the ``year``, ``month`` or ``day`` of a time."""
    day = F.to_date(ts)
    return day if unit == "day" else F.trunc(day, unit)


def without_layout(table: DataFrame, name: str) -> DataFrame:
    """A ledger table with its own columns alone, in their order."""
    if name not in LEDGER_COLUMNS:
        return table.drop("period")
    return table.select(*[c.split()[0] for c in LEDGER_COLUMNS[name].split(", ")])


class Within(Mapping[str, DataFrame]):
    """A ledger of which only some periods are read.

    Each laid-out table is joined with the few wanted periods, one row for each at
    most. The join adds nothing to the result, but lets Spark leave out all
    other folders once it knows the periods, when the query runs.
    """

    def __init__(self, ledger: Tables, periods: DataFrame, known: dict[str, DataFrame] | None = None):
        self._ledger, self._known = ledger, known or {}
        self._periods = F.broadcast(periods.select("period").distinct())

    def __getitem__(self, name: str) -> DataFrame:
        if name in self._known:
            return without_layout(self._known[name], name)
        table = self._ledger.stored(name)
        if "period" not in table.columns:
            return self._ledger[name]
        return without_layout(table.join(self._periods, "period", "left_semi"), name)

    def __iter__(self) -> Iterator[str]:
        return iter(self._ledger)

    def __len__(self) -> int:
        return len(self._ledger)


def _laid_out(ledger: Tables, name: str) -> DataFrame | None:
    """The table with its layout, if the ledger has one and isn't restricted already."""
    stored = getattr(ledger, "stored", None)
    table = stored(name) if stored is not None else None
    return table if table is not None and "period" in table.columns else None


def of_quotes_between(ledger: Tables, start: Column, end: Column) -> Tables:
    """The ledger for the quotes made in a time range: other periods are not read.

    A ledger without a layout, or already restricted, is returned as it is.
    """
    quotes = _laid_out(ledger, "quote")
    if quotes is None or "quotedIn" not in quotes.columns:
        return ledger
    first, last = (period_of(moment, ledger.unit) for moment in (start, end))
    quotes = quotes.where(F.col("quotedIn").between(first, last))
    selected = quotes.where(F.col("createdDate").between(start, end))
    return Within(ledger, selected, {"quote": quotes})


def of_window(ledger: Tables, settlement_window_id: int) -> Tables:
    """The ledger for the transfers fulfilled in one settlement window, early or late."""
    fulfilled = _laid_out(ledger, "transferFulfilment")
    if fulfilled is None or "inWindow" not in fulfilled.columns:
        return ledger
    fulfilled = fulfilled.where(F.col("inWindow") == settlement_window_id)
    return Within(ledger, fulfilled, {"transferFulfilment": fulfilled})
