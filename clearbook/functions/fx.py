"""Foreign-exchange arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def decoded_rate(rate: Column, decimals: Column) -> Column:
    """A fixed-point channel rate as a double: 1250 with 3 decimals is 1.25."""
    return rate / F.pow(F.lit(10), decimals)


def rounding_difference(sent: Column, rate: Column, received: Column) -> Column:
    """What the conversion at ``rate`` would have paid beyond what was received."""
    return sent * rate - received
