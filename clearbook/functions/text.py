"""How the reports render values as text.

The reports know three kinds of missing value, and each column keeps its own:
SQL NULL, the word ``null`` and the empty string.
"""

from __future__ import annotations

import re
from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

# The missing-value marker and the form of a time parameter.
NULL_WORD = "null"
_TWO = "[0-9]{1,2}"
TIME_FORM = ["[0-9]{4}", "-", _TWO, "-", _TWO, "T", _TWO, ":", _TWO, ":", _TWO]


def or_null_word(value: Column) -> Column:
    """Text of ``value``, or the word ``null`` where it is missing."""
    return F.coalesce(value.cast("string"), F.lit(NULL_WORD))


def or_empty(value: Column) -> Column:
    """Text of ``value``, or the empty string where it is missing."""
    return F.coalesce(value.cast("string"), F.lit(""))


def iso_millis(ts: Column) -> Column:
    """ISO-8601 text cut (not rounded) to milliseconds; NULL stays NULL.

    Made from the text of a time without zone: formatting would go through the
    session's time zone and move times that daylight saving skips.
    """
    text = ts.cast("timestamp_ntz").cast("string")
    millis = F.rpad(F.substring(text, 21, 3), 3, "0")
    return F.concat(F.substring(text, 1, 10), F.lit("T"), F.substring(text, 12, 8), F.lit("."), millis, F.lit("Z"))


def plain_number(value: Column) -> Column:
    """Decimal text without trailing zeros: 100.0000 -> 100, 0.5000 -> 0.5.

    Text without a point is left alone, so 100 with scale 0 does not become 1.
    """
    text = value.cast("string")
    return F.when(text.contains("."), F.rtrim(F.rtrim(text, F.lit("0")), F.lit("."))).otherwise(text)


def float_text(value: Column) -> Column:
    """A double as plain text with up to eight decimals, never as 1.0E-4."""
    return plain_number(value.cast("decimal(38,8)"))


def when_settled(state: Column, value: Column) -> Column:
    """``value`` for settled rows, otherwise NULL."""
    return F.when(state == "SETTLED", value)


def _read_time(text: str) -> datetime | None:
    """A time read part by part until the text or the form ends.

    Parts the text does not reach are zero and text after the seconds is
    ignored; a part that does not fit, or no such day or time, gives None.
    """
    numbers = []
    for part in TIME_FORM:
        text = text.lstrip()
        if not text:
            break
        found = re.match(part, text)
        if found is None:
            return None
        if found[0].isdigit():
            numbers.append(int(found[0]))
        text = text[found.end() :]
    try:
        return datetime(*numbers, *[0] * (6 - len(numbers)))
    except ValueError:
        return None


def _time_literal(moment: datetime | None) -> Column:
    """As text without zone, so that the session's zone has no part in it."""
    return F.lit(None if moment is None else moment.isoformat()).cast("timestamp_ntz")


def report_time(value: str | datetime) -> Column:
    """A DATETIME parameter of a report: a time, or text with ``T`` or a space between day and time."""
    return _time_literal(value) if isinstance(value, datetime) else parsed_report_time(value.strip().replace(" ", "T", 1))


def parsed_report_time(text: str) -> Column:
    """A text parameter; unreadable text is NULL, so no row matches."""
    return _time_literal(_read_time(text))
