from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from clearbook.functions import text
from clearbook.functions.fx import decoded_rate, rounding_difference


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize(
    "amount, shown",
    [("0.0000", "0"), ("100.0000", "100"), ("0.5000", "0.5"), ("-12.3400", "-12.34"), ("1000.0001", "1000.0001")],
)
def test_numbers_lose_trailing_zeros(spark, amount, shown):
    assert value(spark, text.plain_number(F.lit(Decimal(amount)))) == shown


def test_whole_numbers_keep_their_zeros(spark):
    assert value(spark, text.plain_number(F.lit(100))) == "100"


def test_missing_values_by_kind(spark):
    nothing = F.lit(None).cast("int")
    assert value(spark, text.or_null_word(nothing)) == "null"
    assert value(spark, text.or_empty(nothing)) == ""
    assert value(spark, text.plain_number(nothing)) is None
    assert value(spark, text.iso_millis(F.lit(None).cast("timestamp_ntz"))) is None


def test_iso_text_is_cut_to_milliseconds(spark):
    moment = F.lit(datetime(2020, 1, 2, 3, 4, 5, 678999)).cast("timestamp_ntz")
    assert value(spark, text.iso_millis(moment)) == "2020-01-02T03:04:05.678Z"
    assert value(spark, text.iso_millis(F.lit("2020-01-02 03:04:05").cast("timestamp_ntz"))) == "2020-01-02T03:04:05.000Z"


def test_iso_text_does_not_depend_on_the_time_zone(spark):
    skipped = F.lit("2020-03-08 02:30:00.5").cast("timestamp_ntz")
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        assert value(spark, text.iso_millis(skipped)) == "2020-03-08T02:30:00.500Z"
        assert value(spark, text.parsed_report_time("2020-03-08T02:30:00")) == datetime(2020, 3, 8, 2, 30)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


@pytest.mark.parametrize("number, shown", [(10.0, "10"), (1e8, "100000000"), (1e-4, "0.0001"), (0.0, "0"), (5.375, "5.375")])
def test_doubles_are_plain_text(spark, number, shown):
    assert value(spark, text.float_text(F.lit(number))) == shown


def test_time_parameters(spark):
    assert value(spark, text.parsed_report_time("2020-01-02T03:04:05")) == datetime(2020, 1, 2, 3, 4, 5)
    assert value(spark, text.parsed_report_time("yesterday")) is None
    assert value(spark, text.parsed_report_time("2020-13-02T03:04:05")) is None
    assert value(spark, text.report_time("2020-01-02T03:04:05")) == datetime(2020, 1, 2, 3, 4, 5)
    assert value(spark, text.report_time("2020-01-02 03:04:05")) == datetime(2020, 1, 2, 3, 4, 5)
    assert value(spark, text.report_time(datetime(2020, 1, 2, 3, 4, 5))) == datetime(2020, 1, 2, 3, 4, 5)
    assert value(spark, text.report_time("yesterday")) is None


@pytest.mark.parametrize(
    "given, read",
    [
        ("2020-01-02", datetime(2020, 1, 2)),
        ("2020-01-02T", datetime(2020, 1, 2)),
        ("2020-1-2T3", datetime(2020, 1, 2, 3)),
        ("2020-01-02T03:04:05Z", datetime(2020, 1, 2, 3, 4, 5)),
        ("2020-01-02T03:04:05.678Z", datetime(2020, 1, 2, 3, 4, 5)),
        ("2020-01", None),
        ("2020-01-02 03:04:05", None),
        ("2020-01-02T25:00:00", None),
        ("2020-02-30", None),
        ("", None),
    ],
)
def test_short_and_long_time_parameters(spark, given, read):
    assert value(spark, text.parsed_report_time(given)) == read


def test_rate_and_rounding(spark):
    rate = decoded_rate(F.lit(1250), F.lit(3))
    assert value(spark, rate) == 1.25
    assert value(spark, rounding_difference(F.lit(Decimal("100.0000")), rate, F.lit(Decimal("120.0000")))) == 5.0
    assert value(spark, rounding_difference(F.lit(Decimal("100.0000")), rate, F.lit(None).cast("decimal(18,4)"))) is None
