"""Foreign exchange: providers, registry, identifier checks, rate validity."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from clearbook.functions.fx import decoded_rate, rounding_difference
from clearbook.functions.text import float_text, or_null_word
from clearbook.operators.asof import numbered_times, with_last_mark
from clearbook.operators.joins import lookup
from clearbook.sources.sinks import staged
from clearbook.sources.reference_data import RATE_FREEZE_SECONDS, registry_list

Tables = Mapping[str, DataFrame]

PAIR = ["sourceCurrency", "targetCurrency"]
# Stands for the end of a rate that has none; no payment is that late.
NO_END = "290000-01-01 00:00:00"
# How many of the rates that start next are asked whether they replace a rate, among how many that start together.
NEXT_STARTS, STARTS_TOGETHER = 16, 4096

# Patterns of a virtual participant's name and of any identifier.
VIRTUAL_NAME = "^DFSP[A-Z]{3}$"
ANY_IDENTIFIER = "^.{1,32}$"


def with_fx_provider(df: DataFrame, providers: DataFrame, currency: str = "currencyId") -> DataFrame:
    """Add ``dfsp``, the virtual participant that exchanges the row's currency."""
    return df.join(lookup(providers.withColumnRenamed("currency", currency)), currency, "left")


def dfsp_registry(documents: DataFrame) -> DataFrame:
    """All participants of a registry with their currency's monetary zone."""
    listed = registry_list(documents, "dfsps").withColumn("isVirtual", F.lit(False))
    virtual = registry_list(documents, "vdfsps").withColumn("isVirtual", F.lit(True))
    zones = registry_list(documents, "monetaryZones").select(
        F.col("monetaryZoneId").alias("currencyId"), F.col("name").alias("zoneName")
    )
    known = registry_list(documents, "currencies").distinct()
    return (
        listed.unionByName(virtual)
        .join(lookup(known), "currencyId")
        .join(lookup(zones.distinct()), "currencyId", "left")
        .select("dfspId", "currencyId", "zoneName", "isVirtual")
    )


def identifier_checks(df: DataFrame, identifier: str) -> DataFrame:
    """Whether an identifier is well-formed and whether it names a virtual participant."""
    value = F.coalesce(F.col(identifier), F.lit(""))
    return df.withColumn("isValidId", value.rlike(ANY_IDENTIFIER)).withColumn(
        "isVirtualName", value.rlike(VIRTUAL_NAME)
    )


def exchange_payments(ledger: Tables) -> DataFrame:
    """Both legs of each exchange payment: currencies, amount and time of leg A."""
    first = ledger["transfer"].select(
        F.col("transferId").alias("transferAId"),
        F.col("currencyId").alias("sourceCurrency"),
        "amount",
        "createdDate",
    )
    second = ledger["transfer"].select(
        F.col("transferId").alias("transferBId"), F.col("currencyId").alias("targetCurrency")
    )
    return ledger["fxTransaction"].select("transferAId", "transferBId").join(first, "transferAId").join(
        second, "transferBId"
    )


def _timeline(rates: DataFrame, freeze_seconds: int) -> tuple[DataFrame, DataFrame]:
    """Rates from their first to their last use, and the numbered times at which the usable rates of a pair change.

    The times are written, as both the rates and the payments are placed by them.
    """
    no_end = F.to_timestamp_ntz(F.lit(NO_END))
    usable_to = F.coalesce(F.col("validTo") + F.lit(timedelta(seconds=freeze_seconds)), no_end)
    value = decoded_rate(F.col("rate"), F.col("decimals")).alias("rateValue")
    spans = rates.select(*PAIR, "rateId", "validFrom", "validTo", usable_to.alias("usableTo"), value)
    spans = spans.where(F.col("validFrom") < F.col("usableTo"))
    times = spans.select(*PAIR, F.explode(F.array("validFrom", "usableTo")).alias("at"))
    return spans, staged(numbered_times(times, PAIR, "at", "number"), "rate-times")


def _usable_at(spans: DataFrame, times: DataFrame) -> DataFrame:
    """Each rate with every ``number`` of its pair's times from its start to its end: one row for each rate usable then."""
    first = times.select(*PAIR, F.col("at").alias("validFrom"), F.col("number").alias("_first"))
    end = times.select(*PAIR, F.col("at").alias("usableTo"), F.col("number").alias("_end"))
    placed = spans.join(first, [*PAIR, "validFrom"]).join(end, [*PAIR, "usableTo"])
    return placed.withColumn("number", F.explode(F.sequence("_first", F.col("_end") - 1))).drop("_first", "_end")


def _until_replaced(spans: DataFrame, times: DataFrame) -> DataFrame:
    """Rates cut where a newer one that lasts as long starts, from when on they can't be in force.

    Looks among the next few starts only; a rate that is left too long changes no
    result, as the newest of those usable is taken anyway.
    """
    first = times.select(*PAIR, F.col("at").alias("validFrom"), F.col("number").alias("_first"))
    together = W.partitionBy(*PAIR, F.expr(f"_first div {STARTS_TOGETHER}")).orderBy("validFrom", "rateId")
    following = F.collect_list(F.struct("validFrom", "usableTo")).over(together.rowsBetween(1, NEXT_STARTS))
    longer = F.filter("_following", lambda other: other["usableTo"] >= F.col("usableTo"))
    cut = F.least("usableTo", F.get(longer, F.lit(0))["validFrom"])
    found = spans.join(first, [*PAIR, "validFrom"]).withColumn("_following", following).withColumn("usableTo", cut)
    return found.where(F.col("validFrom") < F.col("usableTo")).drop("_first", "_following")


def usable_rates(
    payments: DataFrame, rates: DataFrame, freeze_seconds: int = RATE_FREEZE_SECONDS, ts: str = "createdDate"
) -> DataFrame:
    """Each payment with every rate of its currency pair usable at its time.

    A rate is usable from ``validFrom`` until ``freeze_seconds`` after
    ``validTo``; ``frozen`` marks a use past ``validTo``. A rate without end is
    usable from its start on. Payments without a usable rate keep NULLs.

    The starts and ends of a pair's rates cut time into stretches in which the
    usable rates are the same. An as-of merge gives each payment the number of
    its stretch, which its rates are then joined on, so that a payment meets only
    rates it can use. ``payments`` has a unique ``transferAId``.
    """
    spans, times = _timeline(rates, freeze_seconds)
    marked = with_last_mark(payments, times.select(*PAIR, "at", F.struct("number").alias("mark")), PAIR, ts, "transferAId")
    usable = _usable_at(spans, times).select(*PAIR, "number", "rateId", "rateValue", "validFrom", "validTo")
    met = marked.withColumn("number", F.col("mark.number")).join(usable, [*PAIR, "number"], "left")
    frozen = F.coalesce(F.col(ts) >= F.col("validTo"), F.lit(False)).alias("frozen")
    return met.select(*payments.columns, "rateId", "rateValue", "validFrom", frozen)


def rate_in_force(
    payments: DataFrame, rates: DataFrame, freeze_seconds: int = RATE_FREEZE_SECONDS, ts: str = "createdDate"
) -> DataFrame:
    """Each payment with the usable rate that started last; of several, that of the largest id.

    The rate in force in each stretch of a pair's time is told from the rates
    alone; the as-of merge then carries it to the payments.
    """
    spans, times = _timeline(rates, freeze_seconds)
    newest = F.max_by(F.struct("rateId", "rateValue", "validTo"), F.struct("validFrom", "rateId")).alias("newest")
    in_force = _usable_at(_until_replaced(spans, times), times).groupBy(*PAIR, "number").agg(newest)
    marks = times.join(in_force, [*PAIR, "number"], "left").select(*PAIR, "at", F.struct("newest").alias("mark"))
    marks = staged(marks, "rates-in-force")
    marked = with_last_mark(payments, marks, PAIR, ts, "transferAId").withColumn("newest", F.col("mark.newest"))
    frozen = F.coalesce(F.col(ts) >= F.col("newest.validTo"), F.lit(False)).alias("frozen")
    return marked.select(*payments.columns, "newest.rateId", "newest.rateValue", frozen)


def converted_quotes(ledger: Tables) -> DataFrame:
    """Rate and rounding of every exchange payment's first quote, as report text."""
    rates = ledger["exchange_channel_rates"].select(
        F.col("id").alias("exchangeRateId"), decoded_rate(F.col("rate"), F.col("decimals")).alias("forex")
    )
    sent, received = F.col("transferAmount"), F.col("payeeReceiveAmount")
    return (
        ledger["fxTransaction"]
        .select("transferAId", F.col("fxQuoteAId").alias("quoteId"), "exchangeRateId")
        .join(ledger["quoteResponse"], "quoteId")
        .join(lookup(rates), "exchangeRateId", "left")
        .select(
            "transferAId",
            or_null_word(float_text(F.col("forex"))).alias("forexRate"),
            or_null_word(float_text(rounding_difference(sent, F.col("forex"), received))).alias("rounding"),
        )
    )
