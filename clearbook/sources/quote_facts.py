"""Quote facts derived from the payment legs, as the JSON the rules read.

Most quotes are valid. Some are altered by their order key so that every rule
of the rule set has quotes to match.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# What the altered quotes carry.
ROUTED_QUOTES = [
    ("testfsp5", "testfsp4", "SEND", "XOF"),
    ("testfsp5", "testfsp4", "RECEIVE", "MAD"),
    ("testfsp5", "testfsp6", "SEND", "UGX"),
    ("testfsp5", "testfsp6", "RECEIVE", "ZMW"),
    ("testfsp6", "testfsp5", "SEND", "ZMW"),
    ("testfsp6", "testfsp5", "RECEIVE", "UGX"),
]
RARE_PAIRS = [("EUR", "GHS"), ("UGX", "RWF"), ("RWF", "UGX"), ("ZMW", "RWF"), ("RWF", "ZMW")]
ZONE_CURRENCIES = ["XOF", "XTS", "XXX", "EUR", "MAD"]
UNKNOWN_CURRENCY, UNKNOWN_FSP, INACTIVE_CURRENCY = "ZZZ", "OTHERFSP", "GHS"
FIRST_NAME, LAST_NAME, BIRTH_DATE = "Ada", "Example", "1990-01-01"


def _pick(values: list[str], index: Column) -> Column:
    return F.get(F.array(*[F.lit(v) for v in values]), index.cast("int"))


def quote_facts(legs: DataFrame) -> DataFrame:
    """One quote per payment: ``quoteId`` and four JSON documents."""
    k = F.col("k")
    zone = {side: _pick(ZONE_CURRENCIES, F.col(region)) for side, region in (("payer", "pr"), ("payee", "er"))}

    invalid = F.when(k % 19 == 0, F.floor(k / 19) % 10)
    routed = F.when(invalid.isNull() & (k % 17 == 0), F.floor(k / 17) % 6)
    rare = F.when(invalid.isNull() & routed.isNull() & (k % 13 == 0), F.floor(k / 13) % 5)
    internal = invalid.isNull() & routed.isNull() & rare.isNull() & (k % 11 == 0)

    quotes = legs.where(F.col("leg") < 2).select(
        "quoteId", "pname", "ename", k, invalid.alias("invalid"), routed.alias("routed"), rare.alias("rare"),
        internal.alias("internal"), zone["payer"].alias("payerZone"), zone["payee"].alias("payeeZone"),
    )
    is_invalid = [F.coalesce(F.col("invalid") == n, F.lit(False)) for n in range(10)]
    by_route = [_pick([r[n] for r in ROUTED_QUOTES], F.col("routed")) for n in range(4)]
    by_pair = [_pick([p[n] for p in RARE_PAIRS], F.col("rare")) for n in range(2)]

    payer_currency = F.coalesce(by_pair[0], "payerZone")
    payee_currency = F.coalesce(by_pair[1], "payeeZone")
    source = F.coalesce(
        by_route[0], F.when(F.col("internal"), F.concat(F.lit("DFSP"), "payerZone")).otherwise(F.col("pname"))
    )
    amount_type = (
        F.when(is_invalid[2], "SEND")
        .when(is_invalid[3], "RECEIVE")
        .otherwise(F.coalesce(by_route[2], F.when(k % 2 == 0, "SEND").otherwise("RECEIVE")))
    )
    currency = F.when(is_invalid[2] | is_invalid[3], UNKNOWN_CURRENCY).otherwise(
        F.coalesce(by_route[3], F.when(amount_type == "SEND", payer_currency).otherwise(payee_currency))
    )

    def account(money: Column, active: int) -> Column:
        return F.struct(
            F.lit("POSITION").alias("ledgerAccountType"), F.lit(active).alias("isActive"), money.alias("currency")
        )

    def side(money: Column, absent: Column) -> Column:
        accounts = F.array(account(money, 1), account(F.lit(INACTIVE_CURRENCY), 0))
        return F.to_json(F.struct(F.when(~absent, accounts).alias("accounts")))

    def payload(first_name: Column) -> Column:
        personal = F.struct(
            F.struct(
                first_name.alias("firstName"), F.when(~is_invalid[7], F.lit(LAST_NAME)).alias("lastName")
            ).alias("complexName"),
            F.when(is_invalid[9], "").when(~is_invalid[8], BIRTH_DATE).alias("dateOfBirth"),
        )
        payer_fsp = F.when(is_invalid[4], UNKNOWN_FSP).otherwise(source)
        return F.to_json(
            F.struct(
                amount_type.alias("amountType"),
                F.struct(F.lit("10").alias("amount"), currency.alias("currency")).alias("amount"),
                F.struct(
                    F.struct(payer_fsp.alias("fspId")).alias("partyIdInfo"),
                    F.when(~is_invalid[5], personal).alias("personalInfo"),
                ).alias("payer"),
            )
        )

    headers = F.struct(
        source.alias("fspiop-source"), F.coalesce(by_route[1], "ename").alias("fspiop-destination")
    )
    return quotes.select(
        "quoteId",
        F.to_json(headers).alias("headers"),
        F.when(is_invalid[6], payload(F.lit(7))).otherwise(payload(F.lit(FIRST_NAME))).alias("payload"),
        side(payer_currency, is_invalid[0]).alias("payer"),
        side(payee_currency, is_invalid[1]).alias("payee"),
    )
