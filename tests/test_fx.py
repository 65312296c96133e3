import time
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from clearbook.operators import asof, fx, settlement, timing
from clearbook.sources import reference_data
from clearbook.sources.derived import rate_validity

PAYMENTS = "transferAId STRING, sourceCurrency STRING, targetCurrency STRING, createdDate TIMESTAMP_NTZ"
RATES = (
    "rateId BIGINT, sourceCurrency STRING, targetCurrency STRING, rate INT, decimals INT, "
    "validFrom TIMESTAMP_NTZ, validTo TIMESTAMP_NTZ"
)
JAN, FEB = datetime(2020, 1, 1), datetime(2020, 2, 1)


def at(second, day=1, month=2):
    return datetime(2020, month, day, 0, 0, second)


def payments(spark, *times):
    return spark.createDataFrame([(f"p{n}", "EUR", "MAD", t) for n, t in enumerate(times)], PAYMENTS)


def test_rate_is_usable_until_the_freeze_ends(spark):
    rates = spark.createDataFrame([(1, "EUR", "MAD", 10, 1, JAN, FEB), (2, "EUR", "MAD", 20, 1, FEB, at(0, 1, 3))], RATES)
    times = [JAN, at(0), at(29), at(30), datetime(2019, 12, 31), at(29, 1, 3), at(31, 1, 3)]
    found = {(r["transferAId"], r["rateId"], r["frozen"]) for r in fx.usable_rates(payments(spark, *times), rates).collect()}
    assert found == {
        ("p0", 1, False),
        ("p1", 1, True),
        ("p1", 2, False),
        ("p2", 1, True),
        ("p2", 2, False),
        ("p3", 2, False),
        ("p4", None, False),
        ("p5", 2, True),
        ("p6", None, False),
    }


def test_newest_usable_rate_is_in_force(spark):
    rates = spark.createDataFrame([(1, "EUR", "MAD", 10, 1, JAN, FEB), (2, "EUR", "MAD", 20, 1, FEB, at(0, 1, 3))], RATES)
    rows = fx.rate_in_force(payments(spark, at(10), JAN, datetime(2019, 1, 1)), rates).collect()
    assert {(r["transferAId"], r["rateId"], r["rateValue"]) for r in rows} == {("p0", 2, 2.0), ("p1", 1, 1.0), ("p2", None, None)}


def test_rate_without_end(spark):
    rates = spark.createDataFrame([(1, "EUR", "MAD", 10, 1, JAN, None), (2, "XOF", "MAD", 10, 1, JAN, None)], RATES)
    rows = fx.usable_rates(payments(spark, datetime(2035, 1, 1), datetime(2019, 1, 1)), rates).collect()
    assert {(r["transferAId"], r["rateId"], r["frozen"]) for r in rows} == {("p0", 1, False), ("p1", None, False)}


def test_usable_rates_against_brute_force(ledger):
    some = fx.exchange_payments(ledger).drop("transferBId", "amount")
    rates = rate_validity(ledger)
    frozen_to = {r["rateId"]: r for r in rates.collect()}
    expected = set()
    for p in some.collect():
        fits = [
            r["rateId"]
            for r in frozen_to.values()
            if (r["sourceCurrency"], r["targetCurrency"]) == (p["sourceCurrency"], p["targetCurrency"])
            and r["validFrom"] <= p["createdDate"]
            and (p["createdDate"] - r["validTo"]).total_seconds() < 30
        ]
        expected |= {(p["transferAId"], r) for r in fits or [None]}
    assert {(r["transferAId"], r["rateId"]) for r in fx.usable_rates(some, rates).collect()} == expected


def test_provider_lookup(spark):
    rows = spark.createDataFrame([("EUR",), ("USD",)], "currencyId STRING")
    found = fx.with_fx_provider(rows, reference_data.standard_currency_providers(spark)).collect()
    assert {tuple(r) for r in found} == {("EUR", "DFSPEUR"), ("USD", None)}


def test_identifier_patterns(spark):
    names = ["DFSPEUR", "DFSPEURO", "dfspeur", "", "x" * 32, "x" * 33, None]
    rows = fx.identifier_checks(spark.createDataFrame([(n,) for n in names], "name STRING"), "name").collect()
    assert [r["isValidId"] for r in rows] == [True, True, True, False, True, False, False]
    assert [r["isVirtualName"] for r in rows] == [True, False, False, False, False, False, False]


def test_registry_document(spark, tmp_path):
    path = tmp_path / "registry.json"
    path.write_text(
        """{"currencies": [{"currencyId": "EUR"}, {"currencyId": "MAD"}],
            "monetaryZones": [{"monetaryZoneId": "EUR", "name": "Euro"}],
            "vdfsps": [{"dfspId": "DFSPEUR", "description": "v", "currencyId": "EUR"}],
            "dfsps": [{"dfspId": "a", "description": "d", "currencyId": "MAD"},
                      {"dfspId": "b", "description": "d", "currencyId": "ZZZ"}]}"""
    )
    rows = fx.dfsp_registry(reference_data.read_registry(spark, str(path))).collect()
    assert {tuple(r) for r in rows} == {("DFSPEUR", "EUR", "Euro", True), ("a", "MAD", None, False)}


def test_reference_lists(spark, tmp_path):
    (tmp_path / "map.json").write_text('[{"currency": "EUR", "dfsp": "DFSPEUR"}]')
    (tmp_path / "parameters.json").write_text('[\n{"id": "X", "value": "30",\n "description": "d"}]')
    assert reference_data.read_currency_providers(spark, str(tmp_path / "map.json")).collect() == [("EUR", "DFSPEUR")]
    assert reference_data.read_parameters(spark, str(tmp_path / "parameters.json")).collect() == [("X", "30", "d")]


def test_expired_quotes(ledger):
    assert timing.quote_expiry(ledger).where("expired").count() == 0
    late = timing.quote_expiry(ledger, expiry_seconds=4)
    assert late.where("NOT expired").count() == 0 and late.count() == ledger["transfer"].count()


def test_timed_out_transfers(spark):
    changes = spark.createDataFrame(
        [
            (1, "ontime", "RECEIVED_PREPARE", at(0)),
            (2, "ontime", "COMMITTED", at(10)),
            (3, "late", "RECEIVED_PREPARE", at(0)),
            (4, "late", "COMMITTED", at(11)),
            (5, "never", "RECEIVED_PREPARE", at(0)),
            (6, "fresh", "RECEIVED_PREPARE", at(50)),
            (7, "unprepared", "COMMITTED", at(0)),
        ],
        "transferStateChangeId BIGINT, transferId STRING, transferStateId STRING, createdDate TIMESTAMP_NTZ",
    )
    rows = timing.timed_out_transfers(changes, at(55), timeout_seconds=10).collect()
    assert {r["transferId"] for r in rows} == {"late", "never"}


def test_settlement_day_starts_at_half_past_eight(spark):
    moments = [datetime(2020, 1, 2, 8, 29, 59), datetime(2020, 1, 2, 8, 30)]
    rows = spark.createDataFrame([(m, 1) for m in moments], "createdDate TIMESTAMP_NTZ, amount INT")
    days = settlement.settlement_day_totals(rows, []).orderBy("dayStart").collect()
    assert [d["dayStart"] for d in days] == [datetime(2020, 1, 1, 8, 30), datetime(2020, 1, 2, 8, 30)]


def test_net_positions_cancel_out(ledger):
    sums = settlement.net_positions(ledger).groupBy("currencyId", "settlementWindowId").agg(F.sum("netPosition").alias("s"))
    assert sums.where("s <> 0").count() == 0
    assert sums.count() > 0


def test_rates_of_any_length(spark):
    """Ends in 9999, no end, overlaps, many rates of one pair: each payment meets what a comparison finds."""
    start, pair = datetime(2000, 1, 1), ("EUR", "MAD")
    spans = [(0, None), (0, datetime(9999, 12, 30)), (5, start + timedelta(hours=5, seconds=10)), (7, start + timedelta(days=4000))]
    spans += [(k, start + timedelta(hours=k + 1 + k % 40)) for k in range(0, 3000, 7)]
    rows = [(*pair, n, 12345, 3, start + timedelta(hours=k), end) for n, (k, end) in enumerate(spans)]
    columns = "sourceCurrency STRING, targetCurrency STRING, rateId INT, rate INT, decimals INT"
    rates = spark.createDataFrame(rows, f"{columns}, validFrom TIMESTAMP_NTZ, validTo TIMESTAMP_NTZ")
    moments = [start + timedelta(minutes=m) for m in range(-90, 190_000, 997)]
    payments = spark.createDataFrame(
        [(f"p{n}", *(pair if n % 5 else ("EUR", "XXX")), m) for n, m in enumerate(moments)],
        "transferAId STRING, sourceCurrency STRING, targetCurrency STRING, createdDate TIMESTAMP_NTZ",
    )
    expected = set()
    for n, m in enumerate(moments):
        fits = [r[2] for r in rows if n % 5 and r[5] <= m and (r[6] is None or (m - r[6]).total_seconds() < 30)]
        expected |= {(f"p{n}", r) for r in fits or [None]}
    assert {(r["transferAId"], r["rateId"]) for r in fx.usable_rates(payments, rates).collect()} == expected

    newest = {}
    starts = {r[2]: r[5] for r in rows}
    for payment, rate in expected:
        if rate is not None:
            newest[payment] = max(rate, newest.get(payment, rate), key=lambda n: (starts[n], n))
    found = {r["transferAId"]: r["rateId"] for r in fx.rate_in_force(payments, rates).collect()}
    assert found == {p: newest.get(p) for p, _ in expected}


def test_one_pair_at_one_moment(spark):
    """A day of a pair with more rows than a piece holds is dealt to several; gaps in key or time meet nothing."""
    rows = [(n, "EUR", "MAD", at(n % 3)) for n in range(50)] + [(50, None, "MAD", at(0)), (51, "EUR", "MAD", None), (52, "EUR", "MAD", JAN)]
    marks = spark.createDataFrame([("EUR", "MAD", at(k), k) for k in (1, 2)] + [("XOF", "MAD", JAN, 9)], "a STRING, b STRING, at TIMESTAMP_NTZ, mark INT")
    table = spark.createDataFrame(rows, "id INT, a STRING, b STRING, ts TIMESTAMP_NTZ")
    for size in (1, 7, 1000):
        found = asof.with_last_mark(table, marks, ["a", "b"], "ts", "id", rows_per_piece=size)
        assert found.columns == ["id", "a", "b", "ts", "mark"]
        expected = {n: (n % 3 or None) if n < 50 else None for n, *_ in rows}
        assert {r["id"]: r["mark"] for r in found.collect()} == expected


def test_rates_without_end_replace_each_other(spark):
    """Many rates without end, each replaced by the next: what is in force has as many stretches as there are rates."""
    start = datetime(2000, 1, 1)
    rates = spark.createDataFrame([(n, "EUR", "MAD", n, 0, start + timedelta(minutes=n), None) for n in range(500)], RATES)
    spans, times = fx._timeline(rates, 30)
    assert fx._usable_at(fx._until_replaced(spans, times), times).count() == 500
    found = fx.rate_in_force(payments(spark, *(start + timedelta(minutes=n, seconds=5) for n in range(-1, 500))), rates)
    assert sorted((r["createdDate"], r["rateId"]) for r in found.collect()) == [(start + timedelta(minutes=n, seconds=5), n if n >= 0 else None) for n in range(-1, 500)]


def test_rate_plans_stay_small(ledger):
    some = fx.exchange_payments(ledger).drop("transferBId", "amount")
    for query in (fx.usable_rates, fx.rate_in_force):
        started = time.perf_counter()
        text = query(some, rate_validity(ledger))._jdf.queryExecution().executedPlan().toString()
        assert len(text) < 100_000 and time.perf_counter() - started < 30
