"""Reports read the folders of their period or window alone, and give the same rows as over whole tables."""

from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from clearbook.plans import reports
from clearbook.sources.derived import PARTITIONED, STORED
from clearbook.sources.ledger import from_frames
from clearbook.sources.periods import Within, of_quotes_between, period_of

DAYS = ("1997-02-05T00:00:00", "1997-11-05T23:59:59")


def scans(node, found):
    """Every file scan of an executed plan: its table and the files it read."""
    kind = node.getClass().getSimpleName()
    if kind == "AdaptiveSparkPlanExec":
        return scans(node.executedPlan(), found)
    if kind.endswith("QueryStageExec"):
        return scans(node.plan(), found)
    if kind == "ReusedExchangeExec":
        return found
    if kind == "FileSourceScanExec":
        path = node.relation().location().rootPaths().head().toString()
        table = [part for part in path.split("/") if "=" not in part][-1]
        found.append((table, node.metrics().apply("numFiles").value()))
    children = node.children()
    for k in range(children.size()):
        scans(children.apply(k), found)
    return found


def files_read(df):
    df.collect()
    return scans(df._jdf.queryExecution().executedPlan(), [])


def files_of(ledger, name, pattern):
    return len([f for f in Path(ledger.path(name)).glob(pattern) if f.name.endswith(".parquet")])


def counted(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize(
    "report",
    [
        lambda t: reports.daily_dfsp_transactions(t, *DAYS, "NATION_3"),
        lambda t: reports.daily_hub_transactions(t, *DAYS),
        lambda t: reports.dfsp_transactions_legacy(t, "NATION_3", *DAYS),
        lambda t: reports.hub_transactions_legacy(t, *DAYS),
    ],
    ids=["dfsp", "hub", "dfsp_legacy", "hub_legacy"],
)
def test_days_read_their_period_only(ledger, report):
    result = report(ledger)
    read = files_read(result)
    tables = {name for name, _ in read}
    assert {"quote", "quoteParty", "transfer"} <= tables
    for name, count in read:
        if name in STORED:
            key = PARTITIONED.get(name, ["period"])[0]
            assert count <= files_of(ledger, name, f"{key}=1997-01-01/**/*"), name
            assert count < files_of(ledger, name, "**/*"), name
    plain = from_frames({name: ledger[name] for name in ledger})
    assert counted(result) == counted(report(plain))


def test_a_window_reads_its_fulfilments_only(ledger):
    window = 1997 * 12 + 3
    result = reports.reconciliation_amounts(ledger, 100, window)
    read = dict(files_read(result))
    assert 0 < read["transferFulfilment"] <= files_of(ledger, "transferFulfilment", f"*/inWindow={window}/*")
    assert read["transferParticipant"] <= files_of(ledger, "transferParticipant", "period=1997-01-01/*")
    plain = from_frames({name: ledger[name] for name in ledger})
    assert counted(result) == counted(reports.reconciliation_amounts(plain, 100, window))


def test_every_row_lies_under_its_period(ledger):
    """The period of a row is that of its payment's quote; the tables show their own columns alone."""
    quotes = ledger.stored("quote")
    assert quotes.where(F.col("quotedIn") != period_of(F.col("createdDate"), ledger.unit)).count() == 0
    references = ledger.stored("transactionReference")
    for name in ("transfer", "transferParticipant", "transferStateChange", "transferFulfilment"):
        mine = ledger.stored(name).select(F.col("transferId").alias("transactionReferenceId"), F.col("period").alias("mine"))
        assert mine.join(references, "transactionReferenceId").where("mine <> period").count() == 0
        assert "period" not in ledger[name].columns
    exchange = ledger.stored("fxTransaction").select(F.col("period").alias("mine"), F.explode(F.array("transferAId", "transferBId")).alias("transactionReferenceId"))
    assert exchange.join(references, "transactionReferenceId").where("mine <> period").count() == 0
    assert "period" not in ledger["quote"].columns and "quotedIn" not in ledger["quote"].columns


def test_period_of_a_time(spark):
    row = spark.createDataFrame([(datetime(2020, 5, 17, 23, 59, 59),)], "ts TIMESTAMP_NTZ")
    days = row.select(*[period_of(F.col("ts"), u).cast("string").alias(u) for u in ("year", "month", "day")]).first()
    assert tuple(days) == ("2020-01-01", "2020-05-01", "2020-05-17")


def test_a_ledger_without_layout_is_left_alone(ledger):
    plain = from_frames({"quote": ledger["quote"]})
    assert of_quotes_between(plain, F.lit(None), F.lit(None)) is plain
    start, end = (F.to_timestamp_ntz(F.lit(moment)) for moment in DAYS)
    restricted = of_quotes_between(ledger, start, end)
    assert isinstance(restricted, Within) and of_quotes_between(restricted, start, end) is restricted
    assert list(restricted) == list(ledger) and len(restricted) == len(ledger)
