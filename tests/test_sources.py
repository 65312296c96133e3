import os

import pytest
from pyspark.sql.classic.dataframe import DataFrame

from clearbook.plans import reports
from clearbook.session import run_folder, shared_folder
from clearbook.sources import derived
from clearbook.sources import ledger as sources
from clearbook.sources.derived import DerivedLedger, derived_ledger
from clearbook.sources.schemas import LEDGER_COLUMNS, ledger_schema
from clearbook.sources.sinks import write_csv


def test_derived_row_counts(spark, ledger, sf_dir):
    if not sf_dir.endswith("sf0.001"):
        pytest.skip("counts are those of the smallest data")
    # What the derivation gives at this size.
    counts = {
        "transfer": 2433, "transferParticipant": 4866, "quote": 2433, "quoteParty": 4866, "fxTransaction": 960,
        "transferStateChange": 4928, "transferFulfilment": 792, "settlementWindow": 80,
        "settlementWindowStateChange": 157, "settlement": 26, "quoteFacts": 1473, "participant": 30,
    }
    assert {t: ledger[t].count() for t in counts} == counts


def test_derived_tables_have_the_declared_columns(ledger):
    for table in LEDGER_COLUMNS:
        assert [(f.name, f.dataType) for f in ledger[table].schema] == [(f.name, f.dataType) for f in ledger_schema(table)], table


def test_amounts_cancel_out(ledger):
    assert ledger["transferParticipant"].agg({"amount": "sum"}).first()[0] == 0


def test_ledger_is_shared_within_an_application(spark, sf_dir):
    assert derived_ledger(spark, sf_dir) is derived_ledger(spark, sf_dir)


def test_stored_tables_lie_in_the_shared_folder(spark, ledger):
    assert ledger.path("transfer").startswith(shared_folder(spark))


def test_quotes_of_a_bucket_lie_in_order_of_time(spark, ledger):
    for path in ledger["quote"].inputFiles():
        times = [r[0] for r in spark.read.parquet(path).select("createdDate").coalesce(1).collect()]
        assert times == sorted(times)


def test_buckets_follow_the_input(spark, sf_dir, monkeypatch):
    """A bucket, which one task sorts and merges, is not larger on six times the input."""
    found = []
    for size in (1 << 30, 6 << 30):
        monkeypatch.setattr(derived, "_input_size", lambda *_, size=size: (size // 4, 0))
        found.append(DerivedLedger(spark, sf_dir).buckets)
    assert found[1] == 6 * found[0]


def test_legs_are_dealt_before_they_give_rows(spark, ledger, monkeypatch):
    """A leg moves once for the two parties of its quote; the rows lie where they did."""
    moved, plain = [], DataFrame.repartition
    monkeypatch.setattr(DataFrame, "repartition", lambda df, *a: moved.append((a[1], df.columns)) or plain(df, *a))
    own = DerivedLedger(spark, ledger.sf_dir)
    columns = own.legs.columns
    assert own["quoteParty"].exceptAll(ledger["quoteParty"]).isEmpty() and own["quoteParty"].count() == ledger["quoteParty"].count()
    own.close()
    assert moved == [("quoteId", columns)]


def test_scanned_facts_lie_in_more_files_than_buckets(ledger):
    files = [f for f in os.listdir(ledger.path("quoteFacts")) if f.endswith(".parquet")]
    assert len(files) > ledger.buckets


def test_a_closed_ledger_leaves_nothing(spark, sf_dir):
    def registered():
        return {t.name for t in spark.catalog.listTables()}

    before = registered()
    own = DerivedLedger(spark, sf_dir)
    assert own["transferError"].count() and registered() > before and os.path.exists(own.folder)
    own.close()
    assert registered() == before and not os.path.exists(own.folder)


def test_catalog_source_across_namespaces(spark, ledger):
    spark.sql("CREATE DATABASE IF NOT EXISTS clearbook_test_fx LOCATION '%s'" % run_folder(spark, "db"))
    ledger["transfer"].createOrReplaceTempView("transfer_view")
    path = run_folder(spark, "table")
    ledger["fxTransaction"].write.option("path", path).mode("overwrite").saveAsTable("clearbook_test_fx.fxTransaction")
    ledger["fxQuote"].write.option("path", path + "-q").mode("overwrite").saveAsTable("default.fxQuote")
    tables = sources.from_catalog(spark, "default", {"fxTransaction": "clearbook_test_fx"})
    assert tables["fxTransaction"].count() == ledger["fxTransaction"].count()
    assert tables["fxQuote"].count() == ledger["fxQuote"].count()
    spark.sql("DROP TABLE clearbook_test_fx.fxTransaction")
    spark.sql("DROP TABLE default.fxQuote")


def test_frames_as_a_ledger(ledger):
    tables = sources.from_frames({"transfer": ledger["transfer"]})
    assert list(tables) == ["transfer"] and len(tables) == 1
    with pytest.raises(KeyError):
        tables["quote"]


def test_csv_sink(spark, ledger):
    report = reports.settlement_window_summary(ledger)
    path = run_folder(spark, "csv-test") + "/report"
    write_csv(report, path)
    read = spark.read.schema(report.schema).option("header", True).csv(path)
    assert read.exceptAll(report).count() == 0 and read.count() == report.count()
