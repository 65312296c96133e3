"""Streams against their batch twins, over several files and batches."""

import os
from contextlib import contextmanager
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from clearbook.operators import rules, settlement, states
from clearbook.session import run_folder
from clearbook.sources.schemas import LEDGER_COLUMNS, QUOTE_FACT_COLUMNS
from clearbook.streaming import runs, streams


def same(one, other):
    other = other.select(*one.columns)
    return one.exceptAll(other).count() == 0 and other.exceptAll(one).count() == 0


def test_quote_events(spark, ledger):
    facts = streams.parquet_stream(spark, ledger.path("quoteFacts"), QUOTE_FACT_COLUMNS)
    streamed = runs.run_appending(streams.quote_event_stream(facts), "test-quotes")
    assert same(streamed, rules.event_rows(rules.quote_events(ledger["quoteFacts"])))


def test_latest_state_over_many_batches(spark, ledger):
    columns = LEDGER_COLUMNS["transferStateChange"]
    changes = spark.readStream.schema(columns).option("maxFilesPerTrigger", 2).parquet(ledger.path("transferStateChange"))
    values = ["transferStateId", "createdDate"]
    latest = streams.latest_state_stream(changes, "transferId", "transferStateChangeId", values)
    assert same(runs.run_updating(latest, "test-latest", "transferId"), states.latest_transfer_state(ledger))


def test_latest_state_when_a_later_batch_is_older(spark, tmp_path):
    columns = LEDGER_COLUMNS["transferStateChange"]
    day = datetime(2020, 1, 1)
    for name, row in (("a", (2, "T", "COMMITTED", day)), ("b", (1, "T", "RESERVED", day)), ("c", (3, "U", "RESERVED", day))):
        spark.createDataFrame([row], columns).coalesce(1).write.mode("append").parquet(str(tmp_path / "changes"))
    changes = spark.readStream.schema(columns).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "changes"))
    latest = streams.latest_state_stream(changes, "transferId", "transferStateChangeId", ["transferStateId"])
    rows = runs.run_updating(latest, "test-older", "transferId").collect()
    assert {tuple(r) for r in rows} == {("T", "COMMITTED"), ("U", "RESERVED")}


def test_settlement_days(spark, ledger):
    transfers = streams.parquet_stream(spark, ledger.path("transfer"), LEDGER_COLUMNS["transfer"])
    streamed = runs.run_appending(streams.settlement_day_stream(transfers, ["currencyId"], "createdDate", "1 hour"), "test-days")
    newest = ledger["transfer"].agg(F.max("createdDate")).first()[0]
    final = settlement.settlement_day_totals(ledger["transfer"], ["currencyId"]).where(
        F.col("dayEnd") <= F.lit(newest - timedelta(hours=1))
    )
    assert same(streamed, final)


def test_timeouts(spark, tmp_path):
    columns = LEDGER_COLUMNS["transferStateChange"]
    day = datetime(2020, 1, 1)

    def minutes(n):
        return day + timedelta(minutes=n)

    rows = [
        (1, "ontime", "RECEIVED_PREPARE", day),
        (2, "ontime", "COMMITTED", minutes(10)),
        (3, "late", "RECEIVED_PREPARE", day),
        (4, "late", "COMMITTED", minutes(11)),
        (5, "never", "RECEIVED_PREPARE", day),
        (6, "open", "RECEIVED_PREPARE", minutes(59)),
        (7, "clock", "RECEIVED_PREPARE", minutes(60)),
        (8, "clock", "COMMITTED", minutes(60)),
    ]
    spark.createDataFrame(rows, columns).coalesce(1).write.parquet(str(tmp_path / "changes"))
    changes = streams.parquet_stream(spark, str(tmp_path / "changes"), columns)
    found = runs.run_appending(streams.timeout_stream(changes, "1 minute", timeout_seconds=600), "test-timeouts").collect()
    assert {r["transferId"] for r in found} == {"late", "never"}


def test_settings_are_restored(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    with runs.stream_settings(spark):
        assert "RocksDB" in spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def test_runs_do_not_count_their_state(spark, monkeypatch):
    key, seen = "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows", []
    plain = runs.stream_settings

    @contextmanager
    def watched(*args, **kwargs):
        with plain(*args, **kwargs):
            seen.append(spark.conf.get(key))
            yield

    monkeypatch.setattr(runs, "stream_settings", watched)
    before = spark.conf.get(key, None)
    path = run_folder(spark, "uncounted")
    spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (2, 3, "c")], "k INT, n INT, v STRING").write.parquet(path)
    changes = streams.parquet_stream(spark, path, "k INT, n INT, v STRING")
    latest = runs.run_updating(streams.latest_state_stream(changes, "k", "n", ["v"]), "uncounted", "k")
    same = runs.run_appending(changes, "uncounted-rows")
    assert sorted(map(tuple, latest.collect())) == [(1, "b"), (2, "c")] and same.count() == 3
    assert seen == ["false", "false"] and spark.conf.get(key, None) == before


@pytest.mark.parametrize("zone", ["UTC", "Europe/Paris", "America/New_York"])
def test_instants_are_exact_where_clocks_change(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    moments = [datetime(2024, 10, 27, h, m, 5, 123456) for h in range(4) for m in (0, 30)]
    moments += [datetime(2024, 3, 31, h, 30) for h in range(4)] + [datetime(1969, 12, 31, 23, 59, 59, 999999)]
    try:
        spark.conf.set("spark.sql.session.timeZone", zone)
        rows = spark.createDataFrame([(m,) for m in moments], "ts TIMESTAMP_NTZ")
        instant = streams.as_instant(F.col("ts"))
        found = rows.select("ts", F.unix_micros(instant).alias("micros"), streams.as_utc_time(instant).alias("back")).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert all(r["back"] == r["ts"] for r in found)
    assert {r["ts"]: r["micros"] for r in found} == {m: (m - datetime(1970, 1, 1)) // timedelta(microseconds=1) for m in moments}


def test_state_of_quiet_entities_expires(spark, tmp_path):
    """Each day brings new transfers: with an expiry the state stays at a few days of them, and results are the same."""
    columns = LEDGER_COLUMNS["transferStateChange"]
    day = datetime(2020, 1, 1)
    for n in range(8):
        rows = [(n * 100 + k * 2 + s, f"T{n}-{k}", state, day + timedelta(days=n, hours=s)) for k in range(5) for s, state in ((1, "COMMITTED"), (0, "RESERVED"))]
        rows.append((n * 100 + 99, "steady", f"S{n}", day + timedelta(days=n)))
        spark.createDataFrame(rows, columns).coalesce(1).write.mode("append").parquet(str(tmp_path / "changes"))
        # Files are taken in order of their time.
        newest = max((tmp_path / "changes").glob("*.parquet"), key=lambda f: f.stat().st_mtime_ns)
        os.utime(newest, (1_600_000_000 + n * 60,) * 2)
    sizes, found = {}, {}
    for expiry in (None, timedelta(days=2)):
        changes = streams.parquet_stream(spark, str(tmp_path / "changes"), columns, files_per_batch=1)
        latest = streams.latest_state_stream(
            changes, "transferId", "transferStateChangeId", ["transferStateId", "createdDate"], "createdDate", expiry
        )
        out, place = {}, tmp_path / f"checkpoint-{expiry is None}"
        with runs.stream_settings(spark):
            query = (
                latest.writeStream.foreachBatch(lambda batch, _, out=out: out.update({r["transferId"]: (r["transferStateId"], r["createdDate"]) for r in batch.collect()}))
                .outputMode("update").option("checkpointLocation", str(place)).trigger(availableNow=True).start()
            )
            query.awaitTermination()
        sizes[expiry] = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
        found[expiry] = out
    assert max(sizes[None]) == 41 and sizes[None][-1] == 41
    assert max(sizes[timedelta(days=2)]) < 25 and sizes[timedelta(days=2)][-1] < max(sizes[timedelta(days=2)])
    assert found[None] == found[timedelta(days=2)]
    assert found[None]["T3-1"] == ("COMMITTED", day + timedelta(days=3, hours=1)) and found[None]["steady"][0] == "S7"


def test_an_entity_that_comes_back_after_its_expiry(spark, tmp_path):
    columns = LEDGER_COLUMNS["transferStateChange"]
    day = datetime(2020, 1, 1)
    for n, row in enumerate([(9, "T", "COMMITTED", day), (10, "U", "RESERVED", day + timedelta(days=9)), (11, "U", "COMMITTED", day + timedelta(days=18)), (1, "T", "RESERVED", day + timedelta(days=19))]):
        spark.createDataFrame([row], columns).coalesce(1).write.mode("append").parquet(str(tmp_path / "changes"))
        newest = max((tmp_path / "changes").glob("*.parquet"), key=lambda f: f.stat().st_mtime_ns)
        os.utime(newest, (1_600_000_000 + n * 60,) * 2)
    changes = streams.parquet_stream(spark, str(tmp_path / "changes"), columns, files_per_batch=1)
    latest = streams.latest_state_stream(
        changes, "transferId", "transferStateChangeId", ["transferStateId"], "createdDate", timedelta(days=2)
    )
    # Its state is gone, but readers still take the latest of all its rows.
    rows = runs.run_updating(latest, "test-expired", "transferId", newest_by="transferStateChangeId").collect()
    assert {tuple(r) for r in rows} == {("T", "COMMITTED"), ("U", "COMMITTED")}
