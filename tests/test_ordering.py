"""Ordinals, repeated look-ups, split reads, staged tables and their removal."""

import gc
import os
import time
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from clearbook.operators.joins import repeated_as_matched
from clearbook.operators.ordering import with_ordinals
from clearbook.plans import reports
from clearbook.session import application_folder
from clearbook.sources import ledger as sources
from clearbook.sources.sinks import staged, sweep


def test_ordinals(spark):
    rows = spark.createDataFrame([(k * 7919 % 500, "x" if k % 3 else None) for k in range(500)], "a INT, b STRING").repartition(7)
    numbered = with_ordinals(rows, [F.desc("a"), "b"])
    assert numbered.columns == ["a", "b", "ordinal"]
    assert [r["ordinal"] for r in numbered.orderBy(F.desc("a")).collect()] == list(range(1, 501))
    plan = numbered._jdf.queryExecution().executedPlan().toString()
    assert "Sort" not in plan.split("BroadcastExchange")[0]


def test_ordinals_of_equal_and_of_no_rows(spark):
    ties = spark.createDataFrame([(1, k % 2) for k in range(90)], "a INT, b INT")
    assert sorted(r["ordinal"] for r in with_ordinals(ties, ["a"]).collect()) == list(range(1, 91))
    assert with_ordinals(ties.where("a > 1"), ["a"]).count() == 0


def test_rows_repeat_as_a_left_join_would(spark):
    rows = spark.createDataFrame([(1, "p"), (2, "q"), (2, "r"), (3, "s"), (None, "t")], "kind INT, name STRING")
    others = spark.createDataFrame([(1, "one"), (2, "two"), (2, "zwei"), (2, "deux"), (None, "no")], "id INT, word STRING")
    repeated = repeated_as_matched(rows, "kind", others, "id")
    assert repeated.columns == ["kind", "name"]
    joined = rows.join(others, F.col("kind") == F.col("id"), "left").select("kind", "name")
    assert sorted(map(str, repeated.collect())) == sorted(map(str, joined.collect()))


def test_join_goes_where_the_key_is_unique(spark):
    rows = spark.createDataFrame([(k % 3, k) for k in range(30)], "kind INT, n INT")
    unique = spark.createDataFrame([(0, "a"), (1, "b"), (2, "c")], "id INT, word STRING")
    for others, joins in ((unique, False), (unique.unionByName(unique.limit(1)), True)):
        result = repeated_as_matched(rows, "kind", others, "id")
        count = len(result.collect())
        final = result._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        assert ("Join" in final) is joins and count == (40 if joins else 30)


@pytest.mark.parametrize("parts", [1, 2, 7])
def test_pieces_by_hash_are_disjoint_and_complete(spark, parts):
    rows = spark.createDataFrame([(k, f"T{k}") for k in range(200)] + [(200, None), (201, "")], "n INT, id STRING")
    met = [{r["n"] for r in rows.where(p).collect()} for p in sources.hash_predicates("id", parts)]
    assert len(met) == parts and all(met)
    assert sum(map(len, met)) == 202 and set().union(*met) == set(range(202))


def test_pieces_by_time_are_disjoint_and_complete(spark):
    day = datetime(2020, 1, 1)
    rows = spark.createDataFrame([(k, day + timedelta(hours=6 * k)) for k in range(40)] + [(40, None)], "n INT, ts TIMESTAMP_NTZ")
    for cuts in ([], [day], [day + timedelta(days=d) for d in (5, 1, 1, 3)]):
        pieces = sources.time_predicates("ts", cuts)
        met = [{r["n"] for r in rows.where(p).collect()} for p in pieces]
        assert sum(map(len, met)) == 41 and set().union(*met) == set(range(41))
    both = sources.both_predicates(sources.hash_predicates("CAST(n AS STRING)", 3), sources.time_predicates("ts", [day + timedelta(days=2)]))
    met = [{r["n"] for r in rows.where(p).collect()} for p in both]
    assert len(both) == 6 and sum(map(len, met)) == 41 and set().union(*met) == set(range(41))


def folders(spark):
    return {name for name in os.listdir(application_folder(spark)) if name.startswith("staged-")}


def cleared(spark):
    """Staged folders left after the garbage collectors of both sides have run, with another query in between."""
    for _ in range(6):
        gc.collect()
        spark.range(1).write.format("noop").mode("overwrite").save()
        if not sweep(spark, collect=True):
            break
        time.sleep(0.3)
    return folders(spark)


def test_staged_table_lives_as_long_as_its_readers(spark):
    before = cleared(spark)
    table = staged(spark.range(100).toDF("n"), "numbers")
    derived = table.where("n > 10").join(table.withColumnRenamed("n", "m"), F.col("n") == F.col("m")).groupBy().count()
    del table
    assert len(cleared(spark) - before) == 1 and derived.first()[0] == 89
    del derived
    assert cleared(spark) <= before


@pytest.mark.parametrize("name", ["rate_validity_join", "rate_in_force", "dfsp_daily_txn_ordered"])
def test_a_query_leaves_no_staged_table(spark, sf_dir, name):
    before = cleared(spark)
    assert entry.queries()[name](spark, sf_dir).count()
    assert cleared(spark) <= before


def test_order_of_a_report_is_a_column(ledger):
    report = reports.daily_dfsp_transactions(ledger, entry.START, entry.END, entry.FSP_ID)
    numbered = reports.in_report_order(report, "currentTransferID").orderBy("ordinal").collect()
    keys = [(r["createdDate"], r["currentTransferID"]) for r in numbered]
    assert keys == sorted(keys) and [r["ordinal"] for r in numbered] == list(range(1, len(keys) + 1))
