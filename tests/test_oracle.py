"""Every registered query against its SQL, and what the plans look like."""

import duckdb
import pytest

import __spark_entry__ as entry
from checks.compare import TABLES, counted

SQL = entry.oracle_sql()
# The text-corpus queries have tests of their own; here are those that have SQL.
QUERIES = {name: query for name, query in entry.queries().items() if name in SQL}
# The reports, and the cores of the daily ones.
REPORTS = [*list(QUERIES)[: list(QUERIES).index("report_csv")], "transfer_core_dfsp", "transfer_core_hub"]


@pytest.fixture(scope="module")
def database(sf_dir):
    con = duckdb.connect()
    for table in TABLES.split():
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")
    return con


def test_every_query_has_sql():
    without = {name for name in entry.queries() if name not in SQL}
    assert set(SQL) == set(QUERIES)
    assert all(name.startswith("op") or name == "pipeline" for name in without)


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_its_sql(spark, sf_dir, database, name):
    result = QUERIES[name](spark, sf_dir)
    answer = database.execute(SQL[name])
    columns = [d[0] for d in answer.description]
    assert sorted(columns) == sorted(result.columns)
    rows = result.collect()
    assert rows
    assert counted(result.columns, [tuple(r) for r in rows]) == counted(columns, answer.fetchall())


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0


def plan_of(df, mode="formatted"):
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString(mode)
    )


@pytest.mark.parametrize("name", REPORTS)
def test_reports_join_on_equality(spark, sf_dir, name):
    plan = plan_of(QUERIES[name](spark, sf_dir))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "Python" not in plan


@pytest.mark.parametrize("name", ["dfsp_daily_txn", "hub_daily_txn", "hub_daily_txn_anon"])
def test_daily_reports_are_built_without_a_job(spark, sf_dir, ledger, name):
    ledger.prepare()
    group = f"building-{name}"
    spark.sparkContext.setJobGroup(group, name)
    try:
        QUERIES[name](spark, sf_dir)
        assert not spark.sparkContext.statusTracker().getJobIdsForGroup(group)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


@pytest.fixture
def no_broadcast(spark):
    """Plans as they are where no side is small enough to broadcast."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, before)


@pytest.mark.parametrize("name", ["latest_transfer_state", "counterparty_pairs", "transfer_timeout"])
def test_bucketed_tables_are_not_shuffled(spark, sf_dir, no_broadcast, name):
    plan = plan_of(QUERIES[name](spark, sf_dir), "simple")
    exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning(transferId" in line]
    assert not exchanges, plan


@pytest.mark.parametrize("name", ["transfer_core_dfsp", "transfer_core_hub", "txn_reconciliation"])
def test_time_range_reaches_the_scan(spark, sf_dir, name):
    plan = plan_of(QUERIES[name](spark, sf_dir))
    pushed = [line for line in plan.splitlines() if line.startswith("PushedFilters") and "createdDate" in line]
    assert any("GreaterThanOrEqual(createdDate" in line for line in pushed)
