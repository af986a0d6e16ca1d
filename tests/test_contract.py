"""Driver contract: every registered query against its SQL oracle."""

import pytest

import __spark_entry__ as entry
from shopfloor.plans import catalog, oracle
from shopfloor.plans.compare import compare, duckdb_connection

SF = "/root/testdata/sf0.001"
QUERIES = catalog.queries()  # optional operators have their own tests
ORACLE = oracle.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duckdb_connection(SF)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns[:3] == ["year", "month", "total_revenue"]


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    ok, msg = compare(QUERIES[name](spark, SF), con, ORACLE[name])
    assert ok, msg


def test_results_do_not_depend_on_session_time_zone(spark, con):
    """Event times are wall-clock values: a reader in another zone gets the
    same silver rows and monthly figures."""
    prev = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        for name in ("silver_fact_order_items", "revenue_monthly_from_events", "silver_customers"):
            ok, msg = compare(QUERIES[name](spark, SF), con, ORACLE[name])
            assert ok, f"{name}: {msg}"
    finally:
        spark.conf.set("spark.sql.session.timeZone", prev)
