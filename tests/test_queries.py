"""Every registered query against its DuckDB oracle (sf0.001, and the driver's
sf0.01 for the core ones), the flagship entry, and plan properties."""

import pytest

import __spark_entry__ as E
from tests.conftest import SF_CHECK, SF_SMALL
from tripledger.plans.compare import compare, duckdb_connection
from tripledger.plans.oracles import ORACLES
from tripledger.plans.registry import QUERIES

CORE = ["classify_trips", "monthly_revenue", "hourly_passengers", "amount_distribution",
        "duplicate_summary", "implementations_agree"]


@pytest.fixture(scope="module")
def con_small():
    return duckdb_connection(SF_SMALL)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle_small(spark, con_small, name):
    r = compare(spark, name, E.queries()[name], E.oracle_sql()[name], SF_SMALL, con_small)
    assert r["columns_match"], r
    assert r["spark_rows"] == r["oracle_rows"], r
    assert r["values_match"], r


@pytest.mark.parametrize("name", CORE)
def test_core_query_matches_oracle_at_check_scale(spark, name):
    r = compare(spark, name, E.queries()[name], E.oracle_sql()[name], SF_CHECK)
    assert r["values_match"] and r["spark_rows"] == r["oracle_rows"], r


def test_every_query_has_oracle_or_is_listed():
    rows_only = {"landing_listing", "landing_fingerprint", "schema_probe", "ingest_decision",
                 "ingest_summary"}
    assert set(QUERIES) - set(ORACLES) == rows_only


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns[:2] == ["pickup_hour", "corridas"]
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {
    "partition_overwrite", "medallion_roundtrip", "unified_months", "ingest_decision",
    "ingest_summary", "profile_refresh"}))
def test_no_python_workers_in_plans(spark, name):
    plan = E.queries()[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    for node in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas",
                 "MapInPandas", "PythonUDF"):
        assert node not in plan, (name, node)
