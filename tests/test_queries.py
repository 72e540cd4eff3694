"""Every sample query against the same query in DuckDB, on the smallest sample."""

import pytest

import __spark_entry__ as entry
from examples import registry
from tools.check_oracle import compare, connect

# The file round trips and whole pipelines have tests of their own.
SLOW = {
    "pipeline_incremental", "pipeline_full", "pipeline_two_drops", "bronze_twice", "stream_drop", "lake_roundtrip",
    "rf_predict", "stream_to_gold", "bronze_insert_counts", "ledger_lake_paths", "empty_run", "forest_cells",
}
# The corpus operators, which may be absent, are tested beside them.
OWN = registry.all_queries()
FAST = sorted(set(OWN) - SLOW)


@pytest.fixture(scope="module")
def duck(sf):
    return connect(sf)


def test_every_query_has_sql_or_a_reason():
    assert {name for name, query in OWN.items() if query.sql is None} == {"rf_predict"}
    assert set(OWN) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", FAST)
def test_query(spark, sf, duck, name):
    verdict, _, _ = compare(spark, duck, sf, entry.queries()[name], entry.oracle_sql()[name])
    assert verdict == "ok"


def test_entry(spark):
    found = entry.entry(spark)
    assert found.columns == ["year", "month", "avg_response_time_sec", "n_incidents"]
    assert found.count() > 0
