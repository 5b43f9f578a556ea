"""Every modelling query against its DuckDB twin (the driver's gate)."""

import pytest

import __spark_entry__ as entry
from dimforge.plans.harness import compare, duckdb_connection
from dimforge.plans.registry import ORACLE, QUERIES

# the training-data queries are tested in tests/llm; not all of them have a twin


@pytest.fixture(scope="module")
def duck(sf_dir):
    return duckdb_connection(sf_dir)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["player_name", "is_active", "start_season", "end_season", "current_season"]
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, sf_dir, name):
    info = compare(spark, duck, name, QUERIES[name], ORACLE[name], sf_dir)
    assert info["ok"], info
