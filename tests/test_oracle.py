"""Every registered query against its DuckDB SQL at sf0.01 (the driver's gate)."""

import pytest

import __spark_entry__ as entry
from conftest import SF001, SF01
from oracle_check import compare, duck_connection

QUERIES = entry.queries()
SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return duck_connection(SF01)


def test_every_oracle_key_has_a_query():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_oracle(spark, duck, name):
    problems = compare(QUERIES[name](spark, SF01), duck, SQL[name])
    assert not problems, problems


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_rows_only_queries_run(spark, name):
    df = QUERIES[name](spark, SF001)
    assert df.count() > 0


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) == 150
    assert df.columns[:2] == ["customer_id", "first_name"]
    assert entry.entry(spark).schema == df.schema


def test_every_query_names_its_survey_ids():
    from tvlens.plans.catalog import SURVEY_IDS, all_queries

    assert set(SURVEY_IDS) == set(all_queries())
