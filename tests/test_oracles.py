"""Every query with SQL agrees with it on the smallest tables; names and keys are in order."""

import duckdb
import pytest

import check
from __spark_entry__ import entry, oracle_sql, queries
from cityflow.catalog.oracles import ORACLES
from cityflow.catalog.queries import QUERIES


@pytest.fixture(scope="module")
def con(sf_dir):
    connection = duckdb.connect()
    for table in check.TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return connection


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(queries()) and set(ORACLES) <= set(oracle_sql())


def test_entry_runs(spark):
    assert entry(spark).count() == 5


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, con, sf_dir, name):
    outcome = check.compare(spark, con, sf_dir, name)
    assert outcome.startswith("ok"), outcome
