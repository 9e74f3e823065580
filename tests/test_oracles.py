"""Every query gives the rows and types of its SQL oracle."""

import pytest

import __spark_entry__ as entry_point
from conftest import SMALL
from earshot.plans.catalog import QUERIES
from earshot.plans.oracles import ORACLES
from oracle import connect, duckdb_rows, spark_rows

TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}


@pytest.fixture(scope="module")
def tables():
    return connect(SMALL)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert QUERIES.items() <= entry_point.queries().items()
    assert ORACLES.items() <= entry_point.oracle_sql().items()


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_oracle(spark, tables, name):
    result = QUERIES[name](spark, SMALL)
    expected = duckdb_rows(tables, ORACLES[name])
    assert spark_rows(result) == expected
    assert expected[1], "an empty answer checks nothing"
    described = tables.execute(f"DESCRIBE {ORACLES[name]}").fetchall()
    assert {n: TYPES[t] for n, t in result.dtypes} == {row[0]: row[1] for row in described}


def test_entry_runs(spark):
    assert entry_point.entry(spark).count() == 5
