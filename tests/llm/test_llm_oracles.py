"""Registered queries against their DuckDB SQL, on the whole small tables."""

import pytest
from oracle import connect, duckdb_rows, spark_rows

from earshot.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, sf_dir, name):
    expected = duckdb_rows(connect(sf_dir), ORACLES[name])
    assert spark_rows(QUERIES[name](spark, sf_dir)) == expected
