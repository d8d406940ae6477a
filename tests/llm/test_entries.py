"""Registered queries that SQL can express, against DuckDB."""

import pytest
from compare import duck, duck_rows, spark_rows
from lakejobs.llm.entries import ORACLES, QUERIES


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_equals_its_sql(spark, sf_dir, name):
    columns, rows = spark_rows(QUERIES[name](spark, sf_dir))
    expected_columns, expected = duck_rows(duck(sf_dir), ORACLES[name])
    assert columns == expected_columns and rows == expected and rows
