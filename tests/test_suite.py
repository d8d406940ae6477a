"""Every registered query against its SQL, on whole tables."""

import pytest

from compare import duck, duck_rows, spark_rows
from suite.oracles import ORACLES
from suite.queries import QUERIES


@pytest.fixture(scope="module")
def connection(sf_dir):
    return duck(sf_dir)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_its_sql(spark, sf_dir, connection, name):
    expected_columns, expected = duck_rows(connection, ORACLES[name])
    columns, rows = spark_rows(QUERIES[name](spark, sf_dir))
    assert columns == expected_columns
    assert len(rows) == len(expected)
    assert rows == expected
    assert rows


def test_every_query_has_sql():
    assert set(ORACLES) == set(QUERIES)
