"""Every registered query against its SQL on the smallest tables."""

import pytest
from oracle_check import compare, connect

from engagemart.oracle import ORACLE_SQL
from engagemart.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    pytest.importorskip("duckdb")
    return connect(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, connection, name):
    assert compare(spark, connection, name, QUERIES[name], ORACLE_SQL[name], SF) == ""
