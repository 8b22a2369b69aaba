"""Every registered query against its SQL twin in DuckDB."""

import pytest
from conftest import SF_DIR
from oracle_check import connect, difference

from workload.oracle import ORACLE
from workload.queries import QUERIES


@pytest.fixture(scope="module")
def connection():
    return connect(SF_DIR)


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", QUERIES)
def test_query_matches_sql(spark, connection, name):
    assert difference(QUERIES[name](spark, SF_DIR), connection, ORACLE[name]) is None
