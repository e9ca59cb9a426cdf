"""Every registered query against its SQL on the small tables."""

from __future__ import annotations

import pytest

from tests.compare import compare, connect
from tests.conftest import SF_DIR
from tidemark.catalog import all_queries

QUERIES, ORACLES = all_queries()


@pytest.fixture(scope="module")
def connection():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, connection, name):
    count, problem = compare(QUERIES[name](spark, SF_DIR), connection, ORACLES[name])
    assert not problem
    assert count > 0
