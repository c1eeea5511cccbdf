"""Every registered query against its expected SQL on the smallest driver tables."""

from __future__ import annotations

import pytest

from checks.compare import compare, duck
from checks.expected import EXPECTED
from checks.queries import QUERIES
from tests.conftest import SF


@pytest.fixture(scope="module")
def con():
    connection = duck(SF)
    yield connection
    connection.close()


def test_every_query_has_expected_sql():
    assert set(QUERIES) == set(EXPECTED)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    assert compare(spark, con, SF, QUERIES[name], EXPECTED[name]) == []
