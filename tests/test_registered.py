"""Every registered query against its SQL on the smallest tables."""

from pathlib import Path

import pytest

from checks.compare import compare, connect
from checks.oracle import ORACLE
from checks.queries import QUERIES

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(DATA).is_dir(), reason="driver tables are not here")


@pytest.fixture(scope="module")
def connection():
    return connect(DATA)


def test_every_query_has_sql():
    assert set(ORACLE) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, connection, name):
    ok, line = compare(spark, connection, name, DATA)
    assert ok, line
