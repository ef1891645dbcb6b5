"""Every query with an SQL form equals it."""

import pytest

from riskline.llm.catalog import entries
from tests.llm.helpers import compare
from tests.oracle_harness import duck_conn

KEYS = sorted(k for k, e in entries().items() if e.oracle)


@pytest.fixture(scope="module")
def con(sf):
    return duck_conn(sf)


@pytest.mark.parametrize("key", KEYS)
def test_sql(spark, con, sf, key):
    compare(spark, con, entries()[key], sf)
