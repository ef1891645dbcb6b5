"""Every key with an SQL form equals its DuckDB oracle (sf0.001 here; the driver checks
sf0.01). Keys without an SQL form must at least run."""

import os

import pytest

from riskline.plans.catalog import entries
from tests.oracle_harness import compare, duck_conn

SF = os.environ.get("RISKLINE_TEST_SF", "/root/testdata/sf0.001")
KEYS = sorted(entries())


@pytest.fixture(scope="module")
def con():
    return duck_conn(SF)


@pytest.mark.parametrize("key", KEYS)
def test_key(spark, con, key):
    r = compare(spark, con, key, SF)
    assert r["status"] in ("MATCH", "rows-only"), r
