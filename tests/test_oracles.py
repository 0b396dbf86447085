"""Every registered query against its DuckDB oracle on the smallest driver tables."""

import pytest

from tests.conftest import SF_SMALL
from tests.oracle_check import compare, duck_connection
from tidemill.plans import registry

KEYS = sorted(registry.queries())


@pytest.fixture(scope="module")
def con():
    return duck_connection(SF_SMALL)


@pytest.mark.parametrize("key", KEYS)
def test_matches_oracle(spark, con, key):
    r = compare(spark, key, SF_SMALL, con)
    assert r.get("oracle", 1) is not None, "no oracle registered"
    assert r["cols_match"], r
    assert r["spark_rows"] == r["duck_rows"], r
    assert r["values_match"], r
