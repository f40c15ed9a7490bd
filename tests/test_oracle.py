"""Every trip query against its DuckDB oracle on the smallest tables."""
import pytest

import __spark_entry__ as E
from conftest import SF001
from oracle_check import compare, duck
from taxiframe.queries import REGISTRY

KEYS = sorted(REGISTRY)


@pytest.fixture(scope="module")
def con():
    return duck(SF001)


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, key):
    res = compare(spark, con, key, E.queries()[key], E.oracle_sql().get(key), SF001)
    assert res["status"] in ("ok", "rows-only"), res


def test_every_query_has_an_oracle():
    assert set(KEYS) <= set(E.oracle_sql()) and set(KEYS) <= set(E.queries())
    assert set(E.oracle_sql()) <= set(E.queries())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["geohash", "avg_tip"]
    assert df.count() == 10
