"""Every catalog query against its SQL, and the shape of the contract."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
from glyphline.plans.registry import CATALOG
from oracle import compare, connect

NAMES = sorted(CATALOG)


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, sf_dir, con, name):
    result = contract.queries()[name](spark, sf_dir)
    sql = contract.oracle_sql().get(name)
    if sql is None:
        assert result.count() > 0
    else:
        assert compare(result, con, sql) is None


def test_entry(spark):
    assert contract.entry(spark).count() > 0


def test_every_query_has_sql():
    assert set(NAMES) <= set(contract.oracle_sql())
