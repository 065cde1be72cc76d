"""Every registered query against its SQL, at the smallest scale."""

import os

import pytest

import __spark_entry__ as contract
from check import difference

FOLDER = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


def test_every_query_has_sql():
    own = {name for module in (contract.catalog, contract.index, contract.register) for name in module.QUERIES}
    assert own <= set(contract.queries()) and own <= set(contract.oracle_sql())
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_query(spark, name):
    assert difference(contract.queries()[name](spark, FOLDER), FOLDER, contract.oracle_sql()[name]) is None


def test_entry(spark):
    result = contract.entry(spark)
    assert result.columns == ["domain", "status", "captures", "bytes"] and result.count() > 0
