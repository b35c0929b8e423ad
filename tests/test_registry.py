import pytest

import __spark_entry__ as contract
from conftest import SMALL
from workbench import compare
from workbench.oracles import ORACLES
from workbench.registry import QUERIES


@pytest.fixture(scope="module")
def db():
    return compare.connect(SMALL)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(contract.queries()) and set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    assert contract.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, db, name):
    assert compare.differences(name, spark, SMALL, db) == []
