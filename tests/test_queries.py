"""Every named query against its SQL, on the smallest tables."""

from pathlib import Path

import pytest

import __spark_entry__ as contract
from tests.oracle import compare, connect
from workload.registry import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="test tables are not here")


@pytest.fixture(scope="module")
def db():
    return connect(SF)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, db, name):
    assert compare(spark, db, name, contract.queries()[name], contract.oracle_sql()[name], SF) is None


def test_entry(spark):
    assert contract.entry(spark).columns == ["latitude", "longitude", "time", "value"]
