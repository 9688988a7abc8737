"""Every query against its SQL on the smallest scale."""

import os

import pytest
from oracle_check import connect, difference

import __spark_entry__ as entry

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, duck, name):
    got = entry.queries()[name](spark, SF).toPandas()
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert len(got)
    else:
        assert difference(got, duck.execute(sql).df()) is None


def test_entry(spark):
    assert entry.entry(spark).columns == ["model", "date", "ret"]
