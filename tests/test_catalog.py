import pytest
from oracle import compare, tables
from tracewright.plans import catalog


@pytest.fixture(scope="module")
def con():
    return tables("/root/testdata/sf0.01")


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, con, name):
    difference = compare(spark, con, catalog.QUERIES[name], catalog.SQL[name], "/root/testdata/sf0.01")
    assert difference is None, difference
