"""Every registered query against its oracle on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry
from checks.run import compare, connect

SF = "/root/testdata/sf0.001"
QUERIES = dict(entry._registry().QUERIES)
ORACLES = dict(entry._registry().ORACLES)

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_names():
    assert set(ORACLES) <= set(QUERIES)
    assert set(QUERIES) <= set(entry.queries())
    assert set(ORACLES) <= set(entry.oracle_sql())


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["system", "time_bucket", "total", "error_count", "error_rate"]
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    status, _, _, note = compare(spark, con, SF, name, QUERIES[name], ORACLES.get(name))
    assert status in ("ok", "rows"), note
