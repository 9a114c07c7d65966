"""The corpus queries against their SQL on the smallest tables."""

import os

import pytest

from checks.run import compare, connect
from opsgrain.llm import queries

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_one_query_per_operator():
    assert [n.split("_")[0] for n in queries.QUERIES if n.startswith("op")] == [f"op{i}" for i in range(1, 14)]
    assert "pipeline" in queries.QUERIES and None not in queries.ORACLES.values()


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query(spark, con, name):
    status, n, _, note = compare(spark, con, SF, name, queries.QUERIES[name], queries.ORACLES.get(name))
    assert status == ("ok" if name in queries.ORACLES else "rows"), note
    assert n > 0
