"""Every registered query against its SQL on the smallest data, and no pairwise join in any plan."""

import pytest
from compare import connect, differences

from motorledger.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_agrees_with_sql(spark, con, name):
    query = QUERIES[name]
    assert query.sql is not None
    problem, _, _ = differences(spark, con, query, FOLDER)
    assert problem is None, problem
