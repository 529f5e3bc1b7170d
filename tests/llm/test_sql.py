"""The queries of this folder that have SQL, against it."""

import os

import pytest

from flowtables.llm import queries
from tests.oracle import compare, duck

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="driver tables are not here")


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


@pytest.mark.parametrize("name", list(queries.ORACLES))
def test_query_matches_sql(spark, con, name):
    result = compare(spark, con, SF_DIR, name, queries.QUERIES[name], queries.ORACLES[name])
    assert result["ok"], result["why"]
