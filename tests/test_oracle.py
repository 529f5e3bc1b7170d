"""Every registered query against its SQL, and what the registry promises."""

import os

import pytest

import __spark_entry__ as driver
from tests.oracle import compare, duck

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
#: The training-data operators have tests of their own in tests/llm.
QUERIES, ORACLES = ({k: v for k, v in made.items() if k != "pipeline" and not (k.startswith("op") and k[2].isdigit())} for made in (driver.queries(), driver.oracle_sql()))

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="driver tables are not here")


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_sql(spark, con, name):
    result = compare(spark, con, SF_DIR, name, QUERIES[name], ORACLES.get(name))
    assert result["ok"], result["why"]


def test_every_query_has_sql():
    assert set(ORACLES) == set(QUERIES)


def test_entry(spark):
    df = driver.entry(spark)
    assert df.count() > 0 and len(df.columns) == len(set(df.columns))
