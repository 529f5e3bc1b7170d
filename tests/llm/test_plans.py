"""Plans of the registered operators: no cross joins, and no Python in the native one."""

import os

import pytest

from flowtables.llm import queries

SF_DIR = "/root/testdata/sf0.001"
# Operators that end with a plan over their whole table; the others return what they staged.
PLANNED = ["op2_url_filter", "op4_toxicity", "op6_packing", "op8_license_scan", "op9_decontamination"]

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="driver tables are not here")


@pytest.mark.parametrize("name", PLANNED)
def test_no_cross_join(spark, name):
    plan = queries.QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"):
        assert bad not in plan, bad
    if name == "op2_url_filter":
        assert "Python" not in plan and "Arrow" not in plan
