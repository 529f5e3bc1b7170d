"""Shapes of the physical plans that matter on a large cluster."""

import os

import pytest

from flowtables.harness import all_queries

SF_DIR = "/root/testdata/sf0.001"
QUERIES = all_queries()
# Queries that run whole jobs: their result is a read of the table the job wrote.
JOBS = {"contacts_flow", "contact_acks_flow", "updates_from_files_flow", "updates_from_table_flow", "hires_flow", "monthly_loads", "late_invoices", "revenue_jobs_flow", "stream_autoingest", "stream_multiline"}

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="driver tables are not here")


def plan(spark, name):
    return QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - JOBS))
def test_no_cross_join_and_no_python(spark, name):
    text = plan(spark, name)
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "PythonUDF"):
        assert bad not in text, bad


@pytest.mark.parametrize("name", ["keep_latest", "keep_latest_per_month", "invoice_movement", "detail_lines", "row_hash_delta"])
def test_latest_rows_are_chosen_in_the_map_tasks(spark, name):
    text = plan(spark, name)
    exchange = text.index("Exchange hashpartitioning")
    assert "row_number(), 1, Partial" in text[exchange:] and "row_number(), 1, Final" in text


def test_items_are_summed_before_the_join(spark):
    text = plan(spark, "detail_lines")
    join = text.index("Join ")
    assert "partial_sum" in text[join:] and "partial_sum" not in text[:join]


def test_filters_and_columns_reach_the_scan(spark):
    assert "GreaterThanOrEqual(ts," in plan(spark, "watermark_delta")
    scans = [line for line in plan(spark, "merge_insert_only").splitlines() if "FileScan" in line]
    assert all("value" not in line and "PushedFilters: [" in line for line in scans)
    scans = [line for line in plan(spark, "profile_by_system").splitlines() if "FileScan" in line]
    assert len(scans) == 1 and "l_partkey" not in scans[0]


def test_top_rows_are_not_a_full_sort(spark):
    assert "TakeOrderedAndProject" in plan(spark, "recent_top_n")


def test_union_needs_no_shuffle(spark):
    assert "Exchange" not in plan(spark, "conform_union")


def test_target_of_a_small_merge_is_not_shuffled(spark):
    text = plan(spark, "merge_upsert")
    first = text.split("LeftAnti")[0]
    assert "LeftOuter, BuildRight" in first and "Exchange hashpartitioning" not in first
