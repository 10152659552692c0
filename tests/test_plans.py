"""What the registered queries' plans may and may not hold."""

import re

import pytest

from starmart.plans.arrivals import clean_arrivals, clean_demographic, clean_temperature
from starmart.queries import QUERIES, shapes

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def plans(spark):
    return {
        name: run(spark, SF_DIR)._jdf.queryExecution().executedPlan().toString() for name, run in QUERIES.items()
    }


def test_no_python_in_any_plan(plans):
    assert [n for n, p in plans.items() if re.search(r"Python|Pandas|Arrow", p)] == []


def test_no_pairing_of_all_rows(plans):
    assert [n for n, p in plans.items() if re.search(r"CartesianProduct|NestedLoopJoin", p)] == []


def test_only_totals_go_to_a_single_task(plans):
    """What is gathered in one partition is already down to one row per task."""
    for name, plan in plans.items():
        lines = plan.splitlines()
        for i, line in enumerate(lines):
            if "Exchange SinglePartition" in line:
                assert "partial_" in lines[i + 1], name


def test_arrivals_are_cleaned_in_one_stage(spark):
    df = clean_arrivals(shapes.arrivals_raw(spark.read.parquet(f"{SF_DIR}/orders.parquet")))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


def test_scans_read_only_what_is_used(plans):
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int,l_quantity:double>" in plans["fact_scan"]
    assert "EqualTo(c_mktsegment,BUILDING)" in plans["filter_equals"]
    assert "ReadSchema: struct<l_orderkey:bigint>" in plans["star_counts"]


def test_top_rows_are_not_sorted_whole(plans):
    assert "TakeOrderedAndProject" in plans["top_rows"]


def test_items_are_counted_before_every_join(plans):
    plan = plans["star_counts"]
    assert plan.count("partial_count(1)") == 1 and plan.count("partial_sum(items") == 2


@pytest.mark.parametrize("name", ["customer", "events"])
def test_cleaning_shuffles_twice_at_most(spark, name):
    """Once to find equal rows, once to place the ids."""
    raw = {"customer": shapes.demographic_raw, "events": shapes.temperature_raw}[name]
    clean = {"customer": clean_demographic, "events": clean_temperature}[name]
    plan = clean(raw(spark.read.parquet(f"{SF_DIR}/{name}.parquet")))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == plan.count("Exchange") == 2


def test_all_code_lists_come_from_one_scan(plans):
    assert plans["code_lists"].count("FileScan") == 1
