"""Plans keep the shape that matters at scale."""

import re
from datetime import date

import pytest

import __spark_entry__ as entry
from strata.operators import conform, lab, star
from strata.plans.lab_queries import line_sales
from strata.plans.staging import Staging
from tests.conftest import SMALL, plan_text


@pytest.fixture(scope="module")
def staging(spark):
    return Staging(spark, SMALL)


def scan_of(plan: str, column: str) -> str:
    return next(line for line in plan.splitlines() if "FileScan" in line and column in line)


def test_range_filter_reaches_the_scan(staging):
    scan = scan_of(plan_text(lab.month_by_range(line_sales(staging), 1998, 6)), "l_shipdate")
    assert "GreaterThanOrEqual(l_shipdate" in scan and "LessThanOrEqual(l_shipdate" in scan
    wrapped = scan_of(plan_text(lab.month_by_functions(line_sales(staging), 1998, 6)), "l_shipdate")
    assert "GreaterThanOrEqual" not in wrapped


def test_only_needed_columns_are_read(staging):
    scan = scan_of(plan_text(lab.full_scan(line_sales(staging))), "l_returnflag")
    assert "ReadSchema: struct<l_extendedprice:double,l_returnflag:string>" in scan


def test_newest_version_cuts_groups_before_the_shuffle(staging):
    plan = plan_text(conform.newest_version(staging.orders, "customer_id"))
    before, after = plan.split("Exchange", 1)
    assert "WindowGroupLimit" in before and "WindowGroupLimit" in after


def test_fact_moves_lines_once(staging):
    customers = star.customer_dimension(staging.customer_history)
    products = star.product_dimension(staging.products)
    plan = plan_text(star.sales_fact(staging.lines, staging.orders, customers, products))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_gold_shuffles(spark):
    for name, most in (("fact_sales", 9), ("agg_daily_revenue", 9), ("revenue_by_brand_segment", 9)):
        assert plan_text(entry.queries()[name](spark, SMALL)).count("Exchange hashpartitioning") <= most, name


def test_no_query_crosses_or_loops(spark):
    heavy = ("layout_", "stream_", "rescued", "rows_per_source", "version", "restore", "update_where",
             "delete_where", "rebuild", "retention", "feed_range", "per_commit", "_followed")
    for name, build in entry.queries().items():
        if any(word in name for word in heavy) or re.match(r"op\d+_|pipeline$", name):
            continue  # corpus queries have tests of their own
        plan = plan_text(build(spark, SMALL))
        assert "CartesianProduct" not in plan, name
        assert "BroadcastNestedLoopJoin" not in plan, name
        assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan, name


def test_promotion_join_is_an_equality_on_region_and_day(spark, staging):
    from strata.plans.lab_queries import lab_promotions, order_sales

    plan = plan_text(lab.promoted(order_sales(staging), lab_promotions(staging), date(1998, 3, 1), date(1998, 3, 31)))
    join = next(line for line in plan.splitlines() if "Join" in line)
    assert join.count("region") == 2 and join.count("sale_date") == 2
