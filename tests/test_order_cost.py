"""Allocation of plan costs: where the rows travel, and what an order without a matching line gets."""

from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from util import frame, rows
from erpspark.plans import kpi, production

COST = (
    "productions_plan_id bigint, source_order_ids string, finished_product_id bigint, productions_plan_items_id string, npl_cost_vnd decimal(18,0), "
    "waste_cost_per_order_vnd decimal(18,0), npl_cost_with_waste_vnd decimal(18,0), has_price boolean"
)
ORDERS = (
    "order_id bigint, reference_no string, date_created date, is_cancel int, grand_total decimal(18,4), total_quantity decimal(18,4), status string, "
    "status_payment string, is_end int, currencies int"
)


def _order_cost(spark):
    cost = frame(spark, COST, [(1, "1,2", 7, "a", 100, 0, 100, True), (1, "1,2", 7, "b", 50, 5, 55, False), (2, "2,3", 8, "c", 40, 0, 40, True)])
    orders = frame(
        spark, ORDERS,
        [(o, f"SO-{o}", date(2024, 1, o), int(o == 3), 10 * o, o, "N", "P", 0, 5) for o in (1, 2, 3)],
    )
    items = frame(spark, "order_id bigint, product_key bigint, quantity decimal(18,4)", [(1, 70, 3), (2, 70, 1), (3, 80, 9)])
    # the key 70 is listed twice
    products = frame(spark, "product_key bigint, product_id bigint", [(70, 7), (70, 7), (80, 8)])
    return production.order_cost(cost.repartition("productions_plan_id"), orders, items, products, {})


def test_orders_without_a_matching_line_keep_their_counts_only(spark):
    got = rows(_order_cost(spark), "order_id", "allocated_npl_total_vnd", "linked_plan_count", "revenue_vnd", "total_bom_items", "npl_quality")
    assert got == [
        (1, 116, 1, 10, 4, "suspect_data"),  # 2 x 3 / 8 of 155
        (2, 59, 2, 20, 5, "high_cost"),  # 2 x 1 / 8 of 155, and an equal half of 40
        (3, 20, 1, None, 1, "no_revenue"),  # cancelled
    ]


@pytest.fixture
def shuffled_joins(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_costs_stay_with_their_plan(spark, shuffled_joins):
    """Only the lines of the listed orders travel to the plans; neither costs nor entries are dealt out by plan and product."""
    plan = _order_cost(spark)._jdf.queryExecution().executedPlan().toString()
    keys = [line.split("hashpartitioning(", 1)[1] for line in plan.split("\n") if "Exchange hashpartitioning(productions_plan_id" in line]
    assert keys and all(k.count("#") == 1 for k in keys), keys


@pytest.mark.parametrize("report", [kpi.cost_quality_mix, kpi.regular_cost_percentiles])
def test_percentile_reports_build_the_costs_once(spark, report):
    built = spark.sparkContext.accumulator(0)

    def counted(_):
        built.add(1)
        return True

    costs = frame(
        spark,
        "order_id bigint, year int, npl_quality string, is_sample_order boolean, npl_materials_pct double, revenue_vnd decimal(18,4), "
        "allocated_npl_materials_vnd decimal(18,0)",
        [(1, 2024, "normal", False, 10, 100, 10), (2, 2024, "normal", False, 30, 100, 30), (3, 2024, "normal", False, 80, 100, 80)],
    )
    seen = F.udf(counted, "boolean").asNondeterministic()
    (got,) = report(costs.filter(seen("order_id")), 2024).collect()
    assert built.value == 3
    assert got["orders"] == 3
    assert got["median_npl_pct" if "median_npl_pct" in got else "p50"] == 30.0
