"""Purchases: where the lines travel, and lines that name no product."""

from __future__ import annotations

from datetime import date

import pytest

from util import frame, rows
from erpspark.plans import finance

LINES = (
    "po_id bigint, po_date_key int, supplier_key bigint, product_key bigint, quantity decimal(18,4), quantity_suppliers decimal(18,4), "
    "total_expected decimal(18,4), total_suppliers decimal(18,4), subtotal decimal(18,4)"
)


def _purchases(spark):
    lines = frame(spark, LINES, [
        (1, 20240101, 1, 1, 2, 2, 11, 10, 10), (1, 20240101, 1, 1, 1, 1, 6, 5, 5), (2, 20240101, 1, 1, 1, 1, 6, 5, 5),
        (3, 20240101, 1, None, 4, 4, 9, 8, 8), (4, 20240101, 1, None, 4, 4, 9, 8, 8), (5, 20240101, None, 7, 1, 1, 1, 1, 1),
    ])
    # the product 1 is listed twice, the product 7 is unknown; a row without a key is no product of the lines without one
    products = frame(
        spark, "product_key bigint, product_code string, product_name string, type_products string, category_id int, brand string, price_import decimal(18,4)",
        [(1, "A", "a", "goods", 1, "x", 5), (1, "B", "b", "goods", 1, "x", 6), (None, "N", "n", "goods", 1, "x", 7)],
    )
    suppliers = frame(spark, "supplier_key bigint, supplier_code string, company string, city string, groups_in string", [(1, "S", "s", "c", "g")])
    dates = frame(
        spark, "date_key int, full_date date, year int, quarter int, month_num int, month_name string", [(20240101, date(2024, 1, 1), 2024, 1, 1, "Jan")],
    )
    return finance.purchase_cost(lines, suppliers, products, dates)


def test_values(spark):
    got = rows(_purchases(spark), "product_key", "product_code", "supplier_code", "po_count", "line_count", "qty_ordered", "actual_cost", "year", "std_import_price")
    assert got == [
        (None, None, "S", 2, 2, 8, 16, 2024, None),
        (1, "A", "S", 2, 3, 4, 20, 2024, 5), (1, "B", "S", 2, 3, 4, 20, 2024, 6),
        (7, None, None, 1, 1, 1, 1, 2024, None),
    ]


@pytest.fixture
def shuffled_joins(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_lines_with_a_product_travel_to_it_once(spark, shuffled_joins):
    plan = _purchases(spark)._jdf.queryExecution().executedPlan().toString()
    exchanges = [line.split("hashpartitioning(", 1)[1] for line in plan.split("\n") if "Exchange hashpartitioning(" in line]
    by_product = [e for e in exchanges if e.startswith("product_key#")]
    assert len(by_product) == 1 and "REPARTITION_BY_COL" in by_product[0], exchanges  # the sums do not travel again to be looked up
