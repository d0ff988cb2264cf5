"""Month-end stock: stretches meet items and warehouses before they become months."""

from __future__ import annotations

from datetime import date

import pytest

from util import frame, rows
from erpspark.plans import inventory

LOTS = (
    "product_key bigint, material_key bigint, warehouse_key bigint, import_date_key int, quantity decimal(18,4), quantity_left decimal(18,4), type_items string"
)
EXPORTS = "product_key bigint, material_key bigint, warehouse_key bigint, export_date_key int, quantity decimal(18,4), type_items string"
SNAPSHOT = "item_type string, product_key bigint, material_key bigint, quantity_left decimal(18,4), stock_value decimal(28,2)"


def _monthly(spark):
    lots = frame(spark, LOTS, [(1, None, 1, 20190101, 9, 9, "product"), (2, None, 9, 20240210, 5, 5, "product"), (None, 4, 1, 20190101, 10, 2, "nvl")])
    exports = frame(spark, EXPORTS, [(None, 4, 1, 20240205, 8, "nvl")])
    snapshot = frame(spark, SNAPSHOT, [("product", 1, None, 9, 18), ("nvl", None, 4, 2, None)])
    # the product 1 is listed twice, the product 2 is unknown
    products = frame(spark, "product_key bigint, product_code string, product_name string, unit_id int, type_products string", [(1, "A", "a", 1, "goods"), (1, "B", "b", 1, "goods")])
    materials = frame(spark, "material_key bigint, material_code string, material_name string, unit_id int, npl_type string", [(4, "M", "m", 2, "Decal")])
    warehouses = frame(spark, "warehouse_key bigint, warehouse_code string, warehouse_name string, is_virtual boolean", [(1, "W", "w", False)])
    return inventory.stock_monthly(lots, exports, snapshot, products, materials, warehouses, date(2024, 1, 1), date(2024, 4, 20))


def test_values(spark):
    out = _monthly(spark)
    got = rows(out, "month_end", "item_code", "warehouse_code", "est_qty_end_month", "est_value_end_month", "is_valued", "net_movement")
    ends = [date(2024, 1, 31), date(2024, 2, 29), date(2024, 3, 31)]
    want = [(d, c, "W", 9, 18, True, 0) for d in ends for c in "AB"]
    want += [(d, "M", "W", 10 if d == ends[0] else 2, None, False, -8 if d == ends[1] else 0) for d in ends]
    want += [(d, None, None, 5, None, False, 5 if d == ends[1] else 0) for d in ends[1:]]
    assert sorted(got, key=str) == sorted(want, key=str)


@pytest.fixture
def shuffled_joins(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_months_are_made_last(spark, shuffled_joins):
    """No month travels: the stretches are expanded above every exchange."""
    plan = _monthly(spark)._jdf.queryExecution().executedPlan().toString()
    months = next(i for i, line in enumerate(plan.split("\n")) if "explode(sequence" in line)
    assert not any("Exchange" in line or "Join" in line for line in plan.split("\n")[:months])
