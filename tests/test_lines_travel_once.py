"""What lies on the disks together: whole lines travel once, finished jobs leave nothing behind."""

from __future__ import annotations

import re
import time
from datetime import date
from types import SimpleNamespace

import pytest

from util import frame, rows
from erpspark.catalog import quality_queries
from erpspark.plans import production, sales
from erpspark.plans.calendar import date_dim
from erpspark.session import written

ORDERS = (
    "order_id bigint, order_date date, order_date_key int, year int, quarter int, month_num int, month_name string, id_branch int, customer_key bigint, "
    "customer_code string, customer_name string, price_group_name string, city string, is_cancel int"
)
ITEMS = "order_item_id string, order_id bigint, product_key bigint, price double, quantity decimal(18,4), total_amount decimal(18,4)"


@pytest.fixture
def shuffled_joins(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def _order(order_id, month, customer, cancelled=0):
    return order_id, date(2024, month, 1), 20240001 + 100 * month, 2024, 1, month, "m", 1, customer, f"C{customer}", "n", "g", "c", cancelled


def _shop(spark):
    orders = frame(
        spark, ORDERS,
        # the order 4 is listed twice, 5 is cancelled
        [_order(1, 1, 1), _order(2, 2, 1), _order(3, 2, 2), _order(4, 3, 1), _order(4, 3, 1), _order(5, 2, 1, 1), _order(6, 4, None), _order(None, 4, 1)],
    )
    lines = [
        ("a", 1, 7, 10, 1, 10), ("b", 2, 7, 40, 1, 40), ("c", 2, 7, 20, 2, 40), ("d", 3, 7, 40, 1, 40), ("e", 4, 7, 30, 1, 30),
        ("f", 5, 7, 99, 1, 99), ("g", 6, None, 5, 1, 5), ("h", None, 7, 5, 1, 5), ("i", 4, 8, 6, 0, 6), ("j", 9, 8, 6, 1, 6),
    ]
    return frame(spark, ITEMS, lines), orders


def _detail(spark):
    items, orders = _shop(spark)
    # the key 8 is listed twice
    products = frame(
        spark, "product_key bigint, product_code string, product_name string, type_products string, brand string",
        [(7, "P7", "n", "t", "b"), (8, "P8", "n", "t", "b"), (8, "P8", "n", "t", "b")],
    )
    return sales.order_items_detail(items, orders, products)


EXPECTED = [
    ("a", "C1", "P7", None, False), ("b", "C1", "P7", 10.0, True), ("c", "C1", "P7", 10.0, False), ("d", "C2", "P7", None, False),
    # its month before: 80 for 3, the order itself twice
    *[("e", "C1", "P7", 80 / 3, False)] * 2, ("g", "CNone", None, None, False), *[("i", "C1", "P8", None, False)] * 4,
]


def _checked(df):
    got = rows(df, "order_item_id", "customer_code", "product_code", "prev_month_unit_price", "is_price_spike")
    assert got == EXPECTED
    # six priced lines of live orders, that of the repeated order once: 5 10 20 30 40 40
    ((low, high),) = set(rows(df, "price_tier_p33", "price_tier_p67"))
    assert low == pytest.approx(16.5) and high == pytest.approx(33.5)


def test_detail_with_repeated_and_null_keys(spark, shuffled_joins):
    _checked(_detail(spark))


def test_detail_with_broadcast_products(spark):
    _checked(_detail(spark))


def _exchanges_of_lines(spark, df) -> int:
    text = spark._jvm.org.apache.spark.sql.api.python.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    return len(re.findall(r"\) Exchange\s*\nInput \[\d+\]: \[[^\]]*order_item_id", text))


def test_whole_lines_travel_to_their_orders_only(spark, shuffled_joins):
    assert _exchanges_of_lines(spark, _detail(spark)) == 1


def test_lines_are_grouped_where_their_orders_are(spark, shuffled_joins):
    items, orders = _shop(spark)
    brands = frame(spark, "product_key bigint, brand_id int", [(7, 1), (8, 2)])
    grouped = sales.decorate_lines(items, brands, "product_key", ["brand_id"])
    assert rows(grouped.filter("order_id IN (4, 6)"), "order_item_id", "brand_id") == [("e", 1), ("g", None), ("i", 2)]
    grouped = grouped.drop("product_key").withColumnRenamed("brand_id", "product_key")
    assert _exchanges_of_lines(spark, sales.order_items_detail(grouped, orders, None)) == 1


def test_purchases_are_done_before_plan_lines_travel(spark):
    cost = production.production_cost(
        frame(
            spark,
            "id string, productions_plan_id bigint, productions_plan_items_id string, item_type string, item_id bigint, item_code string, item_name string, "
            "unit_id bigint, quantity_single decimal(18,4), quantity decimal(18,4), quantity_compensation decimal(18,4), number_children_size decimal(18,4), is_zinc int",
            [("l", 1, "p", "materials", 5, "B5", "Giay 5", 1, 1, 2, 0, 1, 0)],
        ),
        frame(spark, "id string, productions_plan_id bigint, product_id bigint, quantity_total_details decimal(18,4)", [("p", 1, 7, 10)]),
        frame(spark, "id bigint, date date, options1_id string, status string", [(1, date(2024, 1, 1), "1", "F")]),
        frame(
            spark, "id string, id_purchase_order bigint, product_id bigint, price_suppliers double, quantity_unit decimal(18,4), total_suppliers decimal(18,4)",
            [("x", 1, 5, 1, 2, 6), ("y", 1, 9, 1, 1, 4)],
        ),
        frame(spark, "id bigint, date date", [(1, date(2023, 1, 1))]),
        frame(spark, "product_id bigint, product_name string, product_code string", [(5, "n", "c")]),
        frame(spark, "material_id bigint, material_key bigint, material_name string, material_code string", [(9, 10, "zinc", "z")]),
        date_dim(spark, date(2024, 1, 1), date(2024, 1, 31)), 9,
    )
    assert "total_suppliers" not in cost._jdf.queryExecution().optimizedPlan().toString()
    assert rows(cost, "bom_line_id", "npl_product_id", "npl_cost_vnd", "material_key") == [(None, 9, 4, 10), ("l", 5, 6, None)]


def test_tables_are_checked_one_after_the_other(spark):
    e = SimpleNamespace(one=spark.range(10).selectExpr("id % 4 AS id"), two=spark.range(3))
    checks = quality_queries._declared(e, {"a": ("one", "id", "id"), "b": ("two", "", "id")})
    assert "Exchange" not in checks._jdf.queryExecution().executedPlan().toString()
    assert rows(checks, "check_name", "subject", "status", "observed") == [("not_null", "a.id", "ok", 0), ("unique", "a.id", "fail", 4), ("unique", "b.id", "ok", 0)]


def test_a_written_job_leaves_no_shuffle_files(spark):
    def files() -> int:
        return spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks().toString().count("shuffle_")

    before = files()
    assert written(spark.range(1000).groupBy("id").count(), "counts").count() == 1000
    for _ in range(50):
        if files() <= before:
            break
        time.sleep(0.2)
    assert files() <= before
