"""Stock levels as steps: gaps, warehouses that begin and end apart, days before the first step."""

from datetime import date

from util import frame

from erpspark.plans import inventory, production

STRETCHES = "item_type string, item_key bigint, warehouse_key bigint, est decimal(22,0), first date, last date"


def _steps(spark):
    m = lambda n: date(2024, n, 1)
    rows = [
        ("product", 1, 1, 10, m(2), m(3)), ("product", 1, 2, 30, m(3), m(3)),  # both in March, none in April and May
        ("product", 1, 1, 8, m(6), m(7)), ("nvl", 1, 1, 99, m(1), m(9)),
    ]
    return inventory.product_levels(frame(spark, STRETCHES, rows))


def test_steps(spark):
    got = {(r["product_key"], r["month"].month): r["level"]["avg"] for r in _steps(spark).collect()}
    assert got == {(1, 2): 10.0, (1, 3): 20.0, (1, 4): None, (1, 6): 8.0, (1, 8): None}


def test_days_take_the_last_step(spark):
    days = [date(2024, m, d) for m, d in [(1, 31), (2, 1), (3, 15), (5, 2), (6, 1), (7, 31), (8, 1)]]
    key = lambda d: d.year * 10000 + d.month * 100 + d.day
    dates = frame(spark, "date_key int, full_date date, year int, month_num int, month_name string", [(key(d), d, d.year, d.month, "m") for d in days])
    sold = frame(spark, "delivery_date_key int, product_key bigint, quantity decimal(18,4), delivery_id bigint", [(key(d), p, 40, 1) for d in days for p in (1, 2)])
    stages = frame(spark, "active int, productions_orders_items_id bigint, stage_date_key int, number_face decimal(18,4), productions_orders_id bigint", [])
    items = frame(spark, "prod_item_id bigint, product_key bigint", [])
    products = frame(spark, "product_key bigint, product_code string, product_name string, type_products string, brand string", [(p, "c", "n", "t", "b") for p in (1, 2)])
    out = production.production_sales(stages, items, sold, _steps(spark), products, dates, date(2024, 1, 1), date(2024, 12, 31)).collect()
    assert len(out) == 14
    got = {(r["product_key"], r["full_date"].month): r["avg_stock_level"] for r in out}
    assert [got[1, m] for m in (1, 2, 3, 5, 6, 7, 8)] == [None, 10.0, 20.0, None, 8.0, 8.0, None]
    assert all(v is None for (p, _), v in got.items() if p == 2)
