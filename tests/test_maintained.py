"""Revenue by added and subtracted sums equals the full build."""

import random
from datetime import date

import pytest
from pyspark.sql import functions as F
from util import frame

from erpspark.operators.upsert import replace_by_key
from erpspark.plans import maintained, sales
from erpspark.plans.calendar import date_dim

ORDERS = (
    "order_id bigint, customer_key bigint, id_branch bigint, order_date_key int, order_date date, is_cancel int, grand_total decimal(22,4), "
    "total_cost decimal(22,4), total_tax decimal(22,4), total_discount_percent decimal(22,4), total_discount_direct decimal(22,4)"
)
ITEMS = (
    "order_item_id string, order_id bigint, product_key bigint, quantity decimal(18,4), total_amount decimal(22,4), "
    "quantity_delivery decimal(18,4), quantity_not_delivery decimal(18,4), quantity_returned decimal(18,4)"
)
CUSTOMERS = (
    "customer_key bigint, customer_code string, representative string, company string, city string, type_client string, "
    "price_group_code string, price_group_name string, vip_rating int"
)
MEASURES = ["order_count", *maintained.SUMS, "avg_order_value", "gross_margin_pct", "revenue_adjustment"]


def _order(rng, i, customers=4):
    day = date(2024, rng.randint(1, 6), rng.randint(1, 3))
    money = [None if rng.random() < 0.1 else rng.randint(0, 400) for _ in range(5)]
    return (i, rng.choice([None, *range(1, customers)]), rng.choice([None, 1]), day.year * 10000 + day.month * 100 + day.day, day, int(rng.random() < 0.2), *money)


def _item(rng, i, orders):
    return (f"i{i}", rng.randrange(orders), rng.choice([None, 1, 2]), rng.choice([0, 1, 2, None]), rng.choice([0, 5, 50, 500, None]), 1, 1, 0)


def _rows(df):
    return {tuple(r[c] for c in maintained.GRAIN): tuple(None if r[c] is None else round(float(r[c]), 6) for c in MEASURES) for r in df.collect()}


@pytest.fixture
def dims(spark):
    return frame(spark, CUSTOMERS, [(k, f"c{k}", None, None, "x", "B", "g", "G", 1) for k in range(1, 4)]), date_dim(spark, date(2024, 1, 1), date(2024, 12, 31))


@pytest.mark.parametrize("seed", [1])
def test_loads_equal_a_full_build(spark, database, dims, seed):
    rng = random.Random(seed)
    sums = maintained.RevenueSums(spark, f"{database('sums')}.revenue")
    items = frame(spark, ITEMS, [_item(rng, i, 20) for i in range(60)])
    orders = frame(spark, ORDERS, [_order(rng, i) for i in range(18)])  # orders 18 and 19 come late
    sums.build(items, orders)
    for load in (1, 2):
        picked = rng.sample(range(26), 5) + [18 + load - 1]
        new_orders = frame(spark, ORDERS, [_order(rng, i) for i in picked])
        # lines change, move to other orders, come anew
        new_items = frame(spark, ITEMS, [_item(rng, i, 26) for i in rng.sample(range(80), 8)])
        for _ in range(3 - load):  # a call that broke off is repeated
            sums.apply(load, items, orders, new_items, new_orders)
        items = spark.createDataFrame(replace_by_key(items, new_items, "order_item_id").collect(), items.schema)
        orders = spark.createDataFrame(replace_by_key(orders, new_orders, "order_id").collect(), orders.schema)
        want = _rows(sales.revenue(items, orders, *dims))
        assert _rows(sums.mart(*dims)) == want
        sums.apply(load, items, orders, new_items, new_orders)  # replay: the facts hold it already
        assert _rows(sums.mart(*dims)) == want
    sums.compact(9)
    assert _rows(sums.mart(*dims)) == want
    assert [r[0] for r in spark.table(sums.table).select("load").distinct().collect()] == [9]


def test_only_touched_orders_count(spark):
    """A new price of January makes March's line of the same customer and product a spike; other customers stay out."""
    day = lambda m: (20240000 + m * 100 + 1, date(2024, m, 1))
    orders = frame(spark, ORDERS, [(i, c, 1, *day(m), 0, 100, 10, 0, 0, 0) for i, c, m in [(1, 1, 1), (2, 1, 3), (3, 2, 3), (4, 1, 5)]])
    lines = [(f"i{i}", i, p, 1, a, 1, 0, 0) for i, p, a in [(1, 7, 50), (2, 7, 100), (3, 7, 100), (4, 8, 100)]]
    items = frame(spark, ITEMS, lines)
    change = maintained.revenue_change(items, orders, frame(spark, ITEMS, [("i1", 1, 7, 1, 10, 1, 0, 0)]), orders.limit(0))
    got = {(r["order_date_key"], r["customer_key"]): (r["orders"], float(r["s_revenue"]), r["s_spike_line_count"]) for r in change.collect()}
    assert got == {(20240101, 1): (0, -40.0, 0), (20240301, 1): (0, -90.0, 1)}


def test_stored_lines_are_evaluated_once(spark):
    """A load costs one pass over the stored lines, however many steps look for neighbours."""
    rng = random.Random(5)
    seen = spark.sparkContext.accumulator(0)

    def counted(_):
        seen.add(1)
        return True

    count = F.udf(counted, "boolean").asNondeterministic()
    items = frame(spark, ITEMS, [_item(rng, i, 20) for i in range(60)])
    orders = frame(spark, ORDERS, [_order(rng, i) for i in range(18)])
    new_items, new_orders = frame(spark, ITEMS, [_item(rng, i, 20) for i in (1, 70)]), frame(spark, ORDERS, [_order(rng, 3)])
    got = maintained.revenue_change(items.filter(count("order_item_id")), orders, new_items, new_orders).collect()
    assert seen.value == 60
    assert got


def test_empty_batch(spark, database, dims):
    rng = random.Random(3)
    items, orders = frame(spark, ITEMS, [_item(rng, i, 5) for i in range(9)]), frame(spark, ORDERS, [_order(rng, i) for i in range(5)])
    sums = maintained.RevenueSums(spark, f"{database('sums')}.revenue")
    sums.build(items, orders)
    sums.apply(1, items, orders, items.filter(F.lit(False)), orders.filter(F.lit(False)))
    assert _rows(sums.mart(*dims)) == _rows(sales.revenue(items, orders, *dims))
