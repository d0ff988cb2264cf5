"""Branches of the marts on literal frames."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from erpspark.plans import finance, inventory, production, sales, shared
from util import frame, rows

ITEM = "order_item_id string, order_id bigint, customer_key bigint, product_key bigint, quantity decimal(22,4), total_amount decimal(22,4), price decimal(22,4)"
ORDER = "order_id bigint, customer_key bigint, order_date date, is_cancel int"


def _repaired(spark, lines, orders):
    return sales.repaired_lines(frame(spark, ITEM, lines), frame(spark, ORDER, orders))


def test_price_spike_branches(spark):
    orders = [
        (1, 1, date(2024, 1, 5), 0), (2, 1, date(2024, 3, 5), 0), (3, 1, date(2024, 4, 5), 0), (4, 1, date(2024, 5, 5), 0),
        (5, 1, date(2024, 2, 5), 1), (6, 1, date(2024, 6, 6), 0),
    ]
    lines = [
        ("first", 1, 1, 1, 1, 0.3, 1),  # no earlier month
        ("cancelled", 5, 1, 1, 1, 1000, 1),  # feeds nothing, is not repaired
        ("exact", 2, 1, 1, 1, 0.9, 1),  # gap month; exactly three times
        ("spike", 3, 1, 1, 2, 6.0, 1),  # 3.0 against 0.9
        ("zero_qty", 4, 1, 1, 0, 5, 1),
        ("free", 4, 1, 1, 5, 0, 1),
        ("after", 6, 1, 1, 1, 9.5, 1),  # last month with a price is April at 3.0
        ("other", 3, 1, None, 1, 50, 1),  # no product: nothing to compare with
    ]
    out = {r["order_item_id"]: r for r in _repaired(spark, lines, orders).collect()}
    assert [k for k, r in out.items() if r["is_price_spike"]] == ["spike", "after"] or {k for k, r in out.items() if r["is_price_spike"]} == {"spike", "after"}
    assert out["exact"]["prev_month_unit_price"] == pytest.approx(0.3)
    assert float(out["spike"]["total_amount_adjusted"]) == 1.8
    assert float(out["after"]["total_amount_adjusted"]) == 3.0
    assert out["first"]["prev_month_unit_price"] is None
    assert out["zero_qty"]["line_unit_price"] is None and out["zero_qty"]["total_amount_adjusted"] is None
    assert float(out["free"]["total_amount_adjusted"]) == 0.0
    assert not out["cancelled"]["__live"]


FULL = ORDER + (
    ", order_key bigint, reference_no string, order_date_key int, year int, quarter int, month_num int, month_name string, is_weekend boolean, customer_code string, customer_name string, "
    "city string, type_client string, price_group_name string, vip_rating int, id_branch int, employee_key bigint, grand_total decimal(22,4), total_cost decimal(22,4), is_end int, "
    "status string, status_orders string, type_orders string, type_bills string"
)


def _order(oid, total, cost, cancel=0):
    return (oid, 1, date(2024, 1, 5), cancel, oid, "r", 20240105, 2024, 1, 1, "January", False, "c", "n", "x", "B", "g", 1, 1, 1, total, cost, 1, "s", "s", "t", "b")


def test_order_performance_without_lines_zero_total_and_cancelled(spark):
    items = frame(
        spark, ITEM + ", quantity_delivery decimal(22,4), quantity_not_delivery decimal(22,4), quantity_returned decimal(22,4)",
        [("a", 1, 1, 1, 10, 80, 8, 4, 6, 0), ("b", 4, 1, 1, 10, 70, 7, 10, 0, 0)],
    )
    orders = frame(spark, FULL, [_order(1, 100, 50), _order(2, 40, 10), _order(3, 0, 10), _order(4, 90, 9, 1)])
    out = {r["order_id"]: r for r in sales.order_performance(items, orders).collect()}
    assert (float(out[1]["revenue"]), float(out[1]["cogs"]), float(out[1]["gross_profit"])) == (80, 40, 40)
    assert float(out[1]["fulfilment_rate_pct"]) == 40.0 and out[1]["is_fully_delivered"] == 0
    assert (float(out[2]["revenue"]), float(out[2]["cogs"]), out[2]["fulfilment_rate_pct"], out[2]["is_fully_delivered"]) == (40, 10, None, 1)
    assert (float(out[3]["revenue"]), float(out[3]["cogs"])) == (0, 10)
    # cancelled: quantities count, the lines do not change its value
    assert (float(out[4]["revenue"]), float(out[4]["qty_ordered"])) == (90, 10)


@pytest.mark.parametrize(
    "r, f, m, want",
    [
        (4, 4, 4, "Champions"), (3, 3, 1, "Loyal"), (5, 4, 3, "Loyal"), (4, 2, 5, "Promising"), (3, 2, 3, "Potential Loyalist"),
        (2, 3, 1, "At Risk"), (1, 2, 2, "Lost"), (3, 1, 1, "New"), (2, 1, 5, "New"), (3, 2, 2, "Others"),
    ],
)
def test_segment_rules(spark, r, f, m, want):
    df = spark.range(1).select(sales._segment(F.lit(r), F.lit(f), F.lit(m)).alias("s"))
    assert df.first()["s"] == want


def test_segmentation_inactive_and_customerless_orders(spark):
    orders = frame(
        spark, ORDER + ", grand_total decimal(22,4)",
        [(i, None if i == 0 else 1 + i % 5, date(2024, 1, 1 + i), 0, None if i == 3 else 10 * i) for i in range(12)] + [(99, 7, date(2024, 1, 9), 1, 5)],
    )
    cust = frame(
        spark,
        "customer_key bigint, customer_code string, representative string, company string, city string, type_client string, price_group_name string, vip_rating int, is_active boolean, datecreated date, "
        "debt_limit decimal(22,4), debt_limit_day int",
        [(k, f"c{k}", None, None, "x", "B", "g", 1, True, date(2020, 1, 1), 0, 0) for k in range(1, 8)],
    )
    out = {r["customer_key"]: r for r in sales.customer_segmentation(orders, cust, date(2024, 2, 1)).collect()}
    assert len(out) == 7 and None not in out
    assert (out[7]["rfm_segment"], out[7]["rfm_total_score"], out[7]["total_orders"]) == ("Inactive", 3, 0)
    assert out[1]["customer_name"] == "c1"
    # six groups share five tiles, the customerless one holds a place
    assert sorted(out[k]["recency_score"] for k in range(1, 6)) in ([1, 2, 3, 4, 5], [1, 1, 2, 3, 4], [2, 2, 3, 4, 5], [1, 2, 3, 4, 4])


def test_credit_status_edges(spark):
    revenue = frame(spark, "customer_key bigint, revenue decimal(22,4), order_date_key int, order_date date", [(k, v, 20240101, date(2024, 1, 1)) for k, v in ((1, 5), (2, 100), (3, 80), (4, 79), (6, 101))])
    cust = frame(
        spark,
        "customer_key bigint, customer_code string, representative string, company string, city string, type_client string, price_group_name string, vip_rating int, is_active boolean, datecreated date, "
        "phonenumber string, email string, debt_limit decimal(22,4), debt_limit_day int, time_payment int, discount decimal(22,4)",
        [(k, "c", None, None, "x", "B", "g", 1, True, None, "p", "e", lim, 0, 0, 0) for k, lim in ((1, None), (2, 100), (3, 100), (4, 100), (5, 100), (6, 100), (7, 0))],
    )
    out = {r["customer_key"]: (r["credit_status"], r["is_over_limit"]) for r in finance.customer_credit(revenue, cust).collect()}
    assert out == {
        1: ("No Limit Set", None), 2: ("Over Limit", 0), 3: ("Near Limit", 0), 4: ("Within Limit", 0), 5: ("Clear", 0), 6: ("Over Limit", 1), 7: ("No Limit Set", None),
    }


@pytest.mark.parametrize(
    "name, zinc, paper, kind",
    [
        ("Giấy Bristol", False, True, "Giay"), ("GIAY X", False, True, "Giay"), ("Decal Giay", False, True, "Decal"), ("Decal PVC", False, False, "Decal"),
        ("(không sử dụng)Giấy cũ", False, True, "Khac"), ("Dây Băng Giấy", False, True, "Khac"), ("uv ink", False, False, "Muc / UV"), ("Muc do", False, False, "Muc / UV"),
        ("Bao bi PE", False, False, "Bao bi"), ("Tui", False, False, "Bao bi"), ("Bang keo", False, False, "Bang keo / Dan"), ("Bang dinh dan", False, False, "Bang keo / Dan"),
        ("Hop 3 lop", False, False, "Vat tu dong goi"), ("vtdg x", False, False, "Vat tu dong goi"), ("Giay Kem", True, True, "Kem in"), ("Khac gi", False, False, "Khac"), (None, False, False, "Khac"),
    ],
)
def test_material_labels(spark, name, zinc, paper, kind):
    df = frame(spark, "n string, z boolean", [(name, zinc)])
    assert tuple(df.select(shared.is_paper(F.col("n")), shared.material_type(F.col("n"), F.col("z"))).first()) == (paper, kind)


LOT = (
    "stock_id string, product_key bigint, material_key bigint, warehouse_key bigint, location_key bigint, import_date_key int, quantity decimal(22,4), quantity_left decimal(22,4), "
    "quantity_export decimal(22,4), price decimal(22,4), type_items string"
)
PO = "po_item_id string, product_key bigint, material_key bigint, po_date_key int, price_suppliers double"


def test_valuation_ladder(spark):
    lots = [
        ("lot", 1, None, 1, 1, 20240101, 10, 10, 0, 200, "product"),  # 20 each
        ("cap", 1, None, 1, 1, 20240101, 1, 1, 0, 90000, "product"),
        ("three_d", 2, None, 1, 1, 20240101, 1, 1, 0, 90000, "product"),
        ("po", 3, None, 1, 1, 20240101, 10, 3, 0, None, "product"),
        ("po_goods", 4, None, 1, 1, 20240101, 10, 3, 0, 0, "product"),
        ("master", 5, None, 1, 1, 20240101, 10, 3, 0, None, "product"),
        ("zero_qty", 5, None, 1, 1, 20240101, 0, 0, 0, 100, "product"),
        ("nvl", None, 1, 1, 1, 20240101, 10, 2, 0, None, "nvl"),
        ("nvl_dear", None, 1, 1, 1, 20240101, 1, 1, 0, 70000, "nvl"),  # raw material is not capped
        ("odd", None, 1, 1, 1, 20240101, 10, 1, 0, None, "other"),  # price only from the material side
        ("none", None, None, None, 1, 20240101, 10, 1, 0, None, "product"),
    ]
    products = frame(
        spark, "product_key bigint, product_code string, product_name string, type_products string, brand string, unit_id int, price_import decimal(22,4)",
        [(1, "A", "a", "products", "b", 1, None), (2, "3D-B", "b", "products", "b", 1, None), (3, "C", "c", "semi_products", "b", 1, None), (4, "D", "d", "goods", "b", 1, None), (5, "E", "e", "products", "b", 1, 8)],
    )
    materials = frame(spark, "material_key bigint, material_code string, material_name string, unit_id int", [(1, "M", "m", 9)])
    warehouses = frame(spark, "warehouse_key bigint, warehouse_code string, warehouse_name string, id_branch int, is_virtual boolean", [(1, "W", "w", 1, False)])
    po = frame(spark, PO, [("1", 3, None, 20240101, 5), ("2", 3, None, 20240201, 7), ("3", 3, None, 20240301, 0), ("4", 4, None, 20240101, 6), ("5", 4, None, 20240101, 9), ("6", None, 1, 20240101, 4)])
    out = {r["stock_id"]: r for r in inventory.stock_snapshot(frame(spark, LOT, lots), po, products, materials, warehouses).collect()}
    got = {k: (r["unit_price"] and float(r["unit_price"]), r["unit_price_capped"] and float(r["unit_price_capped"]), r["stock_value"] is not None and float(r["stock_value"]), r["price_source"], r["value_note"], r["item_type"]) for k, r in out.items()}
    assert got["lot"] == (20, 20, 200, "lot_price", "lot_price", "product")
    assert got["cap"] == (90000, 50000, 50000, "lot_price", "lot_price", "product")
    assert got["three_d"] == (90000, 90000, 90000, "lot_price", "lot_price", "product")
    assert got["po"] == (7, 7, 21, "po_fallback", "po_fallback_outsourced", "product")
    assert got["po_goods"] == (9, 9, 27, "po_fallback", "po_fallback_material", "product")
    assert got["master"] == (8, 8, 24, "no_price", "product_master_fallback", "product")
    assert got["zero_qty"][:2] == (8, 8) and got["zero_qty"][3] == "lot_price"
    assert got["nvl"] == (4, 4, 8, "npl_po_fallback", "npl_po_fallback", "nvl")
    assert got["nvl_dear"] == (70000, 70000, 70000, "lot_price", "lot_price", "nvl")
    assert got["odd"] == (4, 50000, 50000, "npl_po_fallback", "unpriced_no_eln_receipt", "nvl")
    assert got["none"] == (None, None, False, "no_price", "unpriced_no_eln_receipt", "UNKNOWN")


def test_month_projection(spark):
    lots = [
        ("quiet", 1, None, 1, 1, 20190101, 9, 9, 0, None, "product"),  # received before the range: constant
        ("in", 2, None, 1, 1, 20240210, 5, 5, 0, None, "product"),
        ("now", 3, None, 1, 1, 20240402, 4, 4, 0, None, "product"),  # move in the running month is not reversed
        ("out", None, 4, 1, 1, 20190101, 10, 2, 8, None, "nvl"),
        ("less", 5, None, 1, 1, 20240315, 7, 3, 4, None, "product"),  # 3 - 7 before March: dropped
        ("nowhere", 6, None, None, 1, 20190101, 9, 9, 0, None, "product"),
        ("semi", 7, None, 1, 1, 20190101, 9, 9, 0, None, "semi"),
    ]
    exports = frame(
        spark, "export_id string, product_key bigint, material_key bigint, warehouse_key bigint, export_date_key int, quantity decimal(22,4), type_items string",
        [("x", None, 4, 1, 20240205, 8, "nvl"), ("gone", 8, None, 1, 20240310, 6, "product")],
    )
    out = inventory.month_end_quantities(frame(spark, LOT, lots), exports, date(2024, 1, 1), date(2024, 4, 20))
    got = {}
    for r in out.collect():
        key = r["product_key"] or -r["material_key"]
        got.setdefault(key, {})[r["month_end"].month] = (float(r["est_qty_end_month"]), float(r["inbound_this_month"]), float(r["outbound_this_month"]))
    assert got == {
        1: {1: (9, 0, 0), 2: (9, 0, 0), 3: (9, 0, 0)},
        2: {2: (5, 5, 0), 3: (5, 0, 0)},
        3: {1: (4, 0, 0), 2: (4, 0, 0), 3: (4, 0, 0)},
        -4: {1: (10, 0, 0), 2: (2, 0, 8), 3: (2, 0, 0)},
        5: {3: (3, 7, 0)},
        8: {1: (6, 0, 0), 2: (6, 0, 0)},
    }


@pytest.mark.parametrize(
    "kind, product, sub, want",
    [
        ("OUTBOUND", 1, "1", "Sales"), ("OUTBOUND", 1, "17", "Internal Transfer"), ("OUTBOUND", 1, "2", "Loss/Return"), ("OUTBOUND", 1, "4", "Loss/Return"),
        ("OUTBOUND", 1, "UNKNOWN", "Production Consumption/Other"), ("INBOUND", 1, "product", "Production Output"), ("INBOUND", None, "product", "Purchase/Other Inbound"),
        ("INBOUND", 1, "buy", "Purchase/Other Inbound"),
    ],
)
def test_movement_purpose(spark, kind, product, sub, want):
    df = frame(spark, "movement_type string, product_key bigint, movement_subtype string", [(kind, product, sub)])
    assert df.select(inventory.movement_purpose()).first()[0] == want


def test_blank_subtypes(spark):
    lots = frame(spark, LOT, [(str(i), 1, None, 1, 1, 20240101, 1, 1, 0, None, k) for i, k in enumerate(["", "  ", None, " a "])])
    exports = frame(spark, "product_key bigint, warehouse_key bigint, export_date_key int, quantity decimal(22,4), type_export string", [(1, 1, 20240101, None, "17 ")])
    assert rows(inventory.movements(lots, exports), "movement_type", "movement_subtype", "quantity_in", "quantity_out", "transaction_count") == [
        ("INBOUND", "UNKNOWN", 3, 0, 3), ("INBOUND", "a", 1, 0, 1), ("OUTBOUND", "17", 0, 0, 1),
    ]


def _shares(spark, plan_cost, lines):
    cost = frame(
        spark,
        "productions_plan_id bigint, source_order_ids string, finished_product_id bigint, productions_plan_items_id bigint, npl_cost_vnd decimal(22,0), waste_cost_per_order_vnd decimal(22,0), "
        "npl_cost_with_waste_vnd decimal(22,0), has_price boolean",
        plan_cost,
    )
    order_lines = frame(spark, "order_id bigint, finished_product_id bigint, product_qty decimal(22,4), revenue_vnd decimal(30,5)", lines)
    return rows(production.allocate_to_orders(cost, order_lines), "productions_plan_id", "order_id", "alloc_ratio")


def test_allocation_fallbacks(spark):
    cost = [(p, ids, 1, 1, 100, 10, 110, True) for p, ids in ((1, "1, 2,3"), (2, "4,5"), (3, "6,7, ,"), (4, None), (5, ""))]
    lines = [(1, 1, 30, 5), (2, 1, 10, 5), (4, 1, 0, 30), (5, 1, 0, 10)]
    assert _shares(spark, cost, lines) == [
        (1, 1, 0.75), (1, 2, 0.25), (1, 3, None),  # by quantity; order 3 has no such line
        (2, 4, 0.75), (2, 5, 0.25),  # by revenue
        (3, 6, 0.5), (3, 7, 0.5),  # equally
    ]


def test_allocation_conserves_cost(spark):
    cost = [(p, f"{p},{p + 1},{p + 2}", 1, 1, 997, 10, 1007, True) for p in range(1, 20)]
    lines = [(o, 1, o * 7 % 11 + 1, 100) for o in range(1, 23)]
    shares = {}
    for plan, _, ratio in _shares(spark, cost, lines):
        shares[plan] = shares.get(plan, 0) + ratio
    assert all(abs(v - 1) < 1e-12 for v in shares.values()) and len(shares) == 19


def test_efficiency_uses_active_stages_and_repeats_order_totals(spark):
    items = frame(
        spark, "prod_item_id bigint, productions_orders_id bigint, product_key bigint, prod_date_key int, quantity decimal(22,4)",
        [(1, 1, 1, 20240101, 10), (2, 1, 1, 20240101, 0), (3, 2, 1, 19000101, 5)],
    )
    stages = frame(
        spark, "productions_orders_id bigint, stage_date_key int, staff_key bigint, number decimal(22,4), number_hours decimal(22,4), total_time decimal(22,4), number_face decimal(22,4), "
        "number_operations decimal(22,4), active int",
        [(1, 20240102, 1, 1, 2, 2, 4, 1, 1), (1, 20240102, 1, 1, 0, 2, 4, 1, 1), (1, 20240103, 2, 1, 0, 2, 1, 1, 1), (1, 20240103, 3, 1, 1, 1, 99, 1, 0)],
    )
    products = frame(spark, "product_key bigint, product_code string, product_name string, type_products string, brand string", [(1, "P", "p", "t", "b")])
    dates = frame(spark, "date_key int, full_date date, year int, quarter int, month_num int, month_name string", [(20240102, date(2024, 1, 2), 2024, 1, 1, "January")])
    out = production.production_efficiency(items, stages, products, dates)
    assert rows(out, "prod_item_id", "stage_date_key", "qty_produced", "distinct_workers", "efficiency_pct", "output_per_hour") == [
        (1, 20240102, 8, 1, 80, 4), (1, 20240103, 1, 1, 10, None), (2, 20240102, 8, 1, None, 4), (2, 20240103, 1, 1, None, None), (3, None, 0, 0, 0, None),
    ]
