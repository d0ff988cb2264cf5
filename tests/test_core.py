"""Keyed writes and the full raw-to-star run on literal tables."""

from datetime import date, datetime

import pytest

from erpspark.operators import upsert
from erpspark.operators.anonymize import anonymize
from erpspark.plans import core, runner
from erpspark.plans.calendar import date_dim
from erpspark.settings import RunParams
from erpspark.sources import sinks
from util import frame, rows


def test_upsert_new_changed_unchanged_missing_and_replay(spark):
    target = spark.createDataFrame([(1, 10, "a", "x"), (2, 20, "b", "y"), (3, 30, "c", "z")], "k bigint, id bigint, v string, kept string")
    batch = spark.createDataFrame([(10, "A"), (20, "b"), (50, "e"), (40, None)], "id bigint, v string")
    once = upsert.upsert_scd1(target, batch, "id", "k")
    want = [(1, 10, "A", "x"), (2, 20, "b", "y"), (3, 30, "c", "z"), (4, 40, None, None), (5, 50, "e", None)]
    assert rows(once, "k", "id", "v", "kept") == want
    twice = upsert.upsert_scd1(once, batch, "id", "k")
    assert rows(twice, "k", "id", "v", "kept") == want
    nothing = upsert.upsert_scd1(target, batch.limit(0), "id", "k")
    assert rows(nothing, "k", "id", "v") == rows(target, "k", "id", "v")


def test_update_sets_null_from_source(spark):
    target = spark.createDataFrame([(1, 10, "a")], "k bigint, id bigint, v string")
    out = upsert.upsert_scd1(target, spark.createDataFrame([(10, None)], "id bigint, v string"), "id", "k")
    assert rows(out, "k", "id", "v") == [(1, 10, None)]


def test_insert_if_absent_never_changes_stored_rows(spark):
    fact = spark.createDataFrame([(1, "old")], "id bigint, v string")
    batch = spark.createDataFrame([(1, "new"), (2, "new")], "id bigint, v string")
    once = upsert.insert_if_absent(fact, batch, "id")
    assert rows(once, "id", "v") == [(1, "old"), (2, "new")]
    assert rows(upsert.insert_if_absent(once, batch, "id"), "id", "v") == [(1, "old"), (2, "new")]


def test_replace_by_key(spark):
    fact = spark.createDataFrame([(1, "old"), (2, "old")], "id bigint, v string")
    batch = spark.createDataFrame([(1, "new"), (3, "new")], "id bigint, v string")
    assert rows(upsert.replace_by_key(fact, batch, "id"), "id", "v") == [(1, "new"), (2, "old"), (3, "new")]


def test_heal_touches_rows_with_any_null_key(spark):
    fact = spark.createDataFrame([(1, None, 7), (2, 5, 6), (3, None, None), (4, None, 1)], "id bigint, a bigint, b bigint")
    fresh = spark.createDataFrame([(1, 11, 77), (2, 55, 66), (3, None, None)], "id bigint, a bigint, b bigint")
    out = upsert.heal_keys(fact, fresh, "id", ["a", "b"])
    # 1: both keys refreshed; 2: complete, untouched; 3: touched though still NULL; 4: not in the batch
    assert [tuple(r) for r in out.orderBy("id").collect()] == [
        (1, 11, 77, True), (2, 5, 6, False), (3, None, None, True), (4, None, 1, False)
    ]


def test_stock_heal_clears_the_key_of_the_other_type(spark):
    fact = spark.createDataFrame([(1, 9, None, 3), (2, None, 8, 3)], "stock_id bigint, product_key bigint, material_key bigint, location_key bigint")
    fresh = spark.createDataFrame(
        [(1, "nvl", None, 4, 3), (2, "product", 5, None, 3)],
        "stock_id bigint, type_items string, product_key bigint, material_key bigint, location_key bigint",
    )
    needs, clear = core.heal_conditions("fact_warehouse_stock")
    out = upsert.heal_keys(fact, fresh, "stock_id", ["product_key", "material_key", "location_key"], needs, clear)
    assert [tuple(r)[:4] for r in out.orderBy("stock_id").collect()] == [(1, None, 4, 3), (2, 5, None, 3)]


def test_conditional_update_counts_null_as_a_value(spark):
    target = spark.createDataFrame([(1, None, "n"), (2, 5, "same"), (3, 6, "old")], "id bigint, g bigint, name string")
    changes = spark.createDataFrame([(1, 7, "seven"), (2, 5, "other"), (3, 8, "eight")], "id bigint, g bigint, name string")
    out = upsert.update_where_changed(target, changes, "id", "g", ["g", "name"])
    assert rows(out, "id", "g", "name") == [(1, 7, "seven"), (2, 5, "same"), (3, 8, "eight")]


def test_customer_in_two_groups_takes_the_highest(spark):
    customers = spark.createDataFrame([(1, None, None, None)], "customer_id bigint, price_group_key bigint, price_group_code string, price_group_name string")
    bridge = spark.createDataFrame([(1, 3), (1, 4)], "customer_id bigint, groupid bigint")
    groups = spark.createDataFrame([(3, 30, "three"), (4, 40, "four")], "price_group_id bigint, price_group_key bigint, price_group_name string")
    raw = spark.createDataFrame([(3, "C3"), (4, "C4")], "id bigint, code string")
    out = core.assign_price_groups(customers, bridge, groups, raw)
    assert rows(out, "customer_id", "price_group_key", "price_group_code", "price_group_name") == [(1, 40, "C4", "four")]


def test_anonymize_once(spark):
    df = frame(spark, "k bigint, name string, money decimal(22,4)", [(5, "Real", 100), (9, "Other", 50)])
    out = anonymize(df, "k", "supplier", ["name"], ["money"])
    assert [(r["name"], float(r["money"])) for r in out.orderBy("k").collect()] == [("Nha Cung Cap 001", 10.0), ("Nha Cung Cap 002", 5.0)]
    assert anonymize(out, "k", "supplier", ["name"], ["money"]).collect() == out.collect()


def test_date_dim_shape(spark):
    dates = date_dim(spark)
    assert dates.count() == 4018 and len(dates.columns) == 13
    sunday = dates.filter("date_key = 20230101").first()
    assert (sunday["day_of_week"], sunday["is_weekend"], sunday["week_of_year"], sunday["day_name"]) == (0, True, 52, "Sunday")


def _raw(spark, db, tables):
    for name, (ddl, data) in tables.items():
        sinks.replace_table(frame(spark, ddl, data), f"{db}.{name}")


TS = datetime(2024, 3, 5)
RAW = {
    "tblclients": ("userid bigint, code_client string, representative string, company string, active int, debt_limit decimal(22,4)", [(1, "K1", None, "Co", 1, None)]),
    "tbl_products": ("id bigint, code string, name string, status int, type_products string, price_import decimal(22,4)", [(1, "3D-1", "box", 1, "products", None), (2, "SP-2", "bag", 0, "goods", None)]),
    "tblstaff": ("staffid bigint, firstname string, lastname string, active int", [(1, "An", None, 1)]),
    "tbldepartments": ("departmentid bigint, code string, name string, type string, active_departments int", [(1, "D", "Dep", "x", 1)]),
    "tblwarehouse": ("id bigint, code string, name string", [(1, "W1", "Main")]),
    "tblsuppliers": ("id bigint, code string, company string, active int", [(1, "S1", "Sup", 1)]),
    "tbllocaltion_warehouses": ("id bigint, name string, code string, warehouse bigint", [(1, "L1", "L1", 1)]),
    "tbl_manufactures": ("id bigint, reference_no string", [(1, "M1")]),
    "tbl_materials": ("id bigint, code string, name string, is_zinc int, is_single_use int, status int", [(1, "N1", "Giay A", 0, 0, 1)]),
    "tblcustomers_groups": ("id bigint, name string, code string", [(1, "Group", "G1")]),
    "tblcustomer_groups": ("customer_id bigint, groupid bigint", [(1, 1)]),
    "tbl_orders": (
        "id bigint, date timestamp, customer_id bigint, employee_id bigint, grand_total decimal(22,4), total_cost decimal(22,4), total_profit decimal(22,4), total_tax decimal(22,4), "
        "total_discount_percent decimal(22,4), total_discount_direct decimal(22,4), cost_delivery decimal(22,4), is_cancel int, is_end int, id_branch int, currencies int, "
        "total_quantity decimal(22,4), reference_no string, date_created timestamp, status string",
        [(1, TS, 1, 1, 100, 0, 100, 0, 0, 0, 0, 0, 1, 1, 5, 10, "SO1", TS, "ok"), (2, TS, 9, 1, 50, 0, 50, 0, 0, 0, 0, 0, 1, 1, 5, 10, "SO2", TS, "ok")],
    ),
    "tbl_order_items": (
        "id bigint, order_id bigint, item_id bigint, quantity decimal(22,4), price decimal(22,4), total_amount decimal(22,4), quantity_delivery decimal(22,4), "
        "quantity_not_delivery decimal(22,4), quantity_returned decimal(22,4)",
        [(1, 1, 1, 10, 10, 100, 10, 0, 0), (2, 7, 1, 1, 1, 1, 1, 0, 0)],  # the second has no header
    ),
    "tbl_deliveries": ("id bigint, date timestamp, customer_id bigint", [(1, TS, 1)]),
    "tbl_delivery_items": ("id bigint, delivery_id bigint, order_item_id bigint, item_id bigint, warehouse_id bigint, quantity decimal(22,4)", [(1, 1, 1, 1, 1, 4)]),
    "tblwarehouse_product": (
        "id bigint, product_id bigint, warehouse_id bigint, localtion bigint, type_items string, date_import timestamp, quantity decimal(22,4), quantity_left decimal(22,4), "
        "quantity_export decimal(22,4), price decimal(22,4), lot_code string, date_sd date",
        [(1, 1, 1, 1, "product", TS, 10, 6, 4, 1000, "L", None), (2, 1, 1, 8, "nvl", TS, 5, 5, 0, None, "L", None)],
    ),
    "tblpurchase_order": ("id bigint, date timestamp, suppliers_id bigint", [(1, TS, 1)]),
    "tblpurchase_order_items": (
        "id bigint, id_purchase_order bigint, product_id bigint, type string, quantity decimal(22,4), quantity_suppliers decimal(22,4), price_suppliers decimal(22,4), "
        "total_expected decimal(22,4), total_suppliers decimal(22,4), subtotal decimal(22,4), quantity_unit decimal(22,4)",
        [(1, 1, 1, "nvl", 10, 10, 3, 30, 33, 30, 10)],
    ),
    "tbl_productions_orders": ("id bigint, date timestamp", [(1, TS)]),
    "tbl_productions_orders_items": ("id bigint, productions_orders_id bigint, items_id bigint, quantity decimal(22,4)", [(1, 1, 1, 10), (2, 5, 1, 10)]),
    "tbl_productions_orders_items_stages": (
        "id bigint, productions_orders_id bigint, productions_orders_items_id bigint, staff_active bigint, date_active timestamp, number decimal(22,4), number_hours decimal(22,4), "
        "total_time decimal(22,4), number_face decimal(22,4), number_operations decimal(22,4), active int",
        [(1, 1, 1, 1, TS, 1, 2, 2, 8, 1, 1)],
    ),
    "tbl_purchase_products": ("id bigint, date timestamp, warehouse_id bigint", [(1, TS, 1)]),
    "tbl_purchase_product_items": ("id bigint, purchase_product_id bigint, item_id bigint, location_id bigint, quantity decimal(22,4)", [(1, 1, 1, 1, 2)]),
    "tblwarehouse_export": (
        "id bigint, product_id bigint, warehouse_id bigint, localtion bigint, type_items string, type_export int, date_export timestamp, quantity decimal(22,4)",
        [(1, 1, 1, 1, "product", 1, TS, 4)],
    ),
    "tbltransfer_warehouse_detail": ("id bigint, id_transfer bigint, id_items bigint, warehouses_id bigint, warehouses_to bigint, localtion_id bigint, localtion_to bigint, quantity decimal(22,4)", [(1, 1, 1, 1, 1, 1, 1, 1)]),
    "tbl_productions_plan": ("id bigint, date timestamp, options1_id string, status string", [(1, TS, "1", "open")]),
    "tbl_productions_plan_items": ("id bigint, productions_plan_id bigint, product_id bigint, quantity_total_details decimal(22,4)", [(1, 1, 1, 10)]),
    "tbl_productions_plan_bom": (
        "id bigint, productions_plan_id bigint, productions_plan_items_id bigint, item_type string, item_id bigint, item_code string, item_name string, unit_id bigint, "
        "quantity_single decimal(22,4), quantity decimal(22,4), quantity_compensation decimal(22,4), number_children_size decimal(22,4), is_zinc int",
        [(1, 1, 1, "materials", 1, "N1", "Giay A", 1, 1, 5, 1, 2, 0)],
    ),
}


def test_raw_to_star_to_marts(spark, database):
    raw_db, core_db, mart_db = database("raw"), database("core"), database("mart")
    _raw(spark, raw_db, RAW)
    star = runner.Star(spark, raw_db, core_db)
    first = {r["step"]: r for r in runner.run_transforms(star).collect()}
    assert [r for r in first] == runner.STEPS
    assert first["fact_orders"]["rows_inserted"] == 2 and first["fact_order_items"]["rows_inserted"] == 1
    orders = spark.table(f"{core_db}.fact_orders")
    assert rows(orders, "order_id", "customer_key", "year") == [(1, 1, 2024), (2, None, 2024)]
    items = spark.table(f"{core_db}.fact_production_order_items")
    assert rows(items, "prod_item_id", "prod_date_key") == [(1, 20240305), (2, 19000101)]
    who = spark.table(f"{core_db}.dim_customer").first()
    assert (who["price_group_key"], who["price_group_code"], who["is_active"]) == (1, "G1", True)
    assert spark.table(f"{core_db}.dim_staff").first()["fullname"] == "An "

    # the late customer arrives, order 1 changes at the source, order 3 is new
    late = dict(RAW)
    late["tblclients"] = (RAW["tblclients"][0], [(9, "K9", None, "Late", 1, None)])
    ddl, data = RAW["tbl_orders"]
    late["tbl_orders"] = (ddl, [data[0][:4] + (999,) + data[0][5:], data[1], (3, TS) + data[1][2:]])
    _raw(spark, raw_db, late)
    second = {r["step"]: r for r in runner.run_transforms(star).collect()}
    assert (second["fact_orders"]["keys_fixed"], second["fact_orders"]["rows_inserted"]) == (1, 1)
    orders = spark.table(f"{core_db}.fact_orders")
    assert rows(orders, "order_id", "customer_key", "grand_total") == [(1, 1, 100), (2, 2, 50), (3, 2, 50)]
    third = {r["step"]: r for r in runner.run_transforms(star).collect()}
    assert (third["fact_orders"]["keys_fixed"], third["fact_orders"]["rows_inserted"]) == (0, 0)
    assert spark.table(f"{core_db}.fact_warehouse_export").count() == 1
    assert sinks.read_between(spark, f"{core_db}.fact_orders", "order_date_key", 20240101, 20241231).count() == 3

    tables = {t: spark.table(f"{core_db}.{t}") for t in [*core.DIMS, *core.FACTS]}
    params = RunParams(as_of=date(2024, 6, 30), snapshot_start=date(2024, 1, 1))
    built = runner.build_marts(tables, star.raw_tables(), date_dim(spark), params, mart_db)
    assert len(built) == 17
    snapshot = spark.table(f"{mart_db}.fct_stock_snapshot").orderBy("stock_id").collect()
    assert [(r["item_type"], float(r["stock_value"])) for r in snapshot] == [("product", 600.0), ("nvl", 15.0)]
    cost = spark.table(f"{mart_db}.fct_order_npl_cost").collect()
    # 5 x 3.3 rounds to 17; the injected plate has no price
    assert [(r["order_id"], float(r["allocated_npl_materials_vnd"]), r["linked_plan_count"]) for r in cost] == [(1, 17.0, 1)]


def test_hard_failure_stops_and_soft_step_does_not(spark, database):
    raw_db, core_db = database("raw"), database("core")
    _raw(spark, raw_db, {k: v for k, v in RAW.items() if k not in ("tblcustomer_groups", "tbl_order_items")})
    star = runner.Star(spark, raw_db, core_db)
    only = [*core.DIMS, runner.PRICE_GROUP_STEP, "fact_orders"]
    done = {r["step"]: r["status"] for r in runner.run_transforms(star, only).collect()}
    assert done[runner.PRICE_GROUP_STEP] == "skipped" and done["fact_orders"] == "ok"
    with pytest.raises(Exception):
        runner.run_transforms(star, ["fact_order_items"])


def test_rekey_materials(spark):
    fact = spark.createDataFrame([(1, 5, None), (2, 6, None), (3, 7, 2)], "id bigint, product_key bigint, material_key bigint")
    listed = spark.createDataFrame([(1, 50), (2, 99)], "id bigint, mid bigint")
    materials = spark.createDataFrame([(50, 500)], "material_id bigint, material_key bigint")
    assert rows(upsert.rekey_materials(fact, listed, materials, "id", "mid"), "id", "product_key", "material_key") == [(1, None, 500), (2, 6, None), (3, 7, 2)]
    assert rows(upsert.rekey_materials(fact, listed, materials, "id", "mid", True), "id", "product_key", "material_key") == [(1, None, 500), (2, None, None), (3, 7, 2)]
