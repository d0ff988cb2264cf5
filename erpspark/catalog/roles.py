"""ERP roles played by the test tables.

Every role is a projection of one table. The same expression text is run by
Spark and by the checking engine, so it sticks to what both understand.
Surrogate keys are the natural id plus one.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession

from erpspark.plans.calendar import date_dim
from erpspark.settings import RunParams

PARAMS = RunParams(
    as_of=date(2001, 11, 30),
    snapshot_start=date(1995, 1, 1),
    date_start=date(1995, 1, 1),
    date_end=date(2005, 12, 31),
    zinc_item_id=7,
)


def _key(d: str) -> str:
    return f"cast(year({d}) * 10000 + month({d}) * 100 + day({d}) as int)"


_LINE_ID = (
    "concat(cast(l_orderkey as string), '-', cast(l_linenumber as string), '-', cast(l_partkey as string), '-', "
    f"cast(l_suppkey as string), '-', cast({_key('l_shipdate')} as string))"
)
_TOTAL = "cast(o_totalprice as decimal(18,4))"
_COST = f"case when o_orderpriority = '1-URGENT' then cast({_TOTAL} * 0.6 as decimal(18,4)) else cast(0 as decimal(18,4)) end"
_QTY = "cast(l_quantity as decimal(18,4))"
_EXT = "cast(l_extendedprice as decimal(18,4))"
_NET = "cast(cast(l_extendedprice as decimal(14,2)) * cast(1 - l_discount as decimal(4,2)) as decimal(18,4))"
_OUT = "case l_returnflag when 'A' then l_quantity when 'R' then floor(l_quantity / 2) else 0 end"
# semi-finished lots belong to neither item master
_KIND = "case when l_tax = 0 then 'semi' when l_returnflag = 'R' then 'nvl' else 'product' end"
_EXPORT_DAY = "cast(l_shipdate as date) + cast(l_quantity as int)"
_EXPORT_CODE = (
    "case cast(round(l_tax * 100) as int) when 0 then '' when 8 then ' ' when 7 then '17' "
    "else cast(cast(round(l_tax * 100) as int) as string) end"
)
_NULL = "cast(null as string)"
_ZERO = "cast(0 as decimal(18,4))"
_STAGE_DAY = "ts - interval '25' year"

# role -> (table, {column: expression})
ROLES: dict[str, tuple[str, dict[str, str]]] = {
    "customers": (
        "customer",
        {
            "customer_key": "c_custkey + 1",
            "customer_id": "c_custkey",
            "customer_code": "concat('KH', cast(c_custkey as string))",
            "prefix_client": "'KH'",
            "company": "case when c_acctbal > 9000 then null else c_name end",
            "company_short": "substr(c_name, 1, 8)",
            "representative": "case when c_acctbal < 5000 then concat('Rep of ', c_name) end",
            "phonenumber": "concat('0', cast(c_custkey as string))",
            "email": "concat('kh', cast(c_custkey as string), '@example.com')",
            "type_client": "case when c_acctbal >= 3000 then 'B2B' else 'B2C' end",
            "vip_rating": "c_nationkey",
            "status_clients": "1",
            "is_active": "c_acctbal >= 0",
            "country": "1",
            "city": "concat('City ', cast(c_nationkey as string))",
            "district": _NULL,
            "ward": "cast(null as bigint)",
            "address": "concat('Street ', cast(c_custkey as string))",
            "vat": _NULL,
            "debt_limit": "cast(cast(greatest(c_acctbal, 0) as decimal(14,2)) * 300 as decimal(18,4))",
            "debt_limit_day": "30",
            "discount": _ZERO,
            "table_price_id": "1",
            "time_payment": "15",
            "price_group_key": "length(c_mktsegment)",
            "price_group_code": "substr(c_mktsegment, 1, 4)",
            "price_group_name": "c_mktsegment",
            "datecreated": "date '1995-01-01' + cast(c_nationkey * 90 as int)",
        },
    ),
    "products": (
        "part",
        {
            "product_key": "p_partkey + 1",
            "product_id": "p_partkey",
            "product_code": "concat(case when p_brand = 'Brand#3' then '3D-' else 'SP-' end, cast(p_partkey as string))",
            "product_name": "p_name",
            "product_name_customer": "upper(p_name)",
            "type_products": "case p_type when 'PROMO' then 'semi_products' when 'SMALL' then 'goods' else 'products' end",
            "category_id": "p_size",
            "unit_id": "p_size",
            "species": "p_type",
            "brand": "p_brand",
            "brand_id": "cast(substr(p_brand, 7) as int)",
            "price_import": "case when p_size > 16 then cast(p_retailprice as decimal(18,4)) end",
            "price_sell": "cast(p_retailprice as decimal(18,4))",
            "status": "case when p_size > 2 then 1 else 0 end",
            "is_active": "p_size > 2",
            "date_created": "date '1995-01-01' + cast(p_size as int)",
        },
    ),
    "materials": (
        "part",
        {
            "material_key": "p_partkey + 1",
            "material_id": "p_partkey",
            "material_code": "concat('NVL-', cast(p_partkey as string))",
            "material_name": "concat(case p_type when 'ECONOMY' then 'Giay ' when 'LARGE' then 'Decal Giay ' "
            "when 'MEDIUM' then 'MUC ' when 'PROMO' then 'Bang keo ' when 'SMALL' then 'Hop ' else 'Vai ' end, p_name)",
            "material_name_supplier": "p_name",
            "category_id": "p_size",
            "unit_id": "p_size + 100",
            "species": "p_type",
            "mode_id": "1",
            "is_zinc": "p_brand = 'Brand#7'",
            "price_import": "cast(p_retailprice as decimal(18,4))",
            "is_single_use": "p_size = 1",
            "is_active": "p_size > 2",
            "id_branch": "1",
        },
    ),
    "suppliers": (
        "supplier",
        {
            "supplier_key": "s_suppkey + 1",
            "supplier_id": "s_suppkey",
            "supplier_code": "concat('NCC', cast(s_suppkey as string))",
            "company": "s_name",
            "city": "concat('City ', cast(s_nationkey as string))",
            "groups_in": "cast(s_nationkey as string)",
            "debt_limit": "cast(s_acctbal as decimal(18,4))",
            "is_active": "s_acctbal > 0",
        },
    ),
    "warehouses": (
        "nation",
        {
            "warehouse_key": "n_nationkey + 1",
            "warehouse_id": "n_nationkey",
            "warehouse_code": "concat('KHO', cast(n_nationkey as string))",
            "warehouse_name": "n_name",
            "address": _NULL,
            "supplier_id": "cast(null as bigint)",
            "id_branch": "n_regionkey",
            "is_virtual": "n_regionkey = 4",
        },
    ),
    "staff": (
        "(select distinct user_id from events) staff_rows",
        {
            "staff_key": "user_id + 1",
            "staff_id": "user_id",
            "firstname": "concat('First', cast(user_id as string))",
            "lastname": "concat('Last', cast(user_id as string))",
            "fullname": "concat('First', cast(user_id as string), ' Last', cast(user_id as string))",
            "role": "1",
            "admin": "0",
            "is_active": "true",
        },
    ),
    "orders": (
        "orders",
        {
            "order_key": "o_orderkey + 1",
            "order_id": "o_orderkey",
            "reference_no": "concat('SO-', cast(o_orderkey as string))",
            "customer_key": "o_custkey + 1",
            "employee_key": "cast(substr(o_orderpriority, 1, 1) as bigint)",
            "order_date_key": _key("o_orderdate"),
            "warehouse_id": "1",
            "id_branch": "cast(substr(o_orderpriority, 1, 1) as int)",
            "count_items": "4",
            "total_quantity": "cast(floor(o_totalprice / 400) as decimal(18,4))",
            "grand_total": _TOTAL,
            "total_cost": _COST,
            "total_profit": f"{_TOTAL} - {_COST}",
            "total_payment": _ZERO,
            "total_tax": f"cast({_TOTAL} * 0.1 as decimal(18,4))",
            "total_discount_percent": f"case when o_orderpriority <> '5-LOW' then cast({_TOTAL} * 0.02 as decimal(18,4)) end",
            "total_discount_direct": "cast(5 as decimal(18,4))",
            "cost_delivery": "cast(25 as decimal(18,4))",
            "status": "o_orderstatus",
            "status_payment": "0",
            "status_orders": "o_orderstatus",
            "type_orders": "'sale'",
            "type_bills": "'vat'",
            "is_cancel": "case when o_orderstatus = 'P' then 1 else 0 end",
            "is_end": "case when o_orderstatus = 'F' then 1 else 0 end",
            "currencies": "case substr(o_orderpriority, 1, 1) when '2' then 1 when '3' then 4 else 5 end",
            "date_created": "cast(o_orderdate as date)",
            "date_updated": "cast(o_orderdate as date)",
        },
    ),
    "order_items": (
        "lineitem",
        {
            "order_item_id": _LINE_ID,
            "order_id": "l_orderkey",
            "product_key": "l_partkey + 1",
            "quantity": _QTY,
            "price": "l_extendedprice / l_quantity",
            "amount": _EXT,
            "tax_amount_item": "cast(cast(l_extendedprice as decimal(14,2)) * cast(l_tax as decimal(4,2)) as decimal(18,4))",
            "discount_percent_item": "cast(l_discount as decimal(12,4))",
            "discount_percent_amount_item": f"{_EXT} - {_NET}",
            "discount_direct_amount_item": _ZERO,
            "total_amount": _NET,
            "cost": _ZERO,
            "profit": _ZERO,
            "quantity_delivery": "cast(case when l_linestatus = 'F' then l_quantity else floor(l_quantity / 2) end as decimal(18,4))",
            "quantity_not_delivery": "cast(case when l_linestatus = 'F' then 0 else l_quantity - floor(l_quantity / 2) end as decimal(18,4))",
            "quantity_returned": "cast(case when l_returnflag = 'R' then l_quantity else 0 end as decimal(18,4))",
            "type_item": "'products'",
            "type_gift": "0",
            "unit_id": "l_linenumber",
        },
    ),
    "lots": (
        "lineitem",
        {
            "stock_id": _LINE_ID,
            "product_key": f"case when {_KIND} = 'product' then l_partkey + 1 end",
            "material_key": f"case when {_KIND} = 'nvl' then l_partkey + 1 end",
            "warehouse_key": "cast(l_linenumber + 1 as bigint)",
            "location_key": "l_suppkey + 1",
            "import_date_key": _key("l_shipdate"),
            "quantity": _QTY,
            "quantity_left": f"{_QTY} - cast({_OUT} as decimal(18,4))",
            "quantity_export": f"cast({_OUT} as decimal(18,4))",
            "price": f"case when l_linestatus = 'F' then {_EXT} end",
            "type_items": _KIND,
            "lot_code": "concat('L', cast(l_orderkey as string))",
            "date_sx": "cast(l_shipdate as date) - 30",
            "date_sd": "cast(l_shipdate as date) + 365",
        },
    ),
    # every lot that issued something
    "exports": (
        "lineitem where l_returnflag in ('A', 'R')",
        {
            "export_id": _LINE_ID,
            "product_key": f"case when {_KIND} <> 'nvl' then l_partkey + 1 end",
            "material_key": f"case when {_KIND} = 'nvl' then l_partkey + 1 end",
            "warehouse_key": "cast(l_linenumber + 1 as bigint)",
            "location_key": "l_suppkey + 1",
            "export_date_key": _key(f"({_EXPORT_DAY})"),
            "quantity": f"cast({_OUT} as decimal(18,4))",
            "type_items": _KIND,
            "type_export": _EXPORT_CODE,
        },
    ),
    "po_lines": (
        "lineitem",
        {
            "po_item_id": _LINE_ID,
            "po_id": "l_orderkey",
            "product_key": "case when l_returnflag <> 'R' then l_partkey + 1 end",
            "material_key": "case when l_returnflag = 'R' then l_partkey + 1 end",
            "supplier_key": "l_suppkey + 1",
            "po_date_key": _key("l_shipdate"),
            "quantity": _QTY,
            "quantity_suppliers": "cast(case when l_linestatus = 'F' then l_quantity else floor(l_quantity * 0.9) end as decimal(18,4))",
            "price_suppliers": "l_extendedprice / l_quantity",
            "total_expected": "cast(cast(l_extendedprice as decimal(14,2)) * cast(1 + l_tax as decimal(4,2)) as decimal(18,4))",
            "total_suppliers": _NET,
            "subtotal": _EXT,
        },
    ),
    "deliveries": (
        "lineitem",
        {
            "delivery_item_id": _LINE_ID,
            "delivery_id": "l_orderkey",
            "product_key": "l_partkey + 1",
            "delivery_date_key": _key("l_shipdate"),
            "quantity": _QTY,
        },
    ),
    "production_items": (
        "part",
        {
            "prod_item_key": "p_partkey + 1",
            "prod_item_id": "p_partkey",
            "productions_orders_id": "cast(p_size as bigint)",
            "product_key": "p_partkey + 1",
            "prod_date_key": "case when p_size > 40 then 19000101 else 19990100 + cast(least(p_size, 28) as int) end",
            "quantity": "cast(p_size * 100 as decimal(18,4))",
            "type_items": "'products'",
            "versions_bom": "'v1'",
            "versions_stage": "'v1'",
        },
    ),
    "stages": (
        "events",
        {
            "prod_stage_id": "event_id",
            "productions_orders_id": "user_id",
            "productions_orders_items_id": "user_id",
            "staff_key": "user_id + 1",
            "stage_date_key": _key(f"({_STAGE_DAY})"),
            "number": "cast(length(event_type) as decimal(18,4))",
            "number_hours": "cast(length(props) - 8 as decimal(18,4))",
            "total_time": "cast(length(props) as decimal(18,4))",
            "number_face": "cast(value as decimal(18,4))",
            "number_operations": "cast(1 as decimal(18,4))",
            "active": "case when event_type = 'error' then 0 else 1 end",
        },
    ),
    # a plan serves its own order and the next one
    "plans": (
        "orders",
        {
            "id": "o_orderkey",
            "date": "o_orderdate",
            "options1_id": "case when o_orderpriority = '5-LOW' then '' else concat(cast(o_orderkey as string), ', ', cast(o_orderkey + 1 as string)) end",
            "status": "o_orderstatus",
        },
    ),
    "plan_items": (
        "lineitem",
        {
            "id": _LINE_ID,
            "productions_plan_id": "l_orderkey",
            # some plan lines name no product
            "product_id": "case when l_orderkey % 97 = 5 then null else l_partkey end",
            "quantity_total_details": _QTY,
        },
    ),
    "bom": (
        "lineitem",
        {
            "id": _LINE_ID,
            "productions_plan_id": "l_orderkey",
            "productions_plan_items_id": _LINE_ID,
            "item_type": "case when l_returnflag = 'A' then 'semi' else 'materials' end",
            "item_id": "l_suppkey",
            "item_code": "concat('B', cast(l_suppkey as string))",
            "item_name": "concat(case when l_linenumber < 3 then 'Giay ' else 'Kim ' end, cast(l_suppkey as string))",
            "unit_id": "cast(l_linenumber as bigint)",
            "quantity_single": "cast(l_discount as decimal(18,4))",
            "quantity": _QTY,
            "quantity_compensation": "case when l_tax > 0 then cast(l_tax * 100 as decimal(18,4)) end",
            "number_children_size": "cast(l_linenumber - 1 as decimal(18,4))",
            "is_zinc": "case when l_tax >= 0.07 then 1 else 0 end",
        },
    ),
    "purchase_lines": (
        "lineitem",
        {
            "id": _LINE_ID,
            "id_purchase_order": "l_orderkey",
            "product_id": "l_partkey",
            "price_suppliers": "l_extendedprice / l_quantity",
            "quantity_unit": _QTY,
            "total_suppliers": _NET,
        },
    ),
    "purchase_heads": ("orders", {"id": "o_orderkey", "date": "o_orderdate"}),
}

# raw tables as the source system would deliver them: natural ids only
ROLES |= {
    "raw_clients": (
        "customer",
        {
            "userid": "c_custkey",
            "code_client": "concat('KH', cast(c_custkey as string))",
            "company": "c_name",
            "email_client": "concat('kh', cast(c_custkey as string), '@example.com')",
            "type_client": "case when c_acctbal >= 3000 then 'B2B' else 'B2C' end",
            "debt_limit": "cast(c_acctbal as decimal(18,4))",
            "active": "case when c_acctbal >= 0 then 1 else 0 end",
        },
    ),
    "raw_products": (
        "part",
        {
            "id": "p_partkey",
            "code": "concat('SP-', cast(p_partkey as string))",
            "name": "p_name",
            "type_products": "p_type",
            "category_id": "p_size",
            "brand": "p_brand",
            "price_sell": "cast(p_retailprice as decimal(18,4))",
            "status": "case when p_size > 2 then 1 else 0 end",
        },
    ),
    "raw_materials": (
        "part",
        {
            "id": "p_partkey",
            "code": "concat('NVL-', cast(p_partkey as string))",
            "name": "p_name",
            "unit_id": "p_size",
            "price_import": "cast(p_retailprice as decimal(18,4))",
            "is_zinc": "case when p_brand = 'Brand#7' then 1 else 0 end",
            "is_single_use": "0",
            "status": "1",
        },
    ),
    "raw_staff": (
        "(select distinct user_id from events) staff_rows",
        {
            "staffid": "user_id",
            "firstname": "concat('First', cast(user_id as string))",
            "lastname": "case when user_id > 100 then concat('Last', cast(user_id as string)) end",
            "active": "1",
        },
    ),
    "raw_departments": (
        "region",
        {"departmentid": "r_regionkey", "code": "concat('PB', cast(r_regionkey as string))", "name": "r_name", "active_departments": "1"},
    ),
    "raw_groups": ("nation", {"id": "n_nationkey", "code": "concat('G', cast(n_nationkey as string))", "name": "n_name"}),
    "raw_customer_groups": ("customer", {"customer_id": "c_custkey", "groupid": "c_nationkey"}),
    "raw_warehouses": (
        "nation",
        {"id": "n_nationkey", "code": "concat('KHO', cast(n_nationkey as string))", "name": "n_name", "id_branch": "n_regionkey"},
    ),
    "raw_suppliers": (
        "supplier",
        {
            "id": "s_suppkey",
            "code": "concat('NCC', cast(s_suppkey as string))",
            "company": "s_name",
            "groups_in": "cast(s_nationkey as string)",
            "debt_limit": "cast(s_acctbal as decimal(18,4))",
            "active": "case when s_acctbal > 0 then 1 else 0 end",
        },
    ),
    "raw_locations": (
        "supplier",
        {"id": "s_suppkey", "code": "s_name", "name": "s_name", "warehouse": "s_nationkey", "lever": "1"},
    ),
    "raw_manufactures": (
        "nation",
        {"id": "n_nationkey", "reference_no": "n_name", "id_branch": "n_regionkey", "status": "'open'"},
    ),
    "raw_orders": (
        "orders",
        {
            "id": "o_orderkey",
            "reference_no": "concat('SO-', cast(o_orderkey as string))",
            "date": "o_orderdate",
            "customer_id": "o_custkey",
            "employee_id": "cast(substr(o_orderpriority, 1, 1) as bigint)",
            "grand_total": _TOTAL,
            "status": "o_orderstatus",
            "is_cancel": "case when o_orderstatus = 'P' then 1 else 0 end",
        },
    ),
    "raw_order_items": (
        "lineitem",
        {"id": _LINE_ID, "order_id": "l_orderkey", "item_id": "l_partkey", "quantity": _QTY, "amount": _EXT, "total_amount": _NET},
    ),
    "raw_deliveries": ("orders", {"id": "o_orderkey", "date": "o_orderdate", "customer_id": "o_custkey"}),
    "raw_delivery_items": (
        "lineitem",
        {
            "id": _LINE_ID, "delivery_id": "l_orderkey", "order_item_id": _LINE_ID, "item_id": "l_partkey",
            "warehouse_id": "cast(l_linenumber as bigint)", "quantity": _QTY, "amount": _EXT,
        },
    ),
    "raw_stock": (
        "lineitem",
        {
            "id": _LINE_ID, "product_id": "l_partkey", "warehouse_id": "cast(l_linenumber as bigint)", "localtion": "l_suppkey",
            "type_items": _KIND, "date_import": "l_shipdate", "quantity": _QTY,
            "quantity_left": f"{_QTY} - cast({_OUT} as decimal(18,4))", "price": _EXT,
        },
    ),
    "raw_po": ("orders", {"id": "o_orderkey", "date": "o_orderdate", "suppliers_id": "cast(substr(o_orderpriority, 1, 1) as bigint)"}),
    "raw_po_items": (
        "lineitem",
        {
            "id": _LINE_ID, "id_purchase_order": "l_orderkey", "product_id": "l_partkey",
            "type": "case when l_returnflag = 'R' then 'nvl' when l_returnflag = 'A' then 'product' end",
            "quantity": _QTY, "total_suppliers": _NET,
        },
    ),
    # headers of other than urgent orders have ids that no line names, so the left join leaves lines without a date
    "raw_production_orders": ("orders", {"id": "case when o_orderpriority = '1-URGENT' then o_orderkey else -1 - o_orderkey end", "date": "o_orderdate"}),
    "raw_production_items": (
        "lineitem",
        {"id": _LINE_ID, "productions_orders_id": "l_orderkey", "items_id": "l_partkey", "quantity": _QTY, "type_items": "'products'"},
    ),
    "raw_stages": (
        "events",
        {
            "id": "event_id", "productions_orders_id": "user_id", "productions_orders_items_id": "user_id",
            "staff_active": "user_id", "date_active": "case when event_type <> 'error' then ts end",
            "number_face": "cast(value as decimal(18,4))", "active": "case when event_type = 'error' then 0 else 1 end",
        },
    ),
    "raw_receipts": ("orders", {"id": "o_orderkey", "date": "o_orderdate", "warehouse_id": "cast(substr(o_orderpriority, 1, 1) as bigint)"}),
    "raw_receipt_items": (
        "lineitem",
        {
            "id": _LINE_ID, "purchase_product_id": "l_orderkey", "item_id": "l_partkey", "location_id": "l_suppkey",
            "quantity": _QTY, "amount": _EXT,
        },
    ),
    "raw_export": (
        "lineitem",
        {
            "id": _LINE_ID, "product_id": "l_partkey", "warehouse_id": "cast(l_linenumber as bigint)", "localtion": "l_suppkey",
            "type_items": "case when l_linestatus = 'O' or l_returnflag <> 'N' then " + _KIND + " end", "type_export": "l_linenumber",
            "date_export": "case when l_discount > 0 then l_shipdate end", "quantity": _QTY,
        },
    ),
    "raw_transfers": (
        "lineitem",
        {
            "id": _LINE_ID, "id_transfer": "l_orderkey", "id_items": "l_partkey", "warehouses_id": "cast(l_linenumber as bigint)",
            "warehouses_to": "cast(l_linenumber + 20 as bigint)", "localtion_id": "l_suppkey", "localtion_to": "l_suppkey + 1",
            "quantity": _QTY, "amount": _EXT,
        },
    ),
    # whole dimensions; some rows are on file under an id that no fact names, and come late
    "known_customers": ("customer", {"customer_id": "case when c_acctbal >= 0 then c_custkey else -1 - c_custkey end", "customer_key": "c_custkey + 1"}),
    "known_products": ("part", {"product_id": "case when p_size > 2 then p_partkey else -1 - p_partkey end", "product_key": "p_partkey + 1"}),
    "known_materials": ("part", {"material_id": "case when p_size < 50 then p_partkey else -1 - p_partkey end", "material_key": "p_partkey + 1"}),
    "known_staff": ("(select distinct user_id from events) staff_rows", {"staff_id": "user_id", "staff_key": "user_id + 1"}),
    "known_suppliers": ("supplier", {"supplier_id": "case when s_acctbal > 0 then s_suppkey else -1 - s_suppkey end", "supplier_key": "s_suppkey + 1"}),
    "known_warehouses": ("nation", {"warehouse_id": "n_nationkey", "warehouse_key": "n_nationkey + 1"}),
    "known_locations": ("supplier", {"location_id": "case when s_acctbal > 0 then s_suppkey else -1 - s_suppkey end", "location_key": "s_suppkey + 1"}),
}

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


_SCHEMAS: dict[str, object] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Test table; its schema is inferred once, as inference is a job of its own."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def role(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Role as a DataFrame; filters and projections reach the Parquet scan."""
    if name == "dates":
        return date_dim(spark, PARAMS.date_start, PARAMS.date_end)
    source, columns = ROLES[name]
    if source.startswith("(select distinct user_id"):
        df = table(spark, sf_dir, "events").select("user_id").distinct()
    else:
        base, _, where = source.partition(" where ")
        df = table(spark, sf_dir, base)
        if where:
            df = df.filter(where)
    return df.selectExpr(*[f"{expr} AS {name}" for name, expr in columns.items()])


def role_sql(name: str) -> str:
    if name == "dates":
        return f"""
            SELECT cast(year(d) * 10000 + month(d) * 100 + day(d) as int) AS date_key, cast(d as date) AS full_date,
                   dayofweek(d) AS day_of_week, dayname(d) AS day_name, day(d) AS day_of_month,
                   dayofyear(d) AS day_of_year, weekofyear(d) AS week_of_year, month(d) AS month_num,
                   monthname(d) AS month_name, quarter(d) AS quarter, year(d) AS year,
                   dayofweek(d) IN (0, 6) AS is_weekend, false AS is_holiday
            FROM (SELECT unnest(generate_series(timestamp '{PARAMS.date_start}', timestamp '{PARAMS.date_end}', interval 1 day)) AS d)"""
    source, columns = ROLES[name]
    return "SELECT " + ", ".join(f"{e} AS {c}" for c, e in columns.items()) + f" FROM {source}"
