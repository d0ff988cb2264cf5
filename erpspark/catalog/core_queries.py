"""Core-layer queries: dimension loads, fact loads, keyed writes."""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.sql import functions as F

from erpspark.catalog.registry import Erp, query
from erpspark.catalog.sqltext import part
from erpspark.operators import upsert
from erpspark.operators.anonymize import anonymize
from erpspark.operators.keymap import BucketedDimension
from erpspark.operators.lookup import resolve_key
from erpspark.plans import core, runner
from erpspark.plans.calendar import date_dim
from erpspark.session import work_dir, written
from erpspark.sources import sinks

# --- dimensions: each raw batch loaded into an empty dimension -----------------
DIM_CASES = {
    "dim_customer": (
        "raw_clients",
        "customer_id:l customer_code:s company:s email:s type_client:s debt_limit:d is_active:b",
        "userid AS customer_id, code_client AS customer_code, company, email_client AS email, type_client, debt_limit, active = 1 AS is_active",
    ),
    "dim_product": (
        "raw_products",
        "product_id:l product_code:s product_name:s type_products:s category_id:l brand:s price_sell:d is_active:b",
        "id AS product_id, code AS product_code, name AS product_name, type_products, category_id, brand, price_sell, status = 1 AS is_active",
    ),
    "dim_staff": (
        "raw_staff",
        "staff_id:l firstname:s lastname:s fullname:s is_active:b",
        "staffid AS staff_id, firstname, lastname, coalesce(firstname, '') || ' ' || coalesce(lastname, '') AS fullname, active = 1 AS is_active",
    ),
    "dim_department": (
        "raw_departments",
        "department_id:l department_code:s department_name:s is_active:b",
        "departmentid AS department_id, code AS department_code, name AS department_name, active_departments = 1 AS is_active",
    ),
    "dim_price_group": (
        "raw_groups", "price_group_id:l price_group_name:s is_active:b", "id AS price_group_id, name AS price_group_name, true AS is_active",
    ),
    "dim_warehouse": (
        "raw_warehouses",
        "warehouse_id:l warehouse_code:s warehouse_name:s id_branch:l",
        "id AS warehouse_id, code AS warehouse_code, name AS warehouse_name, id_branch",
    ),
    "dim_supplier": (
        "raw_suppliers",
        "supplier_id:l supplier_code:s company:s groups_in:s debt_limit:d is_active:b",
        "id AS supplier_id, code AS supplier_code, company, groups_in, debt_limit, active = 1 AS is_active",
    ),
    "dim_warehouse_location": (
        "raw_locations",
        "location_id:l location_name:s location_code:s warehouse_id:l lever:l",
        "id AS location_id, name AS location_name, code AS location_code, warehouse AS warehouse_id, lever",
    ),
    "dim_manufacture": (
        "raw_manufactures",
        "manufacture_id:l reference_no:s id_branch:l status:s",
        "id AS manufacture_id, reference_no, id_branch, status",
    ),
    "dim_material": (
        "raw_materials",
        "material_id:l material_code:s material_name:s unit_id:l price_import:d is_zinc:b is_single_use:b is_active:b",
        "id AS material_id, code AS material_code, name AS material_name, unit_id, price_import, is_zinc = 1 AS is_zinc, "
        "is_single_use = 1 AS is_single_use, status = 1 AS is_active",
    ),
}
for _dim, (_raw, _spec, _select) in DIM_CASES.items():
    _key = core.DIMS[_dim].surrogate
    query(
        f"core_{_dim}",
        f"{_key}:l {_spec}",
        # new keys follow the natural key order
        f"SELECT row_number() OVER (ORDER BY {_spec.split(':')[0]}) AS {_key}, * FROM (SELECT {_select} FROM r_{_raw})",
    )(lambda e, d=_dim, raw=_raw: core.load_dim(d, None, e.role(raw)))


@query(
    "core_upsert_customer",
    "customer_key:l customer_id:l customer_code:s company:s type_client:s debt_limit:d is_active:b",
    """WITH stored AS (SELECT row_number() OVER (ORDER BY userid) AS customer_key, userid, 'old' AS code_client, 'old' AS company, 'old' AS type_client,
            debt_limit, true AS is_active FROM r_raw_clients WHERE debt_limit >= 0),
          batch AS (SELECT * FROM r_raw_clients WHERE debt_limit < 5000)
       SELECT coalesce(s.customer_key, (SELECT max(customer_key) FROM stored) + row_number() OVER (PARTITION BY s.customer_key IS NULL ORDER BY b.userid)) AS customer_key,
         coalesce(b.userid, s.userid) AS customer_id,
         CASE WHEN b.userid IS NOT NULL THEN b.code_client ELSE s.code_client END AS customer_code,
         CASE WHEN b.userid IS NOT NULL THEN b.company ELSE s.company END AS company,
         CASE WHEN b.userid IS NOT NULL THEN b.type_client ELSE s.type_client END AS type_client,
         CASE WHEN b.userid IS NOT NULL THEN b.debt_limit ELSE s.debt_limit END AS debt_limit,
         CASE WHEN b.userid IS NOT NULL THEN b.active = 1 ELSE s.is_active END AS is_active
       FROM stored s FULL JOIN batch b ON b.userid = s.userid""",
)
def _upsert_customer(e: Erp):
    # stored: customers in credit; batch: customers under 5 000, of which those in debt are new
    old = F.lit("old")
    stored = e.raw_clients.filter(F.col("debt_limit") >= 0)
    stored = stored.withColumns({"code_client": old, "company": old, "type_client": old, "active": F.lit(1)})
    first = core.load_dim("dim_customer", None, stored)
    return core.load_dim("dim_customer", first, e.raw_clients.filter(F.col("debt_limit") < 5000))


@query(
    "core_upsert_bucketed",
    "customer_id:l customer_code:s company:s type_client:s debt_limit:d is_active:b load_no:l key_once:b key_in_range:b",
    """WITH stored AS (SELECT *, 'old' AS o FROM r_raw_clients WHERE debt_limit >= 0),
          batch AS (SELECT * FROM r_raw_clients WHERE debt_limit < 5000)
       SELECT coalesce(b.userid, s.userid) AS customer_id,
         CASE WHEN b.userid IS NOT NULL THEN b.code_client ELSE s.o END AS customer_code,
         coalesce(s.o, b.company) AS company,
         CASE WHEN b.userid IS NOT NULL THEN b.type_client ELSE s.o END AS type_client,
         CASE WHEN b.userid IS NOT NULL THEN b.debt_limit ELSE s.debt_limit END AS debt_limit,
         CASE WHEN b.userid IS NOT NULL THEN b.active = 1 ELSE true END AS is_active,
         CASE WHEN s.userid IS NULL THEN 2 ELSE 1 END AS load_no, true AS key_once, true AS key_in_range
       FROM stored s FULL JOIN batch b ON b.userid = s.userid""",
)
def _upsert_bucketed(e: Erp):
    """Two loads and a replay of the second into a bucketed customer dimension. The second batch has no company for known customers
    to change; new customers bring theirs in a third load."""
    database = f"dims_{uuid.uuid4().hex}"
    e.spark.sql(f"CREATE DATABASE {database} LOCATION '{work_dir(e.spark)}/{database}'")
    dim = BucketedDimension(e.spark, f"{database}.dim_customer", "customer_id", "customer_key", max(8, int(e.spark.conf.get("spark.sql.shuffle.partitions"))))
    batch = e.raw_clients.select(
        F.col("userid").alias("customer_id"), F.col("code_client").alias("customer_code"), "company", "type_client", "debt_limit", (F.col("active") == 1).alias("is_active")
    )
    old = F.lit("old")
    dim.load(batch.filter(F.col("debt_limit") >= 0).withColumns({"customer_code": old, "company": old, "type_client": old, "is_active": F.lit(True)}))
    first = dim.keys().agg(F.max("customer_key")).first()[0] or 0
    second = batch.filter(F.col("debt_limit") < 5000)
    for _ in range(2):
        dim.load(second.drop("company"))
    dim.load(second.filter(F.col("debt_limit") < 0).select("customer_id", "company"))
    out = written(dim.rows(), "dim-customer")
    e.spark.sql(f"DROP DATABASE {database} CASCADE")
    total = out.count()
    once = out.groupBy("customer_key").agg(F.count(F.lit(1)).alias("__rows"))
    return out.join(once, "customer_key").select(
        "customer_id", "customer_code", "company", "type_client", "debt_limit", "is_active",
        F.when(F.col("customer_key") <= first, 1).otherwise(2).cast("bigint").alias("load_no"),
        (F.col("__rows") == 1).alias("key_once"), F.col("customer_key").between(1, total).alias("key_in_range"),
    )


@query(
    "core_conditional_update",
    "customer_id:l price_group_key:l price_group_code:s price_group_name:s",
    """SELECT c.customer_id, CASE WHEN hit THEN new_key ELSE price_group_key END AS price_group_key,
         CASE WHEN hit THEN 'G' || groupid ELSE price_group_code END AS price_group_code,
         CASE WHEN hit THEN n_name ELSE price_group_name END AS price_group_name
       FROM (SELECT c.*, g.groupid, n_name, n_nationkey + 1 AS new_key, price_group_key IS DISTINCT FROM n_nationkey + 1 AS hit
             FROM r_customers c JOIN r_raw_customer_groups g USING (customer_id) JOIN nation ON n_nationkey = g.groupid) c""",
)
def _conditional(e: Erp):
    groups = e.raw_groups.select(
        F.col("id").alias("price_group_id"), (F.col("id") + 1).alias("price_group_key"), F.col("name").alias("price_group_name")
    )
    return core.assign_price_groups(e.customers, e.raw_customer_groups, groups, e.raw_groups)


# --- facts -----------------------------------------------------------------------
def _known(e: Erp) -> dict:
    return {
        "dim_customer": e.known_customers, "dim_product": e.known_products, "dim_material": e.known_materials,
        "dim_staff": e.known_staff, "dim_supplier": e.known_suppliers, "dim_warehouse": e.known_warehouses,
        "dim_warehouse_location": e.known_locations,
    }


RAW_OF = {
    "tbl_orders": "raw_orders", "tbl_order_items": "raw_order_items", "tbl_deliveries": "raw_deliveries",
    "tbl_delivery_items": "raw_delivery_items", "tblwarehouse_product": "raw_stock", "tblpurchase_order": "raw_po",
    "tblpurchase_order_items": "raw_po_items", "tbl_productions_orders": "raw_production_orders",
    "tbl_productions_orders_items": "raw_production_items", "tbl_productions_orders_items_stages": "raw_stages",
    "tbl_purchase_products": "raw_receipts", "tbl_purchase_product_items": "raw_receipt_items",
    "tblwarehouse_export": "raw_export", "tbltransfer_warehouse_detail": "raw_transfers",
}


def _rows(e: Erp, fact: str):
    spec = core.FACTS[fact]
    needed = {spec.source} | ({spec.header[0]} if spec.header else set())
    return core.fact_rows(fact, {t: e.role(RAW_OF[t]) for t in needed}, _known(e))


def _dk(d: str) -> str:
    return f"cast(strftime({d}, '%Y%m%d') as int)"


FACT_CASES = {
    "fact_orders": (
        "order_id:l reference_no:s customer_key:l employee_key:l order_date_key:l grand_total:d status:s is_cancel:l",
        f"""SELECT o.id AS order_id, reference_no, customer_key, staff_key AS employee_key, {_dk('date')} AS order_date_key, grand_total, status, is_cancel
            FROM r_raw_orders o LEFT JOIN r_known_customers c USING (customer_id) LEFT JOIN r_known_staff s ON s.staff_id = o.employee_id""",
    ),
    "fact_order_items": (
        "order_item_id:s order_id:l customer_key:l product_key:l order_date_key:l quantity:d amount:d total_amount:d",
        f"""SELECT i.id AS order_item_id, order_id, customer_key, product_key, {_dk('o.date')} AS order_date_key, quantity, amount, total_amount
            FROM r_raw_order_items i JOIN r_raw_orders o ON o.id = i.order_id LEFT JOIN r_known_customers c USING (customer_id)
            LEFT JOIN r_known_products p ON p.product_id = i.item_id""",
    ),
    "fact_delivery_items": (
        "delivery_item_id:s delivery_id:l order_item_id:s customer_key:l product_key:l warehouse_key:l location_key:l delivery_date_key:l quantity:d amount:d",
        f"""SELECT i.id AS delivery_item_id, delivery_id, order_item_id, customer_key, product_key, warehouse_key, NULL AS location_key,
              {_dk('d.date')} AS delivery_date_key, quantity, amount
            FROM r_raw_delivery_items i JOIN r_raw_deliveries d ON d.id = i.delivery_id LEFT JOIN r_known_customers c USING (customer_id)
            LEFT JOIN r_known_products p ON p.product_id = i.item_id LEFT JOIN r_known_warehouses w USING (warehouse_id)""",
    ),
    "fact_warehouse_stock": (
        "stock_id:s product_key:l material_key:l warehouse_key:l location_key:l import_date_key:l quantity:d quantity_left:d price:d type_items:s",
        f"""SELECT i.id AS stock_id, product_key, material_key, warehouse_key, location_key, {_dk('date_import')} AS import_date_key, quantity,
              quantity_left, price, type_items
            FROM r_raw_stock i LEFT JOIN r_known_products p ON type_items = 'product' AND p.product_id = i.product_id
            LEFT JOIN r_known_materials m ON type_items = 'nvl' AND m.material_id = i.product_id
            LEFT JOIN r_known_warehouses w USING (warehouse_id) LEFT JOIN r_known_locations l ON l.location_id = i.localtion""",
    ),
    "fact_purchase_order_items": (
        "po_item_id:s po_id:l product_key:l material_key:l supplier_key:l po_date_key:l quantity:d total_suppliers:d type:s",
        f"""SELECT i.id AS po_item_id, id_purchase_order AS po_id, product_key, material_key, supplier_key, {_dk('h.date')} AS po_date_key, quantity, total_suppliers, type
            FROM r_raw_po_items i JOIN r_raw_po h ON h.id = i.id_purchase_order
            LEFT JOIN r_known_products p ON type <> 'nvl' AND p.product_id = i.product_id
            LEFT JOIN r_known_materials m ON type = 'nvl' AND m.material_id = i.product_id
            LEFT JOIN r_known_suppliers s ON s.supplier_id = h.suppliers_id""",
    ),
    "fact_production_order_items": (
        "prod_item_id:s productions_orders_id:l product_key:l prod_date_key:l quantity:d type_items:s",
        f"""SELECT i.id AS prod_item_id, productions_orders_id, product_key, coalesce({_dk('h.date')}, 19000101) AS prod_date_key, quantity, type_items
            FROM r_raw_production_items i LEFT JOIN r_raw_production_orders h ON h.id = i.productions_orders_id
            LEFT JOIN r_known_products p ON p.product_id = i.items_id""",
    ),
    "fact_production_stages": (
        "prod_stage_id:l productions_orders_id:l staff_key:l stage_date_key:l number_face:d active:l",
        f"""SELECT id AS prod_stage_id, productions_orders_id, staff_key, coalesce({_dk('date_active')}, 19000101) AS stage_date_key, number_face, active
            FROM r_raw_stages s LEFT JOIN r_known_staff k ON k.staff_id = s.staff_active""",
    ),
    "fact_purchase_product_items": (
        "pp_item_id:s purchase_product_id:l product_key:l warehouse_key:l location_key:l import_date_key:l quantity:d amount:d",
        f"""SELECT i.id AS pp_item_id, purchase_product_id, product_key, warehouse_key, location_key, coalesce({_dk('h.date')}, 19000101) AS import_date_key, quantity, amount
            FROM r_raw_receipt_items i JOIN r_raw_receipts h ON h.id = i.purchase_product_id LEFT JOIN r_known_products p ON p.product_id = i.item_id
            LEFT JOIN r_known_warehouses w USING (warehouse_id) LEFT JOIN r_known_locations l USING (location_id)""",
    ),
    "fact_warehouse_export": (
        "export_id:s product_key:l material_key:l warehouse_key:l location_key:l export_date_key:l quantity:d type_items:s type_export:s",
        f"""SELECT i.id AS export_id, product_key, material_key, warehouse_key, location_key, coalesce({_dk('date_export')}, 19000101) AS export_date_key,
              quantity, type_items, cast(type_export as varchar) AS type_export
            FROM r_raw_export i LEFT JOIN r_known_products p ON type_items <> 'nvl' AND p.product_id = i.product_id
            LEFT JOIN r_known_materials m ON type_items = 'nvl' AND m.material_id = i.product_id
            LEFT JOIN r_known_warehouses w USING (warehouse_id) LEFT JOIN r_known_locations l ON l.location_id = i.localtion""",
    ),
    "fact_transfer_warehouse": (
        "transfer_detail_id:s transfer_id:l product_key:l warehouse_from_key:l warehouse_to_key:l location_from_key:l location_to_key:l quantity:d amount:d",
        """SELECT i.id AS transfer_detail_id, id_transfer AS transfer_id, product_key, a.warehouse_key AS warehouse_from_key, b.warehouse_key AS warehouse_to_key,
             c.location_key AS location_from_key, d.location_key AS location_to_key, quantity, amount
           FROM r_raw_transfers i LEFT JOIN r_known_products p ON p.product_id = i.id_items
           LEFT JOIN r_known_warehouses a ON a.warehouse_id = i.warehouses_id LEFT JOIN r_known_warehouses b ON b.warehouse_id = i.warehouses_to
           LEFT JOIN r_known_locations c ON c.location_id = i.localtion_id LEFT JOIN r_known_locations d ON d.location_id = i.localtion_to""",
    ),
}
for _fact, (_spec, _sql) in FACT_CASES.items():
    part(f"k_{_fact}", _sql)
    query(f"core_{_fact}", _spec, f"SELECT * FROM k_{_fact}")(lambda e, f=_fact: _rows(e, f))

ORDER_SPEC = FACT_CASES["fact_orders"][0]


@query(
    "core_insert_if_absent",
    ORDER_SPEC,
    "SELECT * REPLACE (CASE WHEN order_date_key < 20000101 THEN 'stored' ELSE status END AS status) FROM k_fact_orders",
)
def _insert(e: Erp):
    # stored: orders before 2000 with another status; the batch holds every order
    rows = _rows(e, "fact_orders")
    stored = rows.filter(F.col("order_date_key") < 20000101).withColumn("status", F.lit("stored"))
    return upsert.insert_if_absent(stored, rows, "order_id")


@query(
    "core_heal_keys",
    ORDER_SPEC + " key_fixed:b",
    """SELECT f.* REPLACE (CASE WHEN f.customer_key IS NULL OR f.employee_key IS NULL THEN coalesce(o.customer_id + 1, f.customer_key) ELSE f.customer_key END AS customer_key,
         CASE WHEN f.customer_key IS NULL OR f.employee_key IS NULL THEN coalesce(s.staff_key, f.employee_key) ELSE f.employee_key END AS employee_key),
         f.customer_key IS NULL OR f.employee_key IS NULL AS key_fixed
       FROM k_fact_orders f JOIN r_raw_orders o ON o.id = f.order_id LEFT JOIN r_known_staff s ON s.staff_id = o.employee_id""",
)
def _heal(e: Erp):
    # the fact was loaded while customers in debt were unknown; now all are on file
    stored = _rows(e, "fact_orders")
    dims = _known(e) | {"dim_customer": e.customers.select("customer_id", "customer_key")}
    fresh = core.fact_rows("fact_orders", {"tbl_orders": e.raw_orders}, dims)
    return upsert.heal_keys(stored, fresh.select("order_id", "customer_key", "employee_key"), "order_id", ["customer_key", "employee_key"])


@query(
    "core_heal_stock_keys",
    FACT_CASES["fact_warehouse_stock"][0] + " key_fixed:b",
    """SELECT f.* REPLACE (CASE WHEN fix THEN CASE f.type_items WHEN 'product' THEN pid + 1 END ELSE f.product_key END AS product_key,
         CASE WHEN fix THEN CASE f.type_items WHEN 'nvl' THEN pid + 1 END ELSE f.material_key END AS material_key,
         CASE WHEN fix THEN loc + 1 ELSE f.location_key END AS location_key) , fix AS key_fixed
       FROM (SELECT f.*, i.product_id AS pid, i.localtion AS loc, (f.type_items = 'product' AND product_key IS NULL) OR (f.type_items = 'nvl' AND material_key IS NULL)
               OR location_key IS NULL AS fix FROM k_fact_warehouse_stock f JOIN r_raw_stock i ON i.id = f.stock_id) f""",
)
def _heal_stock(e: Erp):
    stored = _rows(e, "fact_warehouse_stock")
    dims = _known(e) | {
        "dim_product": e.products, "dim_material": e.materials,
        "dim_warehouse_location": e.suppliers.select(
            F.col("supplier_id").alias("location_id"), F.col("supplier_key").alias("location_key")
        ),
    }
    fresh = core.fact_rows("fact_warehouse_stock", {"tblwarehouse_product": e.raw_stock}, dims)
    needs, clear = core.heal_conditions("fact_warehouse_stock")
    keys = ["product_key", "material_key", "location_key"]
    return upsert.heal_keys(stored, fresh.select("stock_id", "type_items", *keys), "stock_id", keys, needs, clear)


@query(
    "core_replace_by_key",
    FACT_CASES["fact_warehouse_export"][0],
    "SELECT * REPLACE (CASE WHEN export_date_key >= 20000101 THEN quantity ELSE -1 END AS quantity) FROM k_fact_warehouse_export",
)
def _replace(e: Erp):
    # every row is stored with quantity -1; the batch brings the rows from 2000 on again
    rows = _rows(e, "fact_warehouse_export")
    stored = rows.withColumn("quantity", F.lit(-1).cast("decimal(22,4)"))
    return upsert.replace_by_key(stored, rows.filter(F.col("export_date_key") >= 20000101), "export_id")


@query(
    "core_replace_by_file",
    FACT_CASES["fact_warehouse_export"][0],
    """SELECT * REPLACE (CASE WHEN export_id = (SELECT min(export_id) FROM k_fact_warehouse_export) THEN -2 WHEN export_date_key >= 20000101 THEN quantity ELSE -1 END AS quantity)
       FROM k_fact_warehouse_export""",
)
def _replace_by_file(e: Erp):
    """A stored fact, replaced by file: first by the rows from 2000 on (keys joined), then by one row (key pushed into the scan)."""
    schema = f"core_{uuid.uuid4().hex}"
    e.spark.sql(f"CREATE DATABASE {schema} LOCATION '{work_dir(e.spark)}/{schema}'")
    rows = sinks.with_year(_rows(e, "fact_warehouse_export"), "export_date_key")
    table = f"{schema}.fact_warehouse_export"
    sinks.append_rows(rows.withColumn("quantity", F.lit(-1).cast("decimal(22,4)")), table, "year", "export_id")
    first = rows.select(F.min("export_id").alias("export_id"))
    for batch in (rows.filter(F.col("export_date_key") >= 20000101), rows.join(first, "export_id").withColumn("quantity", F.lit(-2).cast("decimal(22,4)"))):
        runner.replace_rows(e.spark.table(table), written(batch, "batch"), "export_id", table)
    out = written(e.spark.table(table), "replaced")
    e.spark.sql(f"DROP DATABASE {schema} CASCADE")
    return out


@query(
    "core_resolve_keys",
    "id:s product_key:l any_product_key:l",
    """SELECT i.id, p.product_key, q.product_key AS any_product_key FROM r_raw_stock i
       LEFT JOIN r_known_products p ON type_items = 'product' AND p.product_id = i.product_id
       LEFT JOIN r_known_products q ON q.product_id = i.product_id""",
)
def _resolve(e: Erp):
    args = (e.known_products, "product_id", "product_id", "product_key")
    rows = resolve_key(e.raw_stock, *args, "__p", F.col("type_items") == "product")
    return resolve_key(rows, *args, "any_product_key").withColumn("product_key", F.col("__p"))


for _reset in (False, True):
    _hit = "listed" if _reset else "listed AND m.material_key IS NOT NULL"

    @query(
        "core_rekey_material_reset" if _reset else "core_rekey_material",
        "stock_id:s product_key:l material_key:l",
        f"""SELECT stock_id, CASE WHEN {_hit} THEN NULL ELSE f.pk END AS product_key, CASE WHEN {_hit} THEN m.material_key END AS material_key
            FROM (SELECT id AS stock_id, product_id, product_id + 1 AS pk, type_items = 'nvl' AS listed FROM r_raw_stock) f
            LEFT JOIN r_known_materials m ON m.material_id = f.product_id""",
    )
    def _rekey(e: Erp, reset=_reset):
        # all lots were loaded with a product key, raw materials included
        fact = e.raw_stock.select(
            F.col("id").alias("stock_id"), (F.col("product_id") + 1).alias("product_key"), F.lit(None).cast("bigint").alias("material_key")
        )
        listed = e.raw_stock.filter(F.col("type_items") == "nvl").select(F.col("id").alias("stock_id"), "product_id")
        return upsert.rekey_materials(fact, listed, e.known_materials, "stock_id", "product_id", reset)


query(
    "core_anonymize",
    "customer_key:l customer_code:s company:s debt_limit:d is_anonymized:b",
    """SELECT customer_key, customer_code, 'Khach Hang ' || CASE WHEN n < 1000 THEN lpad(n::varchar, 3, '0') ELSE n::varchar END AS company,
         debt_limit * 0.1 AS debt_limit, true AS is_anonymized
       FROM (SELECT *, row_number() OVER (ORDER BY customer_key) AS n FROM r_customers)""",
)(lambda e: anonymize(e.customers, "customer_key", "customer", ["company"], ["debt_limit"]))


@query(
    "core_anonymize_partial",
    "customer_key:l customer_code:s company:s debt_limit:d is_anonymized:b",
    """SELECT customer_key, customer_code, 'Khach Hang ' || CASE WHEN n < 1000 THEN lpad(n::varchar, 3, '0') ELSE n::varchar END AS company,
         debt_limit * 0.1 AS debt_limit, true AS is_anonymized
       FROM (SELECT *, row_number() OVER (ORDER BY customer_key % 3 = 0, customer_key) AS n FROM r_customers)""",
)
def _anonymize_partial(e: Erp):
    # two thirds are done; the rest came later, as rows without the flag
    late = F.col("customer_key") % 3 == 0
    done = anonymize(e.customers.filter(~late), "customer_key", "customer", ["company"], ["debt_limit"])
    rows = done.unionByName(e.customers.filter(late).withColumn("is_anonymized", F.lit(None).cast("boolean")))
    return anonymize(rows, "customer_key", "customer", ["company"], ["debt_limit"])


@query(
    "core_upsert_missing_column",
    "customer_key:l customer_id:l customer_code:s company:s debt_limit:d",
    """SELECT row_number() OVER (ORDER BY userid) AS customer_key, userid AS customer_id, 'new' AS customer_code, company, debt_limit FROM r_raw_clients""",
)
def _upsert_missing(e: Erp):
    # the second batch has neither company nor debt_limit: both keep what is stored
    first = core.load_dim("dim_customer", None, e.raw_clients)
    return core.load_dim("dim_customer", first, e.raw_clients.drop("company", "debt_limit").withColumn("code_client", F.lit("new")))


@query(
    "core_date_dim",
    "date_key:l full_date:t day_of_week:l day_name:s week_of_year:l quarter:l is_weekend:b is_holiday:b shipments:l",
    """SELECT date_key, full_date, day_of_week, day_name, week_of_year, quarter, is_weekend, is_holiday, coalesce(n, 0) AS shipments
       FROM r_dates LEFT JOIN (SELECT cast(l_shipdate as date) AS d, count(*) AS n FROM lineitem GROUP BY 1) ON d = full_date""",
)
def _date_dim(e: Erp):
    # the calendar next to the shipments of each day
    days = date_dim(e.spark, date(1995, 1, 1), date(2005, 12, 31))
    shipped = e.table("lineitem").groupBy(F.to_date("l_shipdate").alias("full_date")).agg(F.count(F.lit(1)).alias("n"))
    return days.join(shipped, "full_date", "left").withColumn("shipments", F.coalesce("n", F.lit(0)))


@query(
    "core_runner_counts",
    "load:l step:s status:s keys_fixed:l rows_inserted:l unresolved:l",
    """WITH o AS (SELECT o.id, o.date < TIMESTAMP '2000-01-01' AS early, c.userid IS NOT NULL AS has_customer, c.debt_limit >= 0 AS known_first, s.staffid IS NOT NULL AS has_staff
            FROM r_raw_orders o LEFT JOIN r_raw_clients c ON c.userid = o.customer_id LEFT JOIN r_raw_staff s ON s.staffid = o.employee_id),
         n AS (SELECT count(*) FILTER (early) AS first_rows, count(*) AS all_rows,
            count(*) FILTER (early AND (NOT coalesce(known_first, false) OR NOT has_staff)) AS late, count(*) FILTER (early AND NOT coalesce(known_first, false)) AS open_first,
            count(*) FILTER (NOT has_customer OR NOT has_staff) AS never, count(*) FILTER (NOT has_customer) AS open_last FROM o),
         d AS (SELECT (SELECT count(*) FROM r_raw_clients WHERE debt_limit >= 0) AS c1, (SELECT count(*) FROM r_raw_clients) AS c2, (SELECT count(*) FROM r_raw_staff) AS s1)
       SELECT l AS load, step, 'ok' AS status, fixed AS keys_fixed, inserted AS rows_inserted, unresolved FROM (
         SELECT 1 AS l, 'dim_customer' AS step, 0 AS fixed, c1 AS inserted, NULL AS unresolved FROM d
         UNION ALL SELECT 2, 'dim_customer', 0, c2 - c1, NULL FROM d
         UNION ALL SELECT 3, 'dim_customer', 0, 0, NULL
         UNION ALL SELECT 1, 'dim_staff', 0, s1, NULL FROM d
         UNION ALL SELECT l, 'dim_staff', 0, 0, NULL FROM (VALUES (2), (3)) v(l)
         UNION ALL SELECT 1, 'fact_orders', 0, first_rows, open_first FROM n
         UNION ALL SELECT 2, 'fact_orders', late, all_rows - first_rows, open_last FROM n
         UNION ALL SELECT 3, 'fact_orders', never, 0, open_last FROM n)""",
)
def _runner(e: Erp):
    """Three runs of the step runner: a first load without the customers in debt, a second in which these come late
    (stored orders are healed) beside the orders from 2000 on, and a replay of the second."""
    root, mark = work_dir(e.spark), uuid.uuid4().hex
    names = {x: f"{x}_{mark}" for x in ("raw", "core")}
    for name in names.values():
        e.spark.sql(f"CREATE DATABASE {name} LOCATION '{root}/{name}'")
    star = runner.Star(e.spark, names["raw"], names["core"])
    early = F.col("date") < F.lit("2000-01-01").cast("timestamp_ntz")
    sinks.replace_table(e.raw_staff, f"{names['raw']}.tblstaff")
    rows = []
    for load in (1, 2, 3):
        if load < 3:
            sinks.replace_table(e.raw_clients.filter("debt_limit >= 0" if load == 1 else "true"), f"{names['raw']}.tblclients")
            sinks.replace_table(e.raw_orders.filter(early if load == 1 else F.lit(True)), f"{names['raw']}.tbl_orders")
        status = runner.run_transforms(star, ["dim_customer", "dim_staff", "fact_orders"]).collect()  # one row per step
        unresolved = e.spark.table(star.core("fact_orders")).filter("customer_key is null").count()
        rows += [(load, r["step"], r["status"], r["keys_fixed"], r["rows_inserted"], unresolved if r["step"] == "fact_orders" else None) for r in status]
    for name in names.values():
        e.spark.sql(f"DROP DATABASE {name} CASCADE")
    return e.spark.createDataFrame(rows, "load bigint, step string, status string, keys_fixed bigint, rows_inserted bigint, unresolved bigint")
