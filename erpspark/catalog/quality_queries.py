"""Data-quality queries."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F
from pyspark.sql import types as T

from erpspark.catalog import core_queries, marts  # noqa: F401 - their queries stand for tables checked here
from erpspark.catalog.registry import CHECKS, PLANS, Erp, query
from erpspark.catalog.roles import PARAMS
from erpspark.catalog.sqltext import div, part, pct, r
from erpspark.plans import quality as q
from erpspark.session import written

AS_OF = f"DATE '{PARAMS.as_of}'"
RESULT = "check_name:s subject:s status:s observed:d threshold:d"


def _result(check: str, subject: str, observed: str, threshold: object, ok: str, source: str, bad: str = "fail") -> str:
    return (
        f"SELECT '{check}' AS check_name, '{subject}' AS subject, CASE WHEN {ok} THEN 'ok' ELSE '{bad}' END AS status, "
        f"{observed} AS observed, {threshold} AS threshold FROM {source}"
    )


# declared NOT NULL columns of the facts, dimensions and marts the roles stand for
NOT_NULL = {
    "customers": ["customer_key", "customer_id", "customer_code"], "products": ["product_key", "product_id"],
    "materials": ["material_key", "material_id"], "suppliers": ["supplier_key", "supplier_id"],
    "warehouses": ["warehouse_key"], "orders": ["order_id", "order_date_key", "customer_key", "total_discount_percent"],
    "order_items": ["order_item_id", "order_id", "product_key"], "lots": ["stock_id", "product_key", "material_key"],
    "exports": ["export_id", "export_date_key"], "po_lines": ["po_item_id", "product_key"], "deliveries": ["delivery_item_id"],
    "stages": ["prod_stage_id", "stage_date_key"],
}
query(
    "dq_not_null",
    RESULT,
    " UNION ALL ".join(
        _result("not_null", f"{t}.{c}", "n", 0, "n = 0", f"(SELECT count(*) FILTER ({c} IS NULL) AS n FROM r_{t})")
        for t, cs in NOT_NULL.items()
        for c in cs
    ),
)(lambda e: q.union_all([q.not_null(e.role(t), t, cs) for t, cs in NOT_NULL.items()]))

UNIQUE = {
    "customers": "customer_id", "products": "product_code", "materials": "material_id", "suppliers": "supplier_id",
    "orders": "order_id", "order_items": "order_id", "lots": "stock_id", "stages": "prod_stage_id", "po_lines": "material_key",
}
query(
    "dq_unique",
    RESULT,
    " UNION ALL ".join(
        _result(
            "unique", f"{t}.{c}", "n", 0, "n = 0",
            f"(SELECT count(*) AS n FROM (SELECT {c} FROM r_{t} WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) > 1))",
        )
        for t, c in UNIQUE.items()
    ),
)(lambda e: q.union_all([q.unique(e.role(t), t, c) for t, c in UNIQUE.items()]))

query(
    "dq_month_stock_not_negative",
    RESULT,
    _result("month_stock_not_negative", "fct_stock_monthly_snapshot", "n", 0, "n = 0",
            "(SELECT count(*) AS n FROM m_monthly WHERE est_qty_end_month < 0)"),
)(lambda e: q.month_stock_not_negative(e.monthly))

CORE_ROLES = {
    "dim_customer": "customers", "dim_product": "products", "dim_warehouse": "warehouses", "dim_supplier": "suppliers",
    "dim_staff": "staff", "fact_orders": "orders", "fact_order_items": "order_items", "fact_delivery_items": "deliveries",
    "fact_warehouse_stock": "lots", "fact_purchase_order_items": "po_lines", "fact_production_order_items": "production_items",
    "fact_production_stages": "stages",
    # one row of the dimension or fact per row of these
    "dim_date": "dates", "dim_department": "raw_departments", "dim_price_group": "raw_groups",
    "dim_warehouse_location": "raw_locations", "dim_manufacture": "raw_manufactures",
    "fact_purchase_product_items": "raw_receipt_items", "fact_transfer_warehouse": "raw_transfers",
}
query(
    "dq_min_rows",
    RESULT,
    " UNION ALL ".join(
        _result("min_rows", t, "n", q.MIN_ROWS[t], f"n >= {q.MIN_ROWS[t]}", f"(SELECT count(*) AS n FROM r_{role})")
        for t, role in CORE_ROLES.items()
    ),
)(lambda e: q.union_all([q.min_rows(e.role(role), t) for t, role in CORE_ROLES.items()]))

LIMITS = [
    ("fact_orders", "customer_key", 0.5, None),
    ("fact_orders", "employee_key", 5.0, None),
    ("fact_order_items", "product_key", 0.5, None),
    ("fact_delivery_items", "product_key", 0.5, None),
    ("fact_production_order_items", "product_key", 0.5, None),
    ("fact_warehouse_stock", "product_key", 2.0, 60.0),  # raw materials carry no product key
    ("fact_warehouse_stock", "location_key", 1.0, None),
    ("fact_purchase_order_items", "product_key", 20.0, 14.78),
]


def _null_rate(t: str, c: str, limit: float, known: float | None) -> str:
    slack = f"WHEN s < {known} * 1.5 THEN 'warn' " if known else ""
    return (
        f"SELECT 'null_rate' AS check_name, '{t}.{c}' AS subject, CASE WHEN s <= {limit} THEN 'ok' {slack}ELSE 'fail' END AS status, "
        f"{r('s', 4)} AS observed, {limit} AS threshold FROM (SELECT {div(f'count(*) FILTER ({c} IS NULL) * 100', 'count(*)')} AS s FROM r_{CORE_ROLES[t]})"
    )


query("dq_null_rates", RESULT, " UNION ALL ".join(_null_rate(*x) for x in LIMITS))(
    lambda e: q.union_all([q.null_rates(e.role(CORE_ROLES[t]), t, LIMITS) for t in dict.fromkeys(x[0] for x in LIMITS)])
)

MARTS = {
    "fct_revenue": ("revenue", "m_revenue"), "fct_order_performance": ("performance", "m_performance"),
    "fct_gross_profit": ("profit", "m_profit"), "dim_customer_segmentation": ("segmentation", "m_segmentation"),
    "fct_purchase_cost": ("purchases", "m_purchase"), "dim_customer_credit": ("credit", "m_credit"),
    "fct_stock_snapshot": ("snapshot", "m_snapshot"), "fct_inbound_outbound": ("moves", "m_moves"),
    "fct_production_npl_cost": ("plan_cost", "m_plan_cost"), "fct_order_npl_cost": ("order_cost", "m_order_cost"),
    "dim_material_mart": ("material_mart", "m_material"),
    "fct_order_items_detail": ("detail", "k_detail"), "fct_production_efficiency": ("efficiency", "m_efficiency"),
    "dim_customer_mart": ("customers", "k_customers"), "dim_product_mart": ("product_mart", "m_product"),
}
query(
    "dq_mart_volume",
    RESULT,
    " UNION ALL ".join(
        _result("mart_volume", m, "n", q.LOW_VOLUME.get(m, 1), f"n >= {q.LOW_VOLUME.get(m, 1)}", f"(SELECT count(*) AS n FROM {cte})", "warn")
        for m, (_, cte) in MARTS.items()
    ),
)(lambda e: q.union_all([q.mart_volume(getattr(e, attr), m) for m, (attr, _) in MARTS.items()]))

part(
    "k_marks",
    """SELECT 'orders' AS table_name, cast(cast(max(o_orderdate) as date) as varchar) AS last_loaded_at FROM orders
       UNION ALL SELECT 'lineitem', cast(cast(max(l_shipdate) as date) as varchar) FROM lineitem
       UNION ALL SELECT 'events', cast(max(event_id) as varchar) FROM events""",
)


def marks(e: Erp):
    """High-water marks the three tables would leave: two dates and an id."""
    tables = [
        ("orders", F.max("o_orderdate").cast("date")), ("lineitem", F.max("l_shipdate").cast("date")), ("events", F.max("event_id")),
    ]
    return q.union_all(
        [e.table(t).agg(top.cast("string").alias("last_loaded_at")).select(F.lit(t).alias("table_name"), "last_loaded_at") for t, top in tables]
    )


query(
    "dq_freshness",
    RESULT,
    f"""SELECT 'freshness' AS check_name, table_name AS subject, CASE WHEN last_loaded_at IS NULL OR age > 2 THEN 'warn' ELSE 'ok' END AS status,
          age AS observed, 2 AS threshold FROM (SELECT *, {AS_OF} - try_cast(left(last_loaded_at, 10) as date) AS age FROM k_marks)""",
)(lambda e: q.freshness(marks(e), PARAMS.as_of))

# --- reconciliation: the lots, and a copy whose export counter lags behind ---------------
part(
    "k_drifted",
    "SELECT * REPLACE (CASE WHEN l.type_items = 'semi' THEN l.quantity_left - l.quantity ELSE l.quantity_left END AS quantity_left) FROM r_lots l",
)


def drifted(e: Erp):
    left, qty = F.col("quantity_left"), F.col("quantity")
    return e.lots.withColumn("quantity_left", F.when(F.col("type_items") == "semi", left - qty).otherwise(left))


BALANCE = "total_lots:l lots_drift:l total_in:d total_out:d total_left:d expected_left:d drift:d status:s"
for _name, _src, _get in (("dq_lot_balance", "r_lots", lambda e: e.lots), ("dq_lot_balance_drifted", "k_drifted", drifted)):
    query(
        _name,
        BALANCE,
        f"""SELECT *, CASE WHEN abs(drift) < 0.01 AND lots_drift = 0 THEN 'ok' ELSE 'warn' END AS status FROM (
              SELECT count(*) AS total_lots, count(*) FILTER (abs(quantity_left - quantity + quantity_export) > 0.001) AS lots_drift,
                round(sum(quantity), 2) AS total_in, round(sum(quantity_export), 2) AS total_out, round(sum(quantity_left), 2) AS total_left,
                round(sum(quantity) - sum(quantity_export), 2) AS expected_left,
                round(sum(quantity_left) - sum(quantity) + sum(quantity_export), 2) AS drift FROM {_src})""",
    )(lambda e, g=_get: q.lot_balance(g(e)))
query(
    "dq_lot_drift_top",
    "stock_id:s product_key:l warehouse_key:l quantity:d quantity_export:d quantity_left:d expected_left:d drift:d",
    """SELECT *, quantity - quantity_export AS expected_left, quantity_left - quantity + quantity_export AS drift FROM k_drifted
       WHERE abs(quantity_left - quantity + quantity_export) > 0.001 ORDER BY abs(quantity_left - quantity + quantity_export) DESC, stock_id LIMIT 10""",
)(lambda e: q.lot_drift_top(drifted(e)))
query(
    "dq_snapshot_vs_moves",
    RESULT + " snapshot_total:d movement_total:d",
    " UNION ALL ".join(
        f"""SELECT 'snapshot_vs_moves' AS check_name, '{n}' AS subject, CASE WHEN coalesce(gap, 0) < {lim} THEN 'ok' ELSE 'warn' END AS status,
              {r('coalesce(gap, 0)', 4)} AS observed, {lim} AS threshold, a AS snapshot_total, b AS movement_total
            FROM (SELECT a, b, {div('abs(a - b) * 100', base)} AS gap FROM (SELECT round(sum({x}), 0) AS a FROM m_snapshot), (SELECT round(sum({y}), 0) AS b FROM m_moves))"""
        for n, x, y, base, lim in (
            ("receipts", "quantity", "quantity_in", "b", 0.1), ("issues", "quantity_exported", "quantity_out", "b", 5.0),
            ("stock", "quantity_left", "quantity_in - quantity_out", "a", 5.0),
        )
    ),
)(lambda e: q.snapshot_against_moves(e.snapshot, e.moves))
query(
    "dq_warehouse_drift",
    "warehouse_name:s snap_in:d snap_out:d snap_left:d io_in:d io_out:d io_net:d drift:d",
    """SELECT *, io_in - io_out AS io_net, snap_left - (io_in - io_out) AS drift
       FROM (SELECT warehouse_key, warehouse_name, round(sum(quantity), 0) AS snap_in, round(sum(quantity_exported), 0) AS snap_out,
               round(sum(quantity_left), 0) AS snap_left FROM m_snapshot GROUP BY ALL)
       LEFT JOIN (SELECT warehouse_key, round(sum(quantity_in), 0) AS io_in, round(sum(quantity_out), 0) AS io_out FROM m_moves GROUP BY 1) USING (warehouse_key)
       ORDER BY abs(snap_left - (io_in - io_out)) DESC NULLS LAST, warehouse_key LIMIT 10""",
)(lambda e: q.warehouse_drift(e.snapshot, e.moves))
query(
    "dq_lot_anomalies",
    "lots_negative:l lots_overexport:l total_negative:d status:s",
    """SELECT *, CASE WHEN lots_negative = 0 AND lots_overexport = 0 THEN 'ok' ELSE 'warn' END AS status
       FROM (SELECT count(*) FILTER (quantity_left < 0) AS lots_negative, count(*) FILTER (quantity_export > quantity) AS lots_overexport,
               round(sum(quantity_left) FILTER (quantity_left < 0), 0) AS total_negative FROM k_drifted)""",
)(lambda e: q.lot_anomalies(drifted(e)))
query(
    "dq_worst_lots",
    "stock_id:s product_code:s product_name:s warehouse_name:s quantity:d quantity_export:d quantity_left:d",
    """SELECT * FROM (SELECT * REPLACE (quantity_left - quantity AS quantity_left) FROM r_lots) JOIN r_products USING (product_key)
       JOIN r_warehouses USING (warehouse_key) WHERE quantity_left < 0 ORDER BY quantity_left, stock_id LIMIT 10""",
)(
    # stock after a second issue of the received quantity
    lambda e: q.worst_lots(
        e.lots.withColumn("quantity_left", F.col("quantity_left") - F.col("quantity")), e.products, e.warehouses
    )
)
query(
    "dq_yearly_flow",
    "year:l quantity_in:d quantity_out:d net:d net_pct:d status:s",
    f"""SELECT year, round(i, 0) AS quantity_in, round(o, 0) AS quantity_out, round(i - o, 0) AS net, {pct('i - o', 'i', 1)} AS net_pct,
          CASE WHEN o > i THEN 'warn' ELSE 'ok' END AS status
        FROM (SELECT year, sum(quantity_in) AS i, sum(quantity_out) AS o FROM m_moves WHERE year IS NOT NULL GROUP BY year)""",
)(lambda e: q.yearly_flow(e.moves))


@query(
    "dq_date_dim",
    RESULT,
    # the days orders were placed on, checked as a calendar of their own span
    """WITH s AS (SELECT count(*) AS n, min(full_date) AS a, max(full_date) AS b, count(DISTINCT date_key) AS k,
            count(*) FILTER (is_weekend <> (day_of_week IN (0, 6))) AS w, count(*) FILTER (date_key <> cast(strftime(full_date, '%Y%m%d') as int)) AS f
          FROM r_dates WHERE full_date IN (SELECT cast(o_orderdate as date) FROM orders))
       SELECT 'date_dim' AS check_name, 'row_count' AS subject, CASE WHEN n = DATE '2001-12-31' - DATE '1995-01-01' + 1 THEN 'ok' ELSE 'fail' END AS status, n AS observed, DATE '2001-12-31' - DATE '1995-01-01' + 1 AS threshold FROM s
       UNION ALL SELECT 'date_dim', 'first_day', CASE WHEN a = DATE '1995-01-01' THEN 'ok' ELSE 'fail' END, a - DATE '1995-01-01', 0 FROM s
       UNION ALL SELECT 'date_dim', 'last_day', CASE WHEN b = DATE '2001-12-31' THEN 'ok' ELSE 'fail' END, b - DATE '2001-12-31', 0 FROM s
       UNION ALL SELECT 'date_dim', 'unique_key', CASE WHEN k = n THEN 'ok' ELSE 'fail' END, n - k, 0 FROM s
       UNION ALL SELECT 'date_dim', 'weekend_rule', CASE WHEN w = 0 THEN 'ok' ELSE 'fail' END, w, 0 FROM s
       UNION ALL SELECT 'date_dim', 'key_format', CASE WHEN f = 0 THEN 'ok' ELSE 'fail' END, f, 0 FROM s""",
)
def _date_dim(e: Erp):
    used = e.table("orders").select(F.to_date("o_orderdate").alias("full_date"))
    return q.date_dim_checks(e.dates.join(used, "full_date", "left_semi"), date(1995, 1, 1), date(2001, 12, 31))


EXPECTED = {
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string, o_clerk string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size bigint, p_retailprice double",
}
_DUCK = {"BIGINT": "bigint", "VARCHAR": "string", "DOUBLE": "double", "TIMESTAMP": "timestamp_ntz", "INTEGER": "int"}


def _schema_sql() -> str:
    want = ", ".join(
        "('{}', '{}', '{}')".format(t, *item.split()) for t, ddl in EXPECTED.items() for item in ddl.split(", ")
    )
    names = " ".join(f"WHEN '{d}' THEN '{s}'" for d, s in _DUCK.items())
    filled = " UNION ALL ".join(
        f"SELECT '{t}' AS ft, '{c}' AS fc, count({c}) AS n FROM {t}"
        for t, ddl in EXPECTED.items()
        for c in (item.split()[0] for item in ddl.split(", "))
        if c != "o_clerk"
    )
    return f"""SELECT w.t AS table_name, w.c AS column_name, w.k AS expected, have AS found, coalesce(n, 0) AS filled,
                 CASE WHEN have = w.k THEN 'ok' WHEN have IS NULL THEN 'fail' ELSE 'warn' END AS status
               FROM (VALUES {want}) w(t, c, k) LEFT JOIN (SELECT table_name AS ht, column_name AS hc, CASE data_type {names} END AS have
                 FROM information_schema.columns) h ON h.ht = w.t AND h.hc = w.c
               LEFT JOIN ({filled}) f ON f.ft = w.t AND f.fc = w.c"""


@query("dq_schema", "table_name:s column_name:s expected:s found:s filled:l status:s", _schema_sql())
def _schema(e: Erp):
    """Declared columns against the tables, with the number of values each column holds."""
    frames = []
    for t, ddl in EXPECTED.items():
        df = e.table(t)
        filled = q.filled_counts(df)
        checked = q.schema_check(df, t, T.StructType.fromDDL(ddl)).join(filled, "column_name", "left")
        frames.append(checked.withColumn("filled", F.coalesce("filled", F.lit(0))))
    return q.union_all(frames)


LAYERS = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]
query(
    "dq_layer_inventory",
    "table_name:s rows:l",
    " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS rows FROM {t}" for t in LAYERS),
)(lambda e: q.layer_inventory({t: e.table(t) for t in LAYERS}))
query(
    "dq_summary",
    "status:s checks:l",
    "SELECT CASE WHEN n = 0 THEN 'ok' ELSE 'fail' END AS status, count(*) AS checks FROM ("
    + " UNION ALL ".join(f"SELECT count(*) FILTER ({c} IS NULL) AS n FROM r_{t}" for t, cs in NOT_NULL.items() for c in cs)
    + ") GROUP BY 1",
)(lambda e: q.summary(q.union_all([q.not_null(e.role(t), t, cs) for t, cs in NOT_NULL.items()])))

# --- every declared check, one read per table ----------------------------------------------------------

# fixed values: declared columns per table of the core layer, its staging views and the marts, as
# table: (role, query or mart that stands for it, NOT NULL columns, unique columns)
CORE_DECLARED = {
    "dim_date": ("dates", "date_key", "date_key"), "dim_customer": ("customers", "customer_key customer_id", "customer_key"),
    "dim_product": ("products", "product_key product_id", "product_key"), "dim_staff": ("staff", "staff_key", "staff_key"),
    "dim_department": ("core_dim_department", "department_key", "department_key"),
    "dim_warehouse": ("warehouses", "warehouse_key", "warehouse_key"),
    "dim_warehouse_location": ("core_dim_warehouse_location", "location_key", "location_key"),
    "dim_supplier": ("suppliers", "supplier_key", "supplier_key"),
    "dim_manufacture": ("core_dim_manufacture", "manufacture_key", "manufacture_key"),
    "dim_price_group": ("core_dim_price_group", "price_group_key", "price_group_key"),
    "dim_material": ("materials", "material_key material_id", "material_key"),
    "fact_orders": ("orders", "order_id order_date_key", ""),
    "fact_order_items": ("core_fact_order_items", "order_item_id", ""),
    "fact_delivery_items": ("core_fact_delivery_items", "delivery_item_id", ""),
    "fact_warehouse_stock": ("lots", "stock_id", ""), "fact_warehouse_export": ("exports", "export_id", ""),
    "fact_purchase_order_items": ("po_lines", "po_item_id", ""),
    "fact_production_order_items": ("production_items", "prod_item_id", ""), "fact_production_stages": ("stages", "prod_stage_id", ""),
    "fact_purchase_product_items": ("core_fact_purchase_product_items", "pp_item_id", ""),
    "fact_transfer_warehouse": ("core_fact_transfer_warehouse", "transfer_detail_id", ""),
    "stg_customers": ("view_customers", "customer_key customer_id", "customer_key"),
    "stg_products": ("view_products", "product_key product_id", "product_key"), "stg_staff": ("view_staff", "staff_key staff_id", "staff_key"),
    "stg_suppliers": ("view_suppliers", "supplier_key supplier_id", "supplier_key"),
    "stg_materials": ("view_materials", "material_key material_id", "material_key"),
    "stg_warehouses": ("view_warehouses", "warehouse_key warehouse_id", "warehouse_key"), "stg_date": ("view_dates", "date_key", "date_key"),
    "stg_orders": ("view_orders", "order_id order_date_key", ""), "stg_order_items": ("view_order_items", "order_item_id", ""),
}
MART_DECLARED = {
    "int_orders_enriched": ("enriched", "order_id order_date_key", ""), "fct_purchase_cost": ("purchases", "po_date_key", ""),
    "dim_customer_credit": ("credit", "customer_key", "customer_key"), "fct_gross_profit": ("profit", "order_date_key", ""),
    "fct_production_npl_cost": ("plan_cost", "", "bom_line_id"), "fct_order_npl_cost": ("order_cost", "order_id", "order_id"),
    "fct_stock_snapshot": ("snapshot", "stock_id", "stock_id"), "fct_revenue": ("revenue", "order_date_key", ""),
    "fct_order_items_detail": ("detail", "order_item_id", ""), "fct_order_performance": ("performance", "order_id", "order_id"),
    "dim_customer_segmentation": ("segmentation", "customer_key", "customer_key"),
    "dim_customer_mart": ("view_customers", "customer_key", "customer_key"),
    "dim_material_mart": ("material_mart", "material_key material_id", "material_key"),
    "dim_product_mart": ("product_mart", "product_key", "product_key"),
    # declared without column checks: their rows are counted
    "fct_inbound_outbound": ("moves", "", ""), "fct_production_efficiency": ("efficiency", "", ""),
}
_MART_SQL = {attr: cte for attr, cte in MARTS.values()} | {"enriched": "k_enriched"}


def _rules(table: str, declared: dict[str, tuple[str, str, str]]) -> q.Rules:
    _, filled, keys = declared[table]
    return q.Rules(
        tuple(filled.split()), tuple(keys.split()), q.MIN_ROWS.get(table), q.LOW_VOLUME.get(table, 1) if table in MARTS else None,
        tuple(x[1:] for x in q.NULL_LIMITS if x[0] == table),
    )


def _declared_sql(table: str, declared: dict[str, tuple[str, str, str]]) -> str:
    name, rules = declared[table][0], _rules(table, declared)
    source = f"({CHECKS[name]})" if name in CHECKS else _MART_SQL.get(name, f"r_{name}")
    n_rows = f"(SELECT count(*) AS n FROM {source})"
    out = [_result("not_null", f"{table}.{c}", "n", 0, "n = 0", f"(SELECT count(*) FILTER ({c} IS NULL) AS n FROM {source})") for c in rules.not_null]
    out += [
        _result("unique", f"{table}.{c}", "n", 0, "n = 0", f"(SELECT count(*) AS n FROM (SELECT {c} FROM {source} WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) > 1))")
        for c in rules.unique
    ]
    if rules.least is not None:
        out.append(_result("min_rows", table, "n", rules.least, f"n >= {rules.least}", n_rows))
    if rules.volume is not None:
        out.append(_result("mart_volume", table, "n", rules.volume, f"n >= {rules.volume}", n_rows, "warn"))
    for c, limit, known in rules.null_rates:
        slack = f"WHEN s < {known} * 1.5 THEN 'warn' " if known else ""
        out.append(
            f"SELECT 'null_rate', '{table}.{c}', CASE WHEN s <= {limit} THEN 'ok' {slack}ELSE 'fail' END, {r('s', 4)}, {limit} "
            f"FROM (SELECT {div(f'count(*) FILTER ({c} IS NULL) * 100', 'count(*)')} AS s FROM {source})"
        )
    return " UNION ALL ".join(out)


def _declared(e: Erp, declared: dict[str, tuple[str, str, str]]):
    """One table after the other: in a single job the shuffles of all of them would lie on the disks together."""
    frames = []
    for table, (name, _, _) in declared.items():
        df = PLANS[name](e) if name in PLANS else getattr(e, name)
        frames.append(written(q.table_checks(df, table, _rules(table, declared)), "checks"))
    return q.union_all(frames)


for _name, _tables in (("dq_core_declared", CORE_DECLARED), ("dq_marts_declared", MART_DECLARED)):
    query(_name, RESULT, " UNION ALL ".join(_declared_sql(t, _tables) for t in _tables))(lambda e, d=_tables: _declared(e, d))
