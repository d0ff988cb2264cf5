"""Ordered load of the star schema, and the build of all marts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from erpspark.operators.lookup import sized
from erpspark.operators.upsert import heal_keys, new_rows, replace_by_key
from erpspark.plans import core, finance, inventory, production, sales, shared, views
from erpspark.session import written
from erpspark.settings import RunParams
from erpspark.sources import sinks

PRICE_GROUP_STEP = "dim_customer_price_group"
STEPS = [*core.DIMS, PRICE_GROUP_STEP, *core.FACTS]
SOFT_STEPS = {PRICE_GROUP_STEP}  # may fail without stopping the run


class Star:
    """Names of the raw and core tables in the session catalog."""

    def __init__(self, spark: SparkSession, raw_schema: str, core_schema: str):
        self.spark, self.raw_schema, self.core_schema = spark, raw_schema, core_schema

    def core(self, name: str) -> str:
        return f"{self.core_schema}.{name}"

    def raw_tables(self) -> dict[str, DataFrame]:
        names = [t.name for t in self.spark.catalog.listTables(self.raw_schema) if not t.name.endswith("__next")]
        return {n: self.spark.table(f"{self.raw_schema}.{n}") for n in names}

    def dims(self) -> dict[str, DataFrame]:
        return {d: self.spark.table(self.core(d)) for d in core.DIMS if sinks.exists(self.spark, self.core(d))}

    def key_maps(self, fact: str) -> dict[str, DataFrame]:
        """The dimensions that a fact looks up, for joins on their keys."""
        wanted = {k.dim for k in core.FACTS[fact].keys}
        return {d: sized(df, list(core.DIM_KEYS[d])) for d, df in self.dims().items() if d in wanted}


def _dim_step(star: Star, name: str) -> core.StepResult:
    raw = star.raw_tables()[core.DIMS[name].source]
    table = star.core(name)
    old = star.spark.table(table) if sinks.exists(star.spark, table) else None
    before = old.count() if old is not None else 0
    merged = core.load_dim(name, old, raw)
    if name == "dim_customer" and old is None:
        for c, kind in (("price_group_key", "bigint"), ("price_group_code", "string"), ("price_group_name", "string")):
            merged = merged.withColumn(c, F.lit(None).cast(kind))
    sinks.replace_table(merged, table)
    return core.StepResult(name, rows_inserted=star.spark.table(table).count() - before)


def _price_group_step(star: Star) -> core.StepResult:
    raw, table = star.raw_tables(), star.core("dim_customer")
    out = core.assign_price_groups(
        star.spark.table(table), raw["tblcustomer_groups"], star.spark.table(star.core("dim_price_group")),
        raw["tblcustomers_groups"],
    )
    sinks.replace_table(out, table)
    return core.StepResult(PRICE_GROUP_STEP)


def replace_rows(stored: DataFrame, rows: DataFrame, natural: str, table: str) -> int:
    """Replace by key, rewriting only the files that hold a key of the batch."""
    rows = sized(rows, [natural])
    files = sinks.files_holding(stored, rows, natural)
    kept = sinks.in_files(stored, files)
    sinks.replace_files(replace_by_key(kept, rows, natural), table, files, natural)
    return rows.count()


def heal_rows(stored: DataFrame, fresh: DataFrame, spec: core.FactSpec, name: str, table: str) -> int:
    """Heal keys, rewriting only the files with a row to heal."""
    needs, clear = core.heal_conditions(name)

    def healed(part: DataFrame) -> DataFrame:
        return heal_keys(part, fresh, spec.natural, list(spec.heal), needs, clear)

    touched = healed(sinks.with_file(stored)).filter("key_fixed").groupBy(sinks.FILE).count().collect()  # one row per file
    if touched:
        files = [r[sinks.FILE] for r in touched]
        sinks.replace_files(healed(sinks.in_files(stored, files)), table, files, spec.natural)
    return sum(r["count"] for r in touched)


def _fact_step(star: Star, name: str) -> core.StepResult:
    """Heal keys only in the files that need it, then append the new rows. The batch is evaluated once."""
    spec, spark, table = core.FACTS[name], star.spark, star.core(name)
    rows = core.fact_rows(name, star.raw_tables(), star.key_maps(name))
    rows = sinks.with_year(rows, spec.date[0]) if spec.date else rows.withColumn("year", F.lit(0))
    rows = written(rows, name)
    result = core.StepResult(name)
    if not sinks.exists(spark, table):
        sinks.append_rows(rows, table, "year", spec.natural)
        result.rows_inserted = rows.count()
        return result
    if spec.form == "replace":
        result.rows_inserted = replace_rows(spark.table(table), rows, spec.natural, table)
        return result
    if spec.heal:
        extra = [spec.type_column] if spec.type_column else []
        result.keys_fixed = heal_rows(spark.table(table), sized(rows.select(spec.natural, *spec.heal, *extra)), spec, name, table)
    stored = spark.table(table)
    added, seen = new_rows(sized(stored, [spec.natural]), rows, spec.natural).select(*stored.columns), Observation()
    sinks.append_rows(added.observe(seen, F.count(F.lit(1)).alias("rows")), table, "year", spec.natural)
    result.rows_inserted = seen.get["rows"]
    return result


def run_transforms(star: Star, only: list[str] | None = None) -> DataFrame:
    """Dimensions, price groups, facts. Stops at the first hard failure."""
    results = []
    for step in STEPS:
        if only and step not in only:
            continue
        try:
            if step == PRICE_GROUP_STEP:
                r = _price_group_step(star)
            elif step in core.DIMS:
                r = _dim_step(star, step)
            else:
                r = _fact_step(star, step)
            results.append((r.step, r.status, r.keys_fixed, r.rows_inserted, ""))
        except Exception as err:
            if step not in SOFT_STEPS:
                raise
            results.append((step, "skipped", 0, 0, str(err).split("\n")[0]))
    return star.spark.createDataFrame(
        results, "step string, status string, keys_fixed bigint, rows_inserted bigint, message string"
    )


def build_marts(
    tables: dict[str, DataFrame], raw: dict[str, DataFrame], dates: DataFrame, params: RunParams, mart_schema: str
) -> list[str]:
    """Write every mart; marts others read are written once and read back."""
    spark = dates.sparkSession

    def save(name: str, df: DataFrame) -> DataFrame:
        sinks.replace_table(df, f"{mart_schema}.{name}")
        return spark.table(f"{mart_schema}.{name}")

    # the marts take the year from the calendar, not from the partition column
    t = {name: df.drop("year") if name in core.FACTS else df for name, df in tables.items()}
    customers, products = t["dim_customer"], t["dim_product"]
    enriched = views.orders_enriched(t["fact_orders"], customers, dates)
    dated = sales.with_dates(t["fact_orders"], dates, "order_date_key", {"full_date": "order_date"})
    items = t["fact_order_items"]
    detail = save("fct_order_items_detail", sales.order_items_detail(items, enriched, products, headers=dated))
    save("fct_order_performance", sales.order_performance(items, enriched, dated))
    revenue = save("fct_revenue", sales.revenue(items, dated, customers, dates))
    save("fct_gross_profit", finance.gross_profit(t["fact_orders"], customers, dates))
    save("dim_customer_segmentation", sales.customer_segmentation(dated, customers, params.as_of))
    save("dim_customer_credit", finance.customer_credit(revenue, customers))
    save("fct_purchase_cost", finance.purchase_cost(t["fact_purchase_order_items"], t["dim_supplier"], products, dates))
    save("dim_product_mart", shared.product_mart(products, detail))
    materials = save("dim_material_mart", shared.material_mart(t["dim_material"]))
    save("dim_customer_mart", shared.customer_mart(customers))
    lots, exports = t["fact_warehouse_stock"], t["fact_warehouse_export"]
    snapshot = save(
        "fct_stock_snapshot",
        inventory.stock_snapshot(lots, t["fact_purchase_order_items"], products, t["dim_material"], t["dim_warehouse"]),
    )
    save("fct_inbound_outbound", inventory.inbound_outbound(lots, exports, products, t["dim_warehouse"], dates))
    save(
        "fct_stock_monthly_snapshot",
        inventory.stock_monthly(
            lots, exports, snapshot, products, materials, t["dim_warehouse"], params.snapshot_start, params.as_of
        ),
    )
    levels = inventory.product_levels(inventory.stock_stretches(lots, exports, params.snapshot_start, params.as_of))
    stages, prod_items = t["fact_production_stages"], t["fact_production_order_items"]
    save("fct_production_efficiency", production.production_efficiency(prod_items, stages, products, dates))
    save(
        "fct_production_sales_reconciliation",
        production.production_sales(
            stages, prod_items, t["fact_delivery_items"], levels, products, dates, params.snapshot_start, params.as_of
        ),
    )
    plan_cost = save(
        "fct_production_npl_cost",
        production.production_cost(
            raw["tbl_productions_plan_bom"], raw["tbl_productions_plan_items"], raw["tbl_productions_plan"],
            raw["tblpurchase_order_items"], raw["tblpurchase_order"], products, t["dim_material"], dates, params.zinc_item_id,
        ),
    )
    save("fct_order_npl_cost", production.order_cost(plan_cost, t["fact_orders"], items, products, params.fx))
    return [r.name for r in spark.catalog.listTables(mart_schema)]
