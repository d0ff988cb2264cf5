"""Named queries: a Spark plan, its output columns and the SQL that checks it."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from erpspark.catalog.roles import PARAMS, role, table
from erpspark.catalog.sqltext import build
from erpspark.functions.expr import rounded, shape
from erpspark.plans import finance, inventory, production, sales, shared, views
from erpspark.session import tune


class Erp:
    """Roles and marts over one data folder; every member is a lazy plan."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir, self.params = tune(spark), sf_dir, PARAMS

    def role(self, name: str) -> DataFrame:
        return role(self.spark, self.sf_dir, name)

    def table(self, name: str) -> DataFrame:
        return table(self.spark, self.sf_dir, name)

    def __getattr__(self, name: str) -> DataFrame:
        # plain roles: erp.customers, erp.lots, ...
        if name.startswith("_"):
            raise AttributeError(name)
        return role(self.spark, self.sf_dir, name)

    @cached_property
    def enriched(self) -> DataFrame:
        return views.orders_enriched(self.orders, self.customers, self.dates)

    @cached_property
    def detail(self) -> DataFrame:
        return sales.order_items_detail(self.order_items, self.enriched, self.products, headers=self.dated_orders)

    @cached_property
    def performance(self) -> DataFrame:
        return sales.order_performance(self.order_items, self.enriched, self.dated_orders)

    @cached_property
    def revenue(self) -> DataFrame:
        return sales.revenue(self.order_items, self.dated_orders, self.customers, self.dates)

    @cached_property
    def dated_orders(self) -> DataFrame:
        """Orders with their calendar date, without the customer attributes."""
        return sales.with_dates(self.orders, self.dates, "order_date_key", {"full_date": "order_date"})

    @cached_property
    def profit(self) -> DataFrame:
        return finance.gross_profit(self.orders, self.customers, self.dates)

    @cached_property
    def segmentation(self) -> DataFrame:
        return sales.customer_segmentation(self.dated_orders, self.customers, self.params.as_of)

    @cached_property
    def credit(self) -> DataFrame:
        return finance.customer_credit(self.revenue, self.customers)

    @cached_property
    def purchases(self) -> DataFrame:
        return finance.purchase_cost(self.po_lines, self.suppliers, self.products, self.dates)

    @cached_property
    def product_mart(self) -> DataFrame:
        lines = sales.repaired_lines(self.order_items, self.dated_orders).filter("__live")
        priced = lines.withColumn("unit_price_adjusted", rounded("__price", 2))
        return shared.product_mart(self.products, priced)

    @cached_property
    def material_mart(self) -> DataFrame:
        return shared.material_mart(self.materials)

    @cached_property
    def snapshot(self) -> DataFrame:
        return inventory.stock_snapshot(self.lots, self.po_lines, self.products, self.materials, self.warehouses)

    @cached_property
    def moves(self) -> DataFrame:
        return inventory.inbound_outbound(self.lots, self.exports, self.products, self.warehouses, self.dates)

    @cached_property
    def monthly(self) -> DataFrame:
        return inventory.stock_monthly(
            self.lots, self.exports, self.snapshot, self.products, self.material_mart, self.warehouses,
            self.params.snapshot_start, self.params.as_of,
        )

    @cached_property
    def efficiency(self) -> DataFrame:
        return production.production_efficiency(self.production_items, self.stages, self.products, self.dates)

    @cached_property
    def production_sales(self) -> DataFrame:
        stretches = inventory.stock_stretches(self.lots, self.exports, self.params.snapshot_start, self.params.as_of)
        return production.production_sales(
            self.stages, self.production_items, self.deliveries, inventory.product_levels(stretches), self.products, self.dates,
            self.params.snapshot_start, self.params.as_of,
        )

    @cached_property
    def plan_cost(self) -> DataFrame:
        return production.production_cost(
            self.bom, self.plan_items, self.plans, self.purchase_lines, self.purchase_heads, self.products,
            self.materials, self.dates, self.params.zinc_item_id,
        )

    @cached_property
    def order_cost(self) -> DataFrame:
        plans = self.plans.selectExpr("id AS productions_plan_id", "options1_id AS source_order_ids")
        return production.order_cost(self.plan_cost, self.orders, self.order_items, self.products, self.params.fx, plans)


PLANS: dict[str, Callable[[Erp], DataFrame]] = {}
SPECS: dict[str, str] = {}
CHECKS: dict[str, str] = {}


def query(name: str, spec: str, check: str | None = None):
    """Register a plan under a name with its output columns and checking SQL."""

    def add(plan: Callable[[Erp], DataFrame]):
        if name in PLANS:
            raise ValueError(f"query {name} is registered twice")
        PLANS[name], SPECS[name] = plan, spec
        if check is not None:
            CHECKS[name] = check
        return plan

    return add


def run(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    return shape(PLANS[name](Erp(spark, sf_dir)), SPECS[name])


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {n: (lambda spark, sf_dir, n=n: run(n, spark, sf_dir)) for n in PLANS}


def all_checks() -> dict[str, str]:
    return {n: build(sql, SPECS[n]) for n, sql in CHECKS.items()}
