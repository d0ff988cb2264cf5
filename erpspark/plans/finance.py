"""Finance marts: gross profit, purchase cost, customer credit."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from erpspark.functions.expr import first_match, pct, ratio, rounded, zero_if_null
from erpspark.operators.lookup import decorate, with_dates
from erpspark.plans import views
from erpspark.plans.sales import active_orders, enrich_daily
from erpspark.settings import NEAR_LIMIT

PROFIT_DATES = {"full_date": "order_date", **{c: c for c in "year quarter month_num month_name".split()}}
PROFIT_CUSTOMER = {
    "customer_code": "customer_code", "fullname": "customer_name",
    **{c: c for c in "price_group_code price_group_name type_client vip_rating".split()},
}


def gross_profit(orders: DataFrame, customers: DataFrame, dates: DataFrame) -> DataFrame:
    """Daily profit per customer and branch from the amounts the source recorded."""
    daily = (
        active_orders(orders)
        .groupBy("order_date_key", "customer_key", "id_branch")
        .agg(
            F.count_distinct("order_id").alias("order_count"),
            F.sum("grand_total").alias("revenue"),
            F.sum("cost_delivery").alias("delivery_revenue"),
            F.sum("total_tax").alias("total_vat"),
            F.sum("total_cost").alias("cogs"),
            F.bool_or(F.col("total_cost") > 0).alias("is_cogs_available"),
            F.sum("total_profit").alias("gross_profit"),
            F.sum(F.col("total_discount_percent") + F.col("total_discount_direct")).alias("total_discount"),
        )
        .withColumn("gp_margin_pct", pct("gross_profit", "revenue"))
    )
    return enrich_daily(daily, customers, dates, PROFIT_DATES, PROFIT_CUSTOMER)


def _spend(po_lines: DataFrame) -> DataFrame:
    return (
        po_lines.groupBy("po_date_key", "supplier_key", "product_key")
        .agg(
            F.count_distinct("po_id").alias("po_count"),
            F.count(F.lit(1)).alias("line_count"),
            F.sum("quantity").alias("qty_ordered"),
            F.sum("quantity_suppliers").alias("qty_received"),
            F.sum("total_expected").alias("expected_cost"),
            F.sum("total_suppliers").alias("actual_cost"),
            F.sum("subtotal").alias("subtotal"),
        )
        .withColumn("price_variance", F.col("actual_cost") - F.col("expected_cost"))
        .withColumn("avg_unit_cost", rounded(ratio("actual_cost", "qty_received"), 4))
        .withColumn("tax_amount", F.col("expected_cost") - F.col("subtotal"))
        .withColumn("qty_gap", F.col("qty_ordered") - F.col("qty_received"))
    )


def purchase_cost(po_lines: DataFrame, suppliers: DataFrame, products: DataFrame, dates: DataFrame) -> DataFrame:
    """Purchases per order date, supplier and product: spend against expectation.

    Lines that name a product travel once, to their product: there they are counted, summed up and meet its attributes.
    The others have no attributes to meet and are combined before they travel.
    """
    attributes = {**{c: c for c in "product_code product_name type_products category_id brand".split()}, "price_import": "std_import_price"}
    named = F.col("product_key").isNotNull()
    with_product = decorate(_spend(po_lines.filter(named).repartition("product_key")), products, "product_key", attributes)
    spend = with_product.unionByName(_spend(po_lines.filter(~named)), allowMissingColumns=True)
    out = with_dates(
        spend, dates, "po_date_key", {"full_date": "po_date", **{c: c for c in "year quarter month_num month_name".split()}}
    )
    return decorate(
        out,
        suppliers,
        "supplier_key",
        {"supplier_code": "supplier_code", "company": "supplier_name", "city": "supplier_city", "groups_in": "supplier_group"},
    )


def customer_credit(revenue: DataFrame, customers: DataFrame) -> DataFrame:
    """One row per customer: lifetime revenue against the credit limit."""
    used = revenue.groupBy("customer_key").agg(
        F.sum("revenue").alias("used"),
        F.count_distinct("order_date_key").alias("days"),
        F.max("order_date").alias("last_order_date"),
    )
    who = views.customers(customers).select(
        "customer_key", "customer_code", F.col("fullname").alias("customer_name"), "company", "city", "type_client",
        "price_group_name", "vip_rating", "is_active", F.col("datecreated").alias("customer_since"), "phonenumber",
        "email", F.col("debt_limit").alias("limit_raw"), "debt_limit_day", "time_payment", "discount",
    )
    spent = F.col("lifetime_revenue")
    limit = F.col("debt_limit")
    return (
        who.join(used, "customer_key", "left")
        .withColumn("debt_limit", zero_if_null("limit_raw").cast("decimal(22,4)"))
        .withColumn("lifetime_revenue", zero_if_null("used").cast("decimal(32,4)"))
        .withColumn("active_days", zero_if_null("days"))
        .withColumn("credit_utilisation_pct", pct(spent, "limit_raw"))
        .withColumn("credit_headroom", limit - spent)
        .withColumn("is_over_limit", F.when(limit != 0, (spent > limit).cast("int")))
        .withColumn(
            "credit_status",
            first_match(
                [
                    (limit == 0, "No Limit Set"),
                    (spent >= limit, "Over Limit"),
                    (spent >= limit * F.lit(str(NEAR_LIMIT)).cast("decimal(2,1)"), "Near Limit"),
                    (spent > 0, "Within Limit"),
                ],
                "Clear",
            ),
        )
        .drop("used", "days", "limit_raw")
    )
