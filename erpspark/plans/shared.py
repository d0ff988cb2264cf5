"""Shared dimensions: product, material and customer marts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from erpspark.functions.expr import first_match, price_tier, ratio, rounded
from erpspark.operators.ranks import exact_percentiles, percentile_values
from erpspark.plans import views
from erpspark.session import written
from erpspark.settings import PRICE_TIER_PROBS

# fixed values: name patterns (case-insensitive)
PAPER_PATTERNS = ["Gi%y %", "%(kh%ng%d%ng)Gi%y%", "Decal Gi%y%", "D%y B%ng Gi%y%"]
MATERIAL_TYPES = [
    ("Giay", ["Gi%y %"]),
    ("Decal", ["Decal%"]),
    ("Muc / UV", ["Muc%", "UV%"]),
    ("Bao bi", ["Bao bi%", "Tui%"]),
    ("Bang keo / Dan", ["Bang keo%", "Bang d%n%"]),
    ("Vat tu dong goi", ["Hop%", "Carton%", "VTDG%"]),
]
ZINC_LABEL, OTHER_LABEL = "Kem in", "Khac"


def like_any(name: Column, patterns: list[str]) -> Column:
    hit = F.lit(False)
    for p in patterns:
        hit = hit | name.ilike(p)
    return F.coalesce(hit, F.lit(False))


def is_paper(name: Column) -> Column:
    return like_any(name, PAPER_PATTERNS)


def material_type(name: Column, zinc: Column) -> Column:
    rules = [(zinc, ZINC_LABEL)] + [(like_any(name, pats), label) for label, pats in MATERIAL_TYPES]
    return first_match(rules, OTHER_LABEL)


def material_mart(materials: DataFrame) -> DataFrame:
    name = F.col("material_name")
    return views.materials(materials).select(
        "material_key", "material_id", "material_code", "material_name", "material_name_supplier", "category_id",
        "unit_id", "species", "mode_id", "is_zinc", is_paper(name).alias("is_giay"),
        material_type(name, F.col("is_zinc")).alias("npl_type"), "price_import", "longs", "wide", "height",
        "is_single_use", "is_active", "id_branch",
    )


def customer_mart(customers: DataFrame) -> DataFrame:
    return views.customers(customers).select(
        "customer_key", "customer_id", "customer_code", "prefix_client", "company", "company_short",
        "representative", F.col("fullname").alias("customer_name"), "phonenumber", "email", "type_client",
        "vip_rating", "price_group_code", "price_group_name", "status_clients", "is_active", "city", "district",
        "address", "debt_limit", "debt_limit_day", "discount", "time_payment",
        F.col("datecreated").alias("customer_created_at"),
    )


def sold_prices(detail: DataFrame) -> DataFrame:
    """Average, median and last repaired price per product with a price above zero; the lines are evaluated once."""
    price = F.col("unit_price_adjusted")
    sold = written(detail.filter(price > 0).select("product_key", price, "quantity", "order_date", "order_item_id", "order_id"), "sold")
    stats = sold.groupBy("product_key").agg(
        rounded(
            ratio(F.sum(price.cast("decimal(18,2)") * F.col("quantity").cast("decimal(14,4)")), F.sum("quantity")), 2
        ).alias("avg_sell_price_actual"),
        F.round(F.max_by(price, F.struct("order_date", "order_item_id")), 2).alias("last_sell_price_actual"),
        F.count_distinct("order_id").alias("sold_order_count_12m"),
    )
    median = exact_percentiles(sold, "unit_price_adjusted", {"median": 0.5}, by=["product_key"])
    # NULL product rows form a group in the aggregate but can never match a product
    return stats.join(median, "product_key", "left").withColumn("median_sell_price_actual", rounded("median", 2)).drop("median")


def product_mart(products: DataFrame, detail: DataFrame) -> DataFrame:
    """Product master with prices from all sales and a tier over product averages."""
    # one row per product, read by the threshold passes and by the result
    prices = written(sold_prices(detail), "prices")
    low_p, high_p = PRICE_TIER_PROBS
    avg = F.col("avg_sell_price_actual").cast("double")
    limits = percentile_values(prices.filter(avg > 0).select(avg.alias("avg")), "avg", {"p33": low_p, "p67": high_p})
    return (
        views.products(products)
        .join(prices, "product_key", "left")
        .withColumn("price_tier", price_tier(avg, F.lit(limits["p33"]), F.lit(limits["p67"])))
        .withColumnRenamed("date_created", "product_created_at")
    )
