"""Thin views over the star schema, and orders enriched with customer and calendar."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from erpspark.operators.lookup import decorate, with_dates

# fixed values: the columns each view exposes
CUSTOMER = """customer_key customer_id customer_code prefix_client company company_short representative
    fullname phonenumber email type_client vip_rating status_clients is_active country city district ward
    address vat debt_limit debt_limit_day discount table_price_id time_payment price_group_key
    price_group_code price_group_name datecreated etl_loaded_at""".split()
DATE = """date_key full_date day_of_week day_name day_of_month day_of_year week_of_year month_num month_name
    quarter year is_weekend is_holiday""".split()
MATERIAL = """material_key material_id material_code material_name material_name_supplier category_id unit_id
    price_import species is_zinc mode_id longs wide height is_single_use is_active id_branch date_created
    date_updated etl_loaded_at""".split()
ORDER_ITEM = """order_item_key order_item_id order_id customer_key product_key order_date_key quantity price
    amount tax_rate_item tax_amount_item discount_percent_item discount_percent_amount_item
    discount_direct_amount_item total_amount cost profit cost_temporary_capital profit_temporary_capital
    quantity_delivery quantity_not_delivery quantity_returned type_item item_code type_gift active unit_id
    etl_loaded_at""".split()
ORDER = """order_key order_id reference_no customer_key employee_key order_date_key warehouse_id id_branch
    count_items total_quantity total_amount_items total_tax_items total_discount_percent_items
    total_discount_direct_items grand_total_items total_tax total_discount_percent total_discount_direct
    cost_delivery grand_total total_cost total_profit total_payment status status_payment status_orders
    type_orders type_bills is_cancel is_end currencies date_created date_updated etl_loaded_at""".split()
PRODUCT = """product_key product_id product_code product_name product_name_customer type_products category_id
    unit_id species brand brand_id price_import price_sell price_processing loss bom_id versions
    versions_stage conversion_unit conversion_quantity_unit longs wide height warranty status is_no_stock
    is_active id_branch date_created etl_loaded_at""".split()
STAFF = """staff_key staff_id firstname lastname fullname email phonenumber gender birthday day_in
    status_work role admin id_branch is_active etl_loaded_at""".split()
SUPPLIER = """supplier_key supplier_id supplier_code company representative phone email vat address city
    type_suppliers groups_in debt_limit is_active datecreated etl_loaded_at""".split()
WAREHOUSE = """warehouse_key warehouse_id warehouse_code warehouse_name address supplier_id id_branch
    is_virtual etl_loaded_at""".split()


def _pick(df: DataFrame, names: list[str]) -> DataFrame:
    """The named columns; one the table does not have yet comes out as NULL."""
    have = set(df.columns)
    return df.select(*[F.col(c) if c in have else F.lit(None).cast("string").alias(c) for c in names])


def customers(df: DataFrame) -> DataFrame:
    """The full name falls back from representative to company to code."""
    named = df.drop("fullname").withColumn("fullname", F.coalesce("representative", "company", "customer_code"))
    return _pick(named, CUSTOMER)


def dates(df: DataFrame) -> DataFrame:
    return _pick(df, DATE)


def materials(df: DataFrame) -> DataFrame:
    return _pick(df, MATERIAL)


def order_items(df: DataFrame) -> DataFrame:
    return _pick(df, ORDER_ITEM)


def orders(df: DataFrame) -> DataFrame:
    return _pick(df, ORDER)


def products(df: DataFrame) -> DataFrame:
    return _pick(df, PRODUCT)


def staff(df: DataFrame) -> DataFrame:
    return _pick(df, STAFF).withColumnsRenamed({"role": "staff_role", "admin": "is_admin"})


def suppliers(df: DataFrame) -> DataFrame:
    return _pick(df, SUPPLIER)


def warehouses(df: DataFrame) -> DataFrame:
    return _pick(df, WAREHOUSE)


CUSTOMER_ON_ORDER = {
    "customer_code": "customer_code",
    "fullname": "customer_name",
    "company": "company",
    "company_short": "company_short",
    "city": "city",
    "type_client": "type_client",
    "price_group_key": "price_group_key",
    "price_group_code": "price_group_code",
    "price_group_name": "price_group_name",
    "vip_rating": "vip_rating",
}
DATE_ON_ORDER = {
    "full_date": "order_date",
    **{
        c: c
        for c in "day_of_week day_name day_of_month week_of_year month_num month_name quarter year is_weekend".split()
    },
}
ENRICHED = """order_key order_id reference_no order_date_key order_date day_of_week day_name day_of_month
    week_of_year month_num month_name quarter year is_weekend customer_key customer_code customer_name company
    company_short city type_client price_group_key price_group_code price_group_name vip_rating id_branch
    employee_key warehouse_id count_items total_quantity grand_total total_cost total_profit total_payment
    total_tax total_discount_percent total_discount_direct cost_delivery status status_payment status_orders
    type_orders type_bills is_cancel is_end date_created date_updated""".split()


def orders_enriched(order_rows: DataFrame, customer_rows: DataFrame, date_rows: DataFrame) -> DataFrame:
    """Every order with its customer and calendar attributes (both optional)."""
    out = with_dates(orders(order_rows), date_rows, "order_date_key", DATE_ON_ORDER)
    out = decorate(out, customers(customer_rows), "customer_key", CUSTOMER_ON_ORDER)
    return out.select(*ENRICHED)
